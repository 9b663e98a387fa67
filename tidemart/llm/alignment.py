"""Token alignment between two tokenizers by as-of merges of byte offsets.

Each text is tokenised on both sides and every token gets the byte range it covers of the text with a space before it. A
``merge_asof`` of the starts, keyed by document, gives each token the covering token of the other side;
both directions together are all overlapping pairs, since of two overlapping tokens one starts
inside the other. Pairs that end together close a group.

Corpus counts. Tokenised texts form blocks of about ``CHUNK_CHARS`` characters, written once: per document the
figures, per block its distinct id pairs with the number of their links. Counts of pairs are a
grouped sum; each block asks for the counts of its distinct pairs only, in packed slices by
segment of the pair, and the answers meet the block again. Blocks, slices and answers are bounded by the
block's size, a segment by ``SEGMENT_PAIRS``; the table of pairs is never held whole.

Long texts are cut at single spaces between two letters, where both tokenizers begin a new
pre-token: each part with the space before it is tokenised by itself, with the same result. The second
tokenizer's merges are checked for this on loading; otherwise texts stay whole.

Defined results: texts that are NULL, empty, or not rendered byte for byte by either side have no tokens: zeros and the
digest ''. Ties for the highest count are all best. Repeated rows are
separate rows and count each; NULL keys are kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemart.llm.bpe import PATTERN, printable_bytes
from tidemart.llm.common import map_batches, narrow, saved, shuffle_partitions, text_chunks
from tidemart.llm.token_counts import SPACE
from tidemart.llm.word_hash import mix

CHUNK_CHARS = 1 << 21
PART_CHARS = 1 << 18
LONG_WORD = 1000
REMEMBERED = 60_000
SEGMENT_PAIRS = 1 << 20
CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_SCHEMA = (
    "block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, n_pairs long, pairs binary, n_rows long, links binary"
)


class TwoTokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_path)
        self.first.no_truncation()
        self.first.no_padding()
        # Special strings in a text are plain text.
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        byte_of = printable_bytes()
        vocab = self.first.get_vocab(with_added_tokens=True)
        self.first_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            self.first_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [_piece_bytes(p) for p in pieces]
        self.ranked = self._ranked(byte_path)
        self.first_sizes = np.array([len(b) for b in self.first_bytes])
        self.second_sizes = np.array([len(b) for b in self.second_bytes])
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.known: dict[str, list[int]] = {}

    def _ranked(self, path: str):
        """The first tokenizer as a table of ranks, which encodes several times faster; None if ids do not follow the merges."""
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = np.array([model["vocab"][a + b] for a, b in pairs])
        if len(made) < 2 or not (np.diff(made) > 0).all():
            return None
        alone = [model["vocab"][c] for c in printable_bytes()]
        ranks = {self.first_bytes[i]: i for i in [*alone, *made.tolist()]}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def first_ids(self, part: str) -> list[int]:
        # The faster one takes quadratic time for a long pre-token.
        if self.ranked is not None and max(map(len, part.split()), default=0) <= LONG_WORD:
            return self.ranked.encode_ordinary(" " + part)
        return self.first.encode(" " + part, add_special_tokens=False).ids

    def second_ids(self, parts: list[str]) -> list[list[int]]:
        """Words between single spaces are encoded once for many texts, other parts whole."""
        words = [p.split(" ") if self.cuttable and SPACE not in p else [""] for p in parts]
        plain = [all(w) for w in words]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({w for p, ws in zip(plain, words) if p for w in ws if w not in known})
        known.update(zip(new, self.second.encode(new, num_threads=1)))
        whole = iter(self.second.encode([p for p, one in zip(parts, plain) if not one], num_threads=1))
        return [[t for w in ws for t in known[w]] if p else next(whole) for p, ws in zip(plain, words)]

    def parts(self, text: str) -> list[str]:
        """The text without its cuts' spaces, which tokenising a part puts back."""
        if not text or len(text) <= PART_CHARS or not self.cuttable:
            return [text] if text else []
        out, begin = [], 0
        while len(text) - begin > PART_CHARS:
            cut = CUT.search(text, begin + PART_CHARS)
            if cut is None:
                break
            out.append(text[begin : cut.start()])
            begin = cut.end()
        return [*out, text[begin:]]

    def ids(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; empty lists where either does not render the part byte for byte."""
        one = [self.first_ids(p) for p in parts]
        other = self.second_ids(parts)
        a, b = self.first_bytes.__getitem__, self.second_bytes.__getitem__
        for i, part in enumerate(parts):
            whole = b" " + part.encode()
            if b"".join(map(a, one[i])) != whole or b"".join(map(b, other[i])) != whole:
                one[i] = other[i] = []
        return one, other


def _piece_bytes(piece: str) -> bytes:
    byte = BYTE_PIECE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()


@lru_cache(maxsize=1)
def load(byte_path: str, piece_path: str) -> TwoTokenizers:
    return TwoTokenizers(byte_path, piece_path)


# --- one batch of texts


def spans(tokens: list[list[int]], sizes: np.ndarray) -> pd.DataFrame:
    """(id, doc, start, end): the byte range of each token; documents stand one after the other."""
    ids = np.array([t for own in tokens for t in own], dtype=np.int64)
    end = np.cumsum(sizes[ids]) if len(ids) else np.empty(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(tokens)), [len(own) for own in tokens])
    return pd.DataFrame({"id": ids, "doc": doc, "start": end - (sizes[ids] if len(ids) else 0), "end": end})


def overlaps(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
    """(a, b, doc, closes): all pairs of tokens (by place) whose ranges overlap, and whether they end together."""
    left = one.assign(a=np.arange(len(one)))[["start", "doc", "a"]]
    right = other.assign(b=np.arange(len(other)))[["start", "doc", "b"]]
    covered = pd.merge_asof(left, right, on="start", by="doc")
    covering = pd.merge_asof(right, left, on="start", by="doc")
    # Tokens that start together are found from both sides.
    inside = covering[one["start"].to_numpy()[covering["a"]] < covering["start"].to_numpy()]
    links = pd.concat([covered[["a", "b", "doc"]], inside[["a", "b", "doc"]]], ignore_index=True)
    links["closes"] = one["end"].to_numpy()[links["a"]] == other["end"].to_numpy()[links["b"]]
    return links


def group_texts(one: pd.DataFrame, other: pd.DataFrame, links: pd.DataFrame) -> tuple[bytes, np.ndarray]:
    """The groups of all documents as text, with ';' after each, and where each document's text ends (by token order).

    Ids are written as digits of an array, one row per token.
    """
    ends = np.sort(one["end"].to_numpy()[links["a"].to_numpy()[links["closes"].to_numpy()]])
    group = [np.searchsorted(ends, side["end"].to_numpy()) for side in (one, other)]
    sizes = [np.bincount(g, minlength=len(ends)) for g in group]
    before = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
    n = len(one) + len(other)
    ids, mark, doc = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8), np.empty(n, dtype=np.int64)
    # A group's tokens of the first side stand before those of the second.
    place = [np.arange(len(one)) + before[1][group[0]], np.arange(len(other)) + before[0][group[1] + 1]]
    for side, at in zip((one, other), place):
        ids[at], doc[at] = side["id"], side["doc"]
    mark[place[0][before[0][1:] - 1]] = ord("|")
    mark[place[1][before[1][1:] - 1]] = ord(";")
    width = len(str(int(ids.max()))) + 1
    digits = np.empty((n, width), dtype=np.uint8)
    rest = ids
    for column in range(width - 2, -1, -1):
        digits[:, column] = rest % 10 + ord("0")
        rest = rest // 10
    digits[:, -1] = mark
    lengths = np.searchsorted(10 ** np.arange(1, width - 1), ids, side="right") + 1
    shown = np.arange(width) >= (width - 1 - lengths)[:, None]
    return digits[shown].tobytes(), np.cumsum(np.bincount(doc, weights=lengths + 1).astype(np.int64))


def align(tokenizers: TwoTokenizers, texts: list[str]) -> dict:
    """Figures of each text, and the links of all by text and pair: (text, pair, number), pair = b id * 2^32 + a id."""
    n = len(texts)
    figures = {c: np.zeros(n, dtype=np.int64) for c in FIGURES}
    digests = [hashlib.sha256() for _ in texts]
    parted = [tokenizers.parts(t) for t in texts]
    flat = [(i, p) for i, ps in enumerate(parted) for p in ps]
    failed, begun = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    found: list[np.ndarray] = [np.empty((0, 3), dtype=np.int64)]
    # Long texts come a part at a time.
    run: list[tuple[int, str]] = []
    for k, item in enumerate(flat):
        run.append(item)
        if sum(len(p) for _, p in run) >= PART_CHARS or k == len(flat) - 1:
            found.append(_align_run(tokenizers, run, figures, digests, failed, begun))
            run = []
    links = _summed(np.concatenate(found))
    links = links[~failed[links[:, 0]]]
    for c in figures.values():
        c[failed] = 0
    known = ~failed & (figures["n_a"] > 0)
    return {
        **figures,
        "groups_sha256": [d.hexdigest() if k else "" for d, k in zip(digests, known.tolist())],
        "links": links,
    }


def _summed(rows: np.ndarray) -> np.ndarray:
    """Rows (text, pair, number) in order, one for each text and pair."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.flatnonzero(np.concatenate([[len(rows) > 0], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
    return np.column_stack([rows[new, :2], np.add.reduceat(rows[:, 2], new) if len(new) else rows[:, 2]])


def _align_run(
    tokenizers: TwoTokenizers, run: list[tuple[int, str]], figures: dict, digests: list, failed: np.ndarray, begun: np.ndarray
) -> np.ndarray:
    """Adds the figures of a few parts (text, part) to those of their texts; returns their links."""
    owner = np.array([i for i, _ in run])
    ids = tokenizers.ids([p for _, p in run])
    failed[owner[[not own for own in ids[0]]]] = True
    one, other = spans(ids[0], tokenizers.first_sizes), spans(ids[1], tokenizers.second_sizes)
    if not len(one):
        return np.empty((0, 3), dtype=np.int64)
    links = overlaps(one, other)
    doc = links["doc"].to_numpy()
    for name, where in (("n_a", one["doc"]), ("n_b", other["doc"]), ("n_groups", doc[links["closes"]]), ("n_links", doc)):
        np.add.at(figures[name], owner, np.bincount(where, minlength=len(run)))
    text, ends = group_texts(one, other, links)
    begin = 0
    for part, end in enumerate(ends.tolist()):
        if end > begin:
            i = owner[part]
            # A document's later parts go on after a ';'.
            digests[i].update((b";" if begun[i] else b"") + text[begin : end - 1])
            begun[i] = True
        begin = end
    pair = (other["id"].to_numpy()[links["b"]] << 32) | one["id"].to_numpy()[links["a"]]
    return _summed(np.column_stack([owner[doc], pair, np.ones(len(pair), dtype=np.int64)]))


# --- corpus-wide counts


def _pack(*columns: np.ndarray) -> bytes:
    data = b"".join([np.ascontiguousarray(c, dtype="<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns])
    return pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, columns: int = 1) -> np.ndarray:
    """(columns, n) numbers: bytes of equal weight stand together, which packs well."""
    raw = pa.decompress(data, decompressed_size=8 * n * columns, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(columns, n)


def segment_of(pairs: np.ndarray, segments: int) -> np.ndarray:
    return (mix(pairs.astype(np.uint64)) % np.uint64(segments)).astype(np.int64)


def block_rows(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row for each block of documents: their figures, the block's distinct pairs, and the links by document."""
    rows = narrow(docs).withColumn("doc_id", F.col("doc_id").cast("long"))

    def make():
        tokenizers = load(byte_path, piece_path)
        number = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))

        def step(batch: pa.RecordBatch):
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                found = align(tokenizers, texts)
                text, pair, count = found.pop("links").T
                pairs, place = np.unique(pair, return_inverse=True)
                of_text = np.bincount(text, minlength=len(texts))
                own = {c: pa.array([v], pa.list_(pa.int64())) for c, v in found.items() if c in FIGURES}
                yield {
                    "block": [next(number)],
                    "ids": pa.array([batch.column("doc_id").slice(first, len(texts)).to_pylist()], pa.list_(pa.int64())),
                    **own,
                    "groups_sha256": [found["groups_sha256"]],
                    "n_pairs": [len(pairs)],
                    "pairs": [_pack(np.diff(pairs, prepend=0), np.bincount(place, weights=count, minlength=len(pairs)))],
                    "n_rows": [len(pair)],
                    "links": [_pack(np.concatenate([of_text, np.diff(place, prepend=0), count]))],
                }

        step.done = tokenizers.known.clear
        return step

    return map_batches(rows, make, BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, links, best) over all blocks; best where no pair of the B id has more links."""

    def make():
        def step(batch: pa.RecordBatch):
            for n, data in zip(batch.column("n_pairs").to_pylist(), batch.column("pairs").to_pylist()):
                steps, counts = _unpack(data, n, 2)
                yield {"pair": pa.array(np.cumsum(steps)), "links": pa.array(counts)}

        return step

    each = map_batches(blocks.select("n_pairs", "pairs"), make, "pair long, links long")
    # At most the first vocabulary's ids stand in one window.
    of_second = Window.partitionBy(F.shiftright("pair", 32))
    return each.groupBy("pair").agg(F.sum("links").alias("links")).withColumn("best", F.col("links") == F.max("links").over(of_second))


TABLE, REQUEST = 0, 1
SLICES = "segment long, kind int, block long, n long, data binary"


def table_slices(counts: DataFrame, segments: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            pair, links, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "links", "best"))
            yield _slices(TABLE, np.int64(-1), segment_of(pair, segments), pair, 2 * links + best)

        return step

    return map_batches(counts, make, SLICES)


def requests(blocks: DataFrame, segments: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            for block, n, data in zip(*(batch.column(c).to_pylist() for c in ("block", "n_pairs", "pairs"))):
                pairs = np.cumsum(_unpack(data, n, 2)[0])
                yield _slices(REQUEST, np.int64(block), segment_of(pairs, segments), pairs)

        return step

    return map_batches(blocks.select("block", "n_pairs", "pairs"), make, SLICES)


def _slices(kind: int, block: np.int64, segment: np.ndarray, *columns: np.ndarray) -> dict:
    """Rows cut by segment, in order of the first column within it."""
    order = np.lexsort((columns[0], segment))
    segment = segment[order]
    begins = np.flatnonzero(np.concatenate([[len(segment) > 0], segment[1:] != segment[:-1]]))
    ends = np.append(begins[1:], len(segment))
    return {
        "segment": segment[begins],
        "kind": np.full(len(begins), kind),
        "block": np.full(len(begins), block),
        "n": ends - begins,
        "data": [_pack(*[c[order[a:b]] for c in columns]) for a, b in zip(begins, ends)],
    }


def answers(slices: DataFrame) -> DataFrame:
    """For each request of a block the counts of its pairs, doubled, plus 1 for the best; a segment's table comes first."""
    placed = slices.repartition("segment").sortWithinPartitions("segment", "kind")

    def make():
        current, held, table = None, [], None

        def step(batch: pa.RecordBatch):
            nonlocal current, held, table
            out = {c: [] for c in ("segment", "kind", "block", "n", "data")}
            for segment, kind, block, n, data in zip(*(batch.column(c).to_pylist() for c in out)):
                if segment != current:
                    current, held, table = segment, [], None
                if kind == TABLE:
                    held.append(_unpack(data, n, 2))
                    continue
                if table is None:
                    table = np.concatenate(held, axis=1)
                    table = table[:, np.argsort(table[0])]
                    held = []
                wanted = _unpack(data, n)[0]
                values = (segment, kind, block, n, _pack(table[1][np.searchsorted(table[0], wanted)]))
                for c, v in zip(out, values):
                    out[c].append(v)
            yield out

        return step

    return map_batches(placed, make, SLICES)


def scored(blocks: DataFrame, answered: DataFrame, segments: int) -> DataFrame:
    """The figures of every document, from the blocks and the answers to their requests."""
    # A block itself comes before its answers.
    rows = blocks.withColumn("segment", F.lit(-1).cast("long")).unionByName(
        answered.select("block", "segment", "n", "data"), allowMissingColumns=True
    )
    placed = rows.repartition("block").sortWithinPartitions("block", "segment")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    target = to_arrow_schema(StructType.fromDDL(schema))

    def result(block: dict, parts: list[np.ndarray]) -> dict:
        n, n_rows, n_pairs = len(block["ids"]), block["n_rows"], block["n_pairs"]
        packed = _unpack(block["links"], n + 2 * n_rows)[0]
        of_text, place, number = packed[:n], np.cumsum(packed[n : n + n_rows]), packed[n + n_rows :]
        pairs = np.cumsum(_unpack(block["pairs"], n_pairs, 2)[0])
        value = np.empty(n_pairs, dtype=np.int64)
        value[np.lexsort((pairs, segment_of(pairs, segments)))] = np.concatenate([np.empty(0, dtype=np.int64), *parts])
        # Sums by differences of running sums: whole numbers, and texts without links give zero.
        ends = np.cumsum(of_text)

        def total(of_link: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(number * of_link)])
            return running[ends] - running[ends - of_text]

        return {
            "doc_id": pa.array(block["ids"], pa.int64()),
            **{c: block[c] for c in (*FIGURES, "groups_sha256")},
            "n_best": total(value[place] & 1),
            "count_sum": total(value[place] >> 1),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if block is not None and len(block["ids"]):
                columns = result(block, parts)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target)

        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("segment")[at].as_py() < 0:
                    yield from close()
                    block, parts = {c: batch.column(c)[at].as_py() for c in batch.schema.names}, []
                else:
                    parts.append(_unpack(batch.column("data")[at].as_py(), batch.column("n")[at].as_py())[0])
        yield from close()

    return placed.mapInArrow(run, schema)


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text."""
    blocks = saved(block_rows(docs, byte_path, piece_path), "aligned-blocks")
    counts = saved(pair_counts(blocks), "pair-counts")
    segments = max(shuffle_partitions(docs.sparkSession), -(-counts.count() // SEGMENT_PAIRS))
    answered = answers(table_slices(counts, segments).union(requests(blocks, segments)))
    return scored(blocks, answered, segments)
