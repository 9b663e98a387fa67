"""Language-model scores from a log-frequency Bloom filter.

The filter holds unigram and bigram counts of the training documents: a count is quantised to a
level of base ``LOG_BASE``, and the n-gram is put in once for every level up to
its own. Membership probes for level 1, 2, ... until the first miss give the level
back, and with it an estimate of the count, never below the true level. A
token's probability given the one before is

    P(w | v) = (min(c(v w), c(v)) + MU * P(w)) / (c(v) + MU),   P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

with all three counts from probes. The filter has segments by hash, one for every ``SEGMENT_TOKENS``
tokens of the input, so a task reads about as much at any size; each is built by one task
from all counts of its n-grams and has ``BITS`` bits for every entry, so no n-gram is left out and
the share of false levels is the same at any size. The filter is never collected or broadcast: each
block of documents sends its distinct n-grams, with their training counts, to their segments
once; the segment's task builds it, probes it for them and sends the levels back to the block.

The base score needs exact counts of an unbounded vocabulary; they go the same way, by the
whole 64-bit hash of the token: a segment sums the counts of its tokens over all blocks and sends the sums back.
A block is written once, its documents' tokens as numbers of the distinct ones; a
frequent token is one entry per block and segment, whatever its number of occurrences.

Defined results: a NULL text is the empty one, a single end token. A document with a
NULL key is never learned from and held out. Without training documents N is 0, every
count is 0, and base scores follow the formula (V = 0). Repeated rows are
separate documents; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import fold, narrow, saved, text_chunks
from tidemart.llm.word_hash import mix, word_hashes

END = np.uint64(0xE17A1465D5A3B0C1)
START = np.uint64(0x5C0FFEE5BADC0DE5)
UNIGRAM = np.uint64(0x2545F4914F6CDD1D)
BIGRAM = np.uint64(0x9FB21C651E98DF25)
LOG_BASE = 1.5
MAX_LEVEL = 100
# Chosen among the training documents alone, by the mean score of those whose crc32 mod 5 is 2
# under counts of remainders 0, 3 and 4.
MU = 500.0
BITS = 10
PROBES = 4
# A block of documents, in characters and documents.
BLOCK_CHARS = 24 << 20
BLOCK_DOCS = 1 << 16
CHUNK_CHARS = 1 << 18
NULL_KEY = -(1 << 63)
SEGMENT_TOKENS = 1 << 20
KEY_BITS = 40
ROWS = "kind int, block long, segment int, n long, data binary"
# Kinds of rows: a block's documents, with how many tokens in segment; for a block and a segment its tokens or n-grams; a segment's
# training tokens (in block) and how many are distinct (in n).
DOCUMENTS, TOKENS, NGRAMS, VOCABULARY = range(4)


# --- counts


def _with_ends(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens, each text's words followed by its end; and the number of tokens of each text."""
    ends = np.cumsum(counts)
    return np.insert(hashes, ends, END), counts + 1


def _before(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The token before each token, START at the beginning of a text."""
    left = np.empty_like(tokens)
    left[1:] = tokens[:-1]
    left[np.cumsum(counts) - counts] = START
    return left


def bigrams(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return mix(_before(tokens, counts) * BIGRAM + tokens)


def unigrams(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens ^ UNIGRAM)


def block_rows(docs: DataFrame) -> DataFrame:
    """One row for each block, its documents and their tokens; n is the number of documents, segment that of tokens.

    ``docs`` has (doc_id, text, train).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        hashes: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        chars = n_docs = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, chars, n_docs
            block = (part << 24) | number
            tokens, counts = np.concatenate(hashes), np.concatenate(sizes)
            ids, train = (np.concatenate([k[i] for k in keys]) for i in range(2))
            number, chars, n_docs = number + 1, 0, 0
            hashes.clear(), sizes.clear(), keys.clear()
            about = np.concatenate([ids, counts, train]).astype("<i8").tobytes()
            return _batch([DOCUMENTS], [block], [len(tokens)], [len(ids)], [about + _numbered(tokens)])

        for batch in batches:
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                tokens, counts = _with_ends(*word_hashes(texts))
                hashes.append(tokens)
                sizes.append(counts)
                keys.append(tuple(batch.column(c).slice(first, len(texts)).to_numpy() for c in ("doc_id", "train")))
                chars, n_docs = chars + sum(map(len, texts)), n_docs + len(texts)
                if chars > BLOCK_CHARS or n_docs > BLOCK_DOCS // 2:
                    yield flush()
        if hashes:
            yield flush()

    return docs.mapInArrow(run, ROWS)


def _batch(kind, block, segment, n, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kind, pa.int32()),
            pa.array(block, pa.int64()),
            pa.array(segment, pa.int32()),
            pa.array(n, pa.int64()),
            pa.array(data, pa.binary()),
        ],
        names=["kind", "block", "segment", "n", "data"],
    )


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of unsigned values, all first bytes, then all second ones: packs well."""
    raw = np.ascontiguousarray(values)
    return raw.view(np.uint8).reshape(len(raw), raw.itemsize)[:, :width].T.tobytes()


def _from_planes(data: bytes, n: int, width: int, kind: str) -> np.ndarray:
    wide = np.zeros((n, np.dtype(kind).itemsize), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(width, n).T
    return wide.reshape(-1).view(kind)


def _numbered(tokens: np.ndarray) -> bytes:
    """The distinct tokens, frequent ones first, and the number of each token among them."""
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    often = np.diff(np.append(begins, len(ranked)))
    by_count = np.argsort(-often, kind="stable")
    number = np.empty(len(begins), dtype="<u4")
    number[by_count] = np.arange(len(begins), dtype="<u4")
    numbers = np.empty(len(tokens), dtype="<u4")
    numbers[order] = np.repeat(number, often)
    packed = pa.compress(_planes(numbers, 4), codec="zstd", asbytes=True)
    return np.array([len(begins), len(tokens)], "<i8").tobytes() + ranked[begins][by_count].astype("<u8").tobytes() + packed


@dataclass
class Block:
    """The documents of a block, their tokens as numbers of the distinct ones, and its distinct n-grams."""

    ids: np.ndarray
    counts: np.ndarray
    train: np.ndarray
    distinct: np.ndarray
    numbers: np.ndarray
    codes: np.ndarray  # of its distinct n-grams, sorted by segment and key
    pairs: np.ndarray  # for each token the place of its bigram in codes
    alone: np.ndarray  # for each distinct token, and START as the last, the place of its unigram

    @staticmethod
    def read(n: int, data: bytes, segments: int) -> Block:
        ids, counts, train = np.frombuffer(data, dtype="<i8", count=3 * n).reshape(3, n)
        n_distinct, n_tokens = np.frombuffer(data, dtype="<i8", count=2, offset=24 * n).tolist()
        distinct = np.frombuffer(data, dtype="<u8", count=n_distinct, offset=24 * n + 16)
        packed = memoryview(data)[24 * n + 16 + 8 * n_distinct :]
        planes = pa.decompress(packed, decompressed_size=4 * n_tokens, codec="zstd", asbytes=True)
        numbers = _from_planes(planes, n_tokens, 4, "<u4")
        segment, keys = located(np.concatenate([bigrams(distinct[numbers], counts), unigrams(np.append(distinct, START))]), segments)
        codes, back = np.unique((segment.astype(np.uint64) << np.uint64(KEY_BITS)) | keys, return_inverse=True)
        return Block(ids, counts, train, distinct, numbers, codes, back[:n_tokens], back[n_tokens:])

    def training_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct token and of each code, the count in training documents."""
        n = len(self.codes)
        learned = np.repeat(self.train, self.counts)
        tokens = np.bincount(self.numbers, weights=learned, minlength=len(self.distinct))
        alone = np.append(tokens, self.train.sum())
        ngrams = np.bincount(self.pairs, weights=learned, minlength=n) + np.bincount(self.alone, weights=alone, minlength=n)
        return tokens.astype(np.int64), ngrams.astype(np.int64)

    def token_order(self, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct tokens' places sorted by segment and hash, and the segments in that order."""
        segment = located(self.distinct, segments)[0]
        order = np.lexsort([self.distinct, segment])
        return order, segment[order]

    def base_scores(self, c: np.ndarray, n_tokens: int, n_distinct: int) -> tuple[np.ndarray, np.ndarray]:
        """(n_known, base score) of each text from the counts of the distinct tokens."""
        begins = np.cumsum(self.counts) - self.counts
        logs = np.log10((c + 0.5) / (n_tokens + 0.5 * (n_distinct + 1)))
        return np.add.reduceat((c > 0).astype(np.int64)[self.numbers], begins), np.add.reduceat(logs[self.numbers], begins)

    def scores(self, levels: np.ndarray, n_tokens: int, n_distinct: int) -> np.ndarray:
        """log10 probability of each text with its end, from the levels of the codes."""
        begins = np.cumsum(self.counts) - self.counts
        left = np.empty(len(self.numbers), dtype=np.int64)
        left[1:] = self.numbers[:-1]
        left[begins] = len(self.alone) - 1
        estimated = LEVEL_COUNT[levels]
        single = estimated[self.alone]
        before = single[left]
        alone = np.minimum((single + 0.5) / (n_tokens + 0.5 * (n_distinct + 1)), 1.0)[self.numbers]
        both = np.minimum(estimated[self.pairs], before)
        return np.add.reduceat(np.log10(np.minimum(1.0, (both + MU * alone) / (before + MU))), begins)


def block_scores(rows: DataFrame, segments: int, n_tokens: int, n_distinct: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) from the blocks and what the segments sent back."""

    def close(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        about = parts[parts["kind"] == DOCUMENTS].iloc[0]
        block = Block.read(int(about["n"]), about["data"], segments)
        parts = parts.sort_values("segment")
        tokens, ngrams = (parts[parts["kind"] == k] for k in (TOKENS, NGRAMS))
        c = np.empty(len(block.distinct), dtype=np.int64)
        c[block.token_order(segments)[0]] = np.concatenate([_numbers_from(d, n, 8) for d, n in zip(tokens["data"], tokens["n"])])
        levels = np.concatenate([_numbers_from(d, n, 1) for d, n in zip(ngrams["data"], ngrams["n"])])
        known, base = block.base_scores(c, n_tokens, n_distinct)
        scores = block.scores(levels, n_tokens, n_distinct)
        return pd.DataFrame({"doc_id": block.ids, "n_tokens": block.counts, "n_known": known, "base_score": base, "score": scores})

    return rows.groupBy("block").applyInPandas(
        close, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


# --- the filter


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Quantised log counts: 1 + floor(log(count)), 0 for 0."""
    logs = np.floor(np.log(np.maximum(counts, 1)) / np.log(LOG_BASE) + 1e-9)
    return np.where(counts > 0, 1 + np.minimum(logs, MAX_LEVEL - 1), 0).astype(np.int64)


LEVEL_COUNT = np.concatenate([[0.0], [(LOG_BASE**j + LOG_BASE ** (j + 1) - 1) / 2 for j in range(MAX_LEVEL)]])
LEVEL_COUNT[1] = 1.0


@dataclass
class CountFilter:
    """Segments of a log-frequency Bloom filter, ``bits`` bits each."""

    bits: int
    segments: int
    data: np.ndarray  # bytes of all segments, one after the other

    def places(self, segment: np.ndarray, keys: np.ndarray, level: int | np.ndarray, probe: int) -> np.ndarray:
        hashed = mix(keys + np.asarray(level, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        step = (hashed >> np.uint64(32)) | np.uint64(1)
        at = ((hashed & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * step) % np.uint64(self.bits)
        return segment * np.int64(self.bits) + at.astype(np.int64)

    def levels(self, ngrams: np.ndarray) -> np.ndarray:
        """The level of each n-gram, by probing level after level until one is missing."""
        return self.probed(*located(ngrams, self.segments))

    def probed(self, segment: np.ndarray, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), dtype=np.int64)
        alive = np.arange(len(keys))
        for level in range(1, MAX_LEVEL + 1):
            for probe in range(PROBES):
                at = self.places(segment[alive], keys[alive], level, probe)
                alive = alive[(self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                if not len(alive):
                    return found
            found[alive] = level
        return found


def filled(bits: int, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A segment with each key put in for every level up to its own."""
    flags = np.zeros(bits, dtype=np.uint8)
    layout = CountFilter(bits, 1, flags)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        for probe in range(PROBES):
            flags[layout.places(np.int64(0), own, level, probe)] = 1
    return np.packbits(flags, bitorder="little")


def located(ngrams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and key of n-gram hashes; the key keeps ``KEY_BITS`` bits."""
    return (
        ((ngrams >> np.uint64(KEY_BITS)) % np.uint64(segments)).astype(np.int64),
        ngrams & np.uint64((1 << KEY_BITS) - 1),
    )


def _numbers(values: np.ndarray, width: int) -> bytes:
    return pa.compress(_planes(values.astype("<u8"), width), codec="zstd", asbytes=True)


def _numbers_from(data: bytes, n: int, width: int) -> np.ndarray:
    n = int(n)
    return _from_planes(pa.decompress(data, decompressed_size=width * n, codec="zstd", asbytes=True), n, width, "<i8")


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, with their counts."""
    steps = np.diff(keys.astype("<u8"), prepend=np.uint64(0))
    return np.array([len(keys)], dtype="<u4").tobytes() + _numbers(np.concatenate([steps, counts.astype("<u8")]), 8)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, dtype="<u4", count=1)[0])
    both = _numbers_from(memoryview(data)[4:], 2 * n, 8)
    return np.cumsum(both[:n].view("<u8"), dtype=np.uint64), both[n:]


def segment_rows(blocks: DataFrame, segments: int) -> DataFrame:
    """For each block and segment the block's distinct tokens and n-grams, in training documents or not, with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, n, data in zip(*(batch.column(c) for c in ("block", "n", "data"))):
                block = Block.read(n.as_py(), data.as_py(), segments)
                tokens, ngrams = block.training_counts()
                order, own = block.token_order(segments)
                keys = block.codes & np.uint64((1 << KEY_BITS) - 1)
                for kind, segment, keys, counts in (
                    (TOKENS, own, block.distinct[order], tokens[order]),
                    (NGRAMS, (block.codes >> np.uint64(KEY_BITS)).astype(np.int64), keys, ngrams),
                ):
                    begins = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
                    ends = np.append(begins[1:], len(segment))
                    packed = [_packed(keys[a:b], counts[a:b]) for a, b in zip(begins, ends)]
                    m = len(begins)
                    yield _batch(np.full(m, kind), np.full(m, number.as_py()), segment[begins], ends - begins, packed)

    return blocks.mapInArrow(run, ROWS)


def segment_levels(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The levels that a segment's filter, built from all counts of its distinct n-grams, gives for them."""
    levels = levels_of(counts)
    bits = 8 * max(64, int(levels.sum()) * BITS // 8 + 1)
    held = CountFilter(bits, 1, filled(bits, keys, levels))
    return held.probed(np.zeros(len(keys), dtype=np.int64), keys)


def segment_answers(rows: DataFrame) -> DataFrame:
    """For each row of a block and segment the counts of its tokens or the levels of its n-grams, in the row's order."""

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        answers = {"kind": [], "block": [], "n": [], "data": []}
        known = learned = 0
        for kind, width in ((TOKENS, 8), (NGRAMS, 1)):
            own = parts[parts["kind"] == kind]
            if not len(own):
                continue
            found = [_unpacked(d) for d in own["data"]]
            keys, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            # Sums of whole numbers, exact below 2^53.
            counts = np.bincount(back, weights=np.concatenate([f[1] for f in found])).astype(np.int64)
            if kind == TOKENS:
                known, learned = int((counts > 0).sum()), int(counts.sum())
            values = (counts if kind == TOKENS else segment_levels(keys, counts))[back]
            ends = np.cumsum(own["n"])
            answers["kind"] += [kind] * len(own)
            answers["block"] += own["block"].tolist()
            answers["n"] += own["n"].tolist()
            answers["data"] += [_numbers(values[e - n : e], width) for n, e in zip(own["n"], ends)]
        for name, value in (("kind", VOCABULARY), ("block", learned), ("n", known), ("data", None)):
            answers[name].append(value)
        return pd.DataFrame({"kind": answers["kind"], "block": answers["block"], "segment": int(key[0]), "n": answers["n"], "data": answers["data"]})

    return rows.groupBy("segment").applyInPandas(merge, ROWS)


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per document.

    Learns from documents outside the held fold of the key's crc32.
    """
    rows = narrow(docs)
    rows = rows.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce((fold(F.col("doc_id"), folds) != held).cast("int"), F.lit(0)).alias("train"),
    )
    blocks = saved(block_rows(rows), "token-blocks")
    sizes = blocks.agg(F.count("block"), F.sum("segment")).first()
    n_blocks, segments = max(1, sizes[0]), max(1, -(-(sizes[1] or 0) // SEGMENT_TOKENS))
    by_segment = segment_rows(blocks, segments).repartition(segments, "segment")
    answers = saved(segment_answers(by_segment), "segment-answers")
    totals = answers.where(F.col("kind") == VOCABULARY).agg(F.sum("n"), F.sum("block")).first()
    n_distinct, n_tokens = int(totals[0] or 0), int(totals[1] or 0)
    by_block = blocks.unionByName(answers.where(F.col("kind") != VOCABULARY)).repartition(n_blocks, "block")
    scored = block_scores(by_block, segments, n_tokens, n_distinct)
    key = F.when(F.col("doc_id") != NULL_KEY, F.col("doc_id"))
    return scored.select(
        key.alias("doc_id"),
        F.coalesce(fold(key, folds) == held, F.lit(True)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
