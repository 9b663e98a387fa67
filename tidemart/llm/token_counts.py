"""Token counts of a sentencepiece BPE model without materialising ids.

No piece of such a model goes on after a word boundary, so a text's count is the
sum of the counts of its pre-tokens (a run of spaces with the word after it).
Documents form blocks of about ``CHUNK_CHARS`` characters, written once: each block's distinct pre-tokens and
the documents' frequencies of them. The pre-tokens of all blocks meet in segments by hash, where each
distinct one is tokenised once; its number of pieces goes back to the blocks that asked, and is joined
to the frequencies and summed. No ids are kept anywhere.

Blocks, requests and answers are bounded by the block's size, a segment by its distinct pre-tokens: there are enough
segments for about ``SEGMENT_WORDS`` each.

Defined results: a NULL text counts as the empty one, 0 bytes and 0 tokens;
repeated rows are separate rows; an empty table gives an empty result; extra columns
are ignored. Texts are counted whole, whatever their length.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemart.llm.common import map_batches, narrow, saved, shuffle_partitions, text_chunks

LIMIT = 4096
CHUNK_CHARS = 1 << 22
SEGMENT_WORDS = 1 << 19
REQUESTS = "segment long, block long, n long, data binary"
# Fixed value: the character that stands for a space inside the model.
SPACE = "▁"
RUNS = re.compile(r" +[^ ]*")


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # A piece with a space after something else would cross pre-tokens.
        crossing = [p for p in pieces if SPACE in p.lstrip(SPACE)]
        # The model must add one space before a text and keep all others.
        plain, spaced = self.model.encode("a"), self.model.encode(" a")
        splits = not crossing and len(spaced) == 2 and spaced[1:] == plain and not self.model.encode("")
        self.cut = self._runs if splits else self._whole

    @staticmethod
    def _whole(text: str) -> list[str]:
        return [text] if text else []

    @staticmethod
    def _runs(text: str) -> list[str]:
        """Pre-tokens without their first space, which the model adds itself."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [run[1:] for run in RUNS.findall(" " + text)]

    def frequencies(self, text: str) -> Counter:
        return Counter(self.cut(text))

    def sizes(self, pre_tokens: list[str]) -> list[int]:
        """The number of pieces of each pre-token."""
        # The model leaves out an empty string, but here it is a space.
        return [len(ids) if p else 1 for p, ids in zip(pre_tokens, self.model.encode(pre_tokens, num_threads=1))]


@lru_cache(maxsize=2)
def load(path: str) -> PieceCounter:
    return PieceCounter(path)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers with their bytes of equal weight together."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _pack_words(words: list[str]) -> bytes:
    encoded = [w.encode() for w in words]
    sizes = np.array([len(w) for w in encoded], dtype="<u4").tobytes()
    plain = sizes + b"".join(encoded)
    return struct.pack("<Q", len(plain)) + pa.compress(plain, codec="zstd", asbytes=True)


def _unpack_words(data: bytes, n: int) -> list[str]:
    size = struct.unpack_from("<Q", data)[0]
    plain = pa.decompress(memoryview(data)[8:], decompressed_size=size, codec="zstd", asbytes=True)
    ends = np.cumsum(np.frombuffer(plain, dtype="<u4", count=n)).tolist()
    text = plain[4 * n :]
    return [text[a:b].decode() for a, b in zip([0, *ends], ends)]


def frequency_blocks(docs: DataFrame, path: str) -> DataFrame:
    """One row per block: keys and bytes of its documents, its distinct pre-tokens, and each document's frequencies."""
    rows = narrow(docs).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    key = rows.schema["doc_id"].dataType.simpleString()

    def make():
        counter = load(path)
        number = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))

        def step(batch: pa.RecordBatch):
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                names: dict[str, int] = {}
                places, counts, sizes = [], [], []
                for text in texts:
                    table = counter.frequencies(text)
                    own = np.array([names.setdefault(w, len(names)) for w in table], dtype=np.int64)
                    order = np.argsort(own)
                    places.append(np.diff(own[order], prepend=0))
                    counts.append(np.fromiter(table.values(), dtype=np.int64, count=len(table))[order])
                    sizes.append(len(own))
                listed = {c: batch.column(c).slice(first, len(texts)) for c in ("doc_id", "n_bytes")}
                yield {
                    "block": [next(number)],
                    "ids": pa.ListArray.from_arrays([0, len(texts)], listed["doc_id"]),
                    "bytes": pa.ListArray.from_arrays([0, len(texts)], listed["n_bytes"]),
                    "n": [len(names)],
                    "words": [_pack_words(list(names))],
                    "n_rows": [sum(sizes)],
                    "frequencies": [_pack(np.concatenate([np.array(sizes), *places, *counts]))],
                }

        return step

    return map_batches(
        rows, make, f"block long, ids array<{key}>, bytes array<long>, n long, words binary, n_rows long, frequencies binary"
    )


def _segments_of(words: list[str], segments: int) -> np.ndarray:
    digest = xxhash.xxh32_intdigest
    return np.array([digest(w) for w in words], dtype=np.int64) % segments


def word_requests(blocks: DataFrame, segments: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            for block, n, data in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "words"))):
                words = _unpack_words(data, n)
                segment = _segments_of(words, segments)
                order = np.argsort(segment, kind="stable")
                begins = np.flatnonzero(np.diff(segment[order], prepend=-1))
                ends = np.append(begins[1:], n)
                yield {
                    "segment": segment[order[begins]],
                    "block": [block] * len(begins),
                    "n": ends - begins,
                    "data": [_pack_words([words[i] for i in order[a:b]]) for a, b in zip(begins.tolist(), ends.tolist())],
                }

        return step

    return map_batches(blocks.select("block", "n", "words"), make, REQUESTS)


def word_answers(requests: DataFrame, path: str) -> DataFrame:
    """For each request the sizes of its pre-tokens; a segment counts each distinct one once."""
    placed = requests.repartition("segment").sortWithinPartitions("segment")

    def make():
        counter = load(path)
        current, known = None, {}

        def step(batch: pa.RecordBatch):
            nonlocal current
            out = {c: [] for c in ("segment", "block", "n", "data")}
            for segment, block, n, data in zip(*(batch.column(c).to_pylist() for c in out)):
                if segment != current:
                    current = segment
                    known.clear()
                words = _unpack_words(data, n)
                new = [w for w in words if w not in known]
                known.update(zip(new, counter.sizes(new)))
                for c, v in zip(out, (segment, block, n, _pack(np.array([known[w] for w in words])))):
                    out[c].append(v)
            yield out

        step.done = known.clear
        return step

    return map_batches(placed, make, REQUESTS)


def block_totals(blocks: DataFrame, answers: DataFrame, segments: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every document, from the blocks and the answers to their requests."""
    # A block itself comes before its answers.
    rows = blocks.withColumn("segment", F.lit(-1).cast("long")).unionByName(
        answers.select("block", "segment", F.col("n").alias("asked"), "data"), allowMissingColumns=True
    )
    placed = rows.repartition("block").sortWithinPartitions("block", "segment")
    key = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = f"doc_id {key}, n_bytes long, n_tokens long"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def totals(block: dict, parts: list[np.ndarray]) -> pa.RecordBatch:
        n_docs, n_rows = len(block["ids"]), block["n_rows"]
        packed = _unpack(block["frequencies"], n_docs + 2 * n_rows)
        sizes, steps, counts = np.split(packed, [n_docs, n_docs + n_rows])
        ends = np.cumsum(sizes)
        # Places are differences within a document.
        place = np.cumsum(steps)
        before = np.concatenate([[0], place])[ends - sizes]
        place = place - np.repeat(before, sizes)
        value = np.empty(block["n"], dtype=np.int64)
        order = np.argsort(_segments_of(_unpack_words(block["words"], block["n"]), segments), kind="stable")
        value[order] = np.concatenate([np.empty(0, dtype=np.int64), *parts])
        running = np.concatenate([[0], np.cumsum(value[place] * counts)])
        columns = (block["ids"], block["bytes"], running[ends] - running[ends - sizes])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("segment")[at].as_py() < 0:
                    if block is not None:
                        yield totals(block, parts)
                    block, parts = {c: batch.column(c)[at].as_py() for c in batch.schema.names}, []
                else:
                    parts.append(_unpack(batch.column("data")[at].as_py(), batch.column("asked")[at].as_py()))
        if block is not None:
            yield totals(block, parts)

    return placed.mapInArrow(run, schema)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    blocks = saved(frequency_blocks(docs, path), "frequency-blocks")
    asked = blocks.agg(F.sum("n")).first()[0] or 0
    segments = max(shuffle_partitions(docs.sparkSession), -(-asked // segment_words))
    answers = word_answers(word_requests(blocks, segments), path)
    return block_totals(blocks, answers, segments).withColumn("over_limit", F.col("n_tokens") > limit)
