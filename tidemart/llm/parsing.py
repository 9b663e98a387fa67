"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases by deterministic coin tossing. After equal
neighbours are joined into runs, each symbol is compared with its left neighbour:
twice the place of the lowest bit in which they differ, plus that bit, is a label of few
bits that still differs between neighbours. Four rounds leave at most six
labels. Phrases begin where the label is a local maximum, so a cut depends on
a few symbols around it and not on its offset in the text. A phrase's name is a hash of
its symbols (with their run lengths); the names are the symbols of the next
level, until one is left. Equal substrings share all names but those near their ends, on every level.

The fingerprint is the name of the root and, for ``BINS`` bins of the names of
level two and above, 16 bits of the smallest name: 16 and 4 * BINS
characters. The likeness of two fingerprints is the share of agreeing bins among
those filled in either, an estimate of how much of their phrases two texts share.

The edited text of the query needs the next document by key. Keys are cut into ranges at approximate
quantiles; the first document of a range is also sent to the range before it (that of the first range to the last), so
one shuffle brings each document and its successor together, no task sees more than its ranges, and
only one key per range reaches the driver.

Defined results: NULL and empty texts have the fingerprint of nothing, root 0
and all bins empty; two of those are alike to 1, one and any other to 0. NULL
keys come first; equal keys are ordered by text. The only document of a table is its own successor. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, narrow, shuffle_partitions

BINS = 64
EMPTY = "...."
CHUNK_CHARS = 1 << 19
RANGES_PER_PARTITION = 4
NULL_KEY = -(1 << 63)
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_RUN = np.uint64(0xC2B2AE3D27D4EB4F)
ODD_NAME = np.uint64(0xD6E8FEB86659FD93)
# Longest phrase: labels 0 to 5 rise and fall at most that far between two maxima.
POWERS = np.cumprod(np.append(np.uint64(1), np.full(63, 0x165667B19E3779F9, dtype=np.uint64)), dtype=np.uint64)


def _toss_table(size: int) -> np.ndarray:
    """Label of a symbol by (left neighbour, symbol), for symbols below ``size``."""
    left, own = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    differ = left ^ own
    place = np.zeros_like(differ)
    for bit in range(size.bit_length() - 1, -1, -1):
        place[(differ >> bit) & 1 == 1] = bit
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


BYTE_TOSS = _toss_table(256)
LABEL_TOSS = _toss_table(128)


def _mix(names: np.ndarray) -> np.ndarray:
    names = (names ^ (names >> np.uint64(32))) * ODD_NAME
    names = (names ^ (names >> np.uint64(32))) * ODD_NAME
    return names ^ (names >> np.uint64(32))


def _tossed(labels: np.ndarray, starts: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    index = np.empty(len(labels), dtype=np.uint16)
    np.multiply(labels[:-1], size, out=index[1:], dtype=np.uint16, casting="unsafe")
    # A text's first symbol is compared with one that differs in the lowest bit.
    index[starts] = (labels[starts] ^ 1).astype(np.uint16) * np.uint16(size)
    index += labels
    return table.take(index)


def _labels(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 that differ between neighbours of one text."""
    if symbols.dtype == np.uint8:
        labels = _tossed(symbols, starts, BYTE_TOSS, 256)
    else:
        left = np.empty_like(symbols)
        left[1:] = symbols[:-1]
        left[starts] = symbols[starts] ^ np.uint64(1)
        differ = symbols ^ left
        lowest = differ & (~differ + np.uint64(1))
        place = np.bitwise_count(lowest - np.uint64(1)).astype(np.uint8)
        labels = (2 * (place & 63) + ((symbols & lowest) != 0)).astype(np.uint8)
    for _ in range(3):
        labels = _tossed(labels, starts, LABEL_TOSS, 128)
    return labels


def next_level(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and where each text's begin."""
    fresh = np.empty(len(symbols), dtype=bool)
    np.not_equal(symbols[1:], symbols[:-1], out=fresh[1:])
    fresh[starts] = True
    runs = None
    if not fresh.all():
        at = np.flatnonzero(fresh)
        runs = np.diff(np.append(at, len(symbols)))
        starts = np.searchsorted(at, starts)
        symbols = symbols[at]
    labels = _labels(symbols, starts)
    # A text's first symbol always begins a phrase, so it is no bar to the second.
    higher = np.empty(len(labels), dtype=bool)
    np.greater(labels[1:], labels[:-1], out=higher[1:])
    higher[starts] = True
    cut = higher.copy()
    cut[:-1] &= ~higher[1:]
    cut[np.append(starts[1:], len(labels)) - 1] = False
    cut[starts] = True
    begins = np.flatnonzero(cut)
    offset = np.arange(len(symbols)) - np.repeat(begins, np.diff(np.append(begins, len(symbols))))
    values = _mix(symbols.astype(np.uint64) * ODD + np.uint64(1))
    if runs is not None:
        values += (runs.astype(np.uint64) - np.uint64(1)) * ODD_RUN
    values = _mix(values) * POWERS.take(offset & 63)
    return _mix(np.add.reduceat(values, begins) + np.uint64(1)), np.searchsorted(begins, starts)


def parse(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(root name, smallest name by bin) of each text; the bins are 64-bit names, all ones if empty."""
    roots = np.zeros(len(texts), dtype=np.uint64)
    bins = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    alive = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
    if not len(alive):
        return roots, bins.reshape(len(texts), BINS)
    sizes = np.array([len(texts[i]) for i in alive])
    symbols = np.frombuffer(b"".join([texts[i] for i in alive]), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    level = 0
    while len(alive):
        symbols, starts = next_level(symbols, starts)
        level += 1
        sizes = np.diff(np.append(starts, len(symbols)))
        if level >= 2:
            slot = np.repeat(alive, sizes) * BINS + (symbols >> np.uint64(58)).astype(np.int64)
            np.minimum.at(bins, slot, symbols)
        done = sizes == 1
        if done.any():
            names = symbols[starts[done]]
            roots[alive[done]] = names
            slot = alive[done] * BINS + (names >> np.uint64(58)).astype(np.int64)
            np.minimum.at(bins, slot, names)
            symbols = symbols[np.repeat(~done, sizes)]
            alive, sizes = alive[~done], sizes[~done]
            starts = np.cumsum(sizes) - sizes
    return roots, bins.reshape(len(texts), BINS)


def _printed(roots: np.ndarray, bins: np.ndarray) -> list[str]:
    filled = bins != np.iinfo(np.uint64).max
    short = ((bins >> np.uint64(20)) & np.uint64(0xFFFF)).astype(">u2")
    out = []
    for root, own, held in zip(roots, short, filled):
        text = own.tobytes().hex()
        if not held.all():
            text = "".join([text[4 * i : 4 * i + 4] if h else EMPTY for i, h in enumerate(held)])
        out.append(f"{int(root):016x}{text}")
    return out


def fingerprints(texts: list[str]) -> list[str]:
    return _printed(*parse([t.encode() for t in texts]))


def likeness(one: str, other: str) -> float:
    """Share of agreeing bins among those filled in either fingerprint; 1 for equal ones."""
    if one == other:
        return 1.0
    pairs = [(one[i : i + 4], other[i : i + 4]) for i in range(16, len(one), 4)]
    filled = [p for p in pairs if p != (EMPTY, EMPTY)]
    return sum(a == b for a, b in filled) / len(filled) if filled else 0.0


def _alike(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``likeness`` of each row's two parses, on arrays."""
    top = np.iinfo(np.uint64).max
    (root_a, a), (root_b, b) = one, other
    short_a, short_b = (a >> np.uint64(20)) & np.uint64(0xFFFF), (b >> np.uint64(20)) & np.uint64(0xFFFF)
    both = (a != top) & (b != top)
    either = ((a != top) | (b != top)).sum(axis=1)
    same = (both & (short_a == short_b)).sum(axis=1)
    equal = (root_a == root_b) & (same == either)
    return np.where(equal, 1.0, same / np.maximum(1, either))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text."""
    rows = narrow(docs)

    def make():
        from tidemart.llm.common import text_chunks

        def step(batch: pa.RecordBatch):
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                yield {
                    "doc_id": batch.column("doc_id").slice(first, len(texts)),
                    "n_chars": [len(t) for t in texts],
                    "fingerprint": fingerprints(texts),
                }

        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"doc_id {key}, n_chars long, fingerprint string")


def with_successors(docs: DataFrame) -> DataFrame:
    """(bucket, is_next, doc_id, text): each bucket's documents, then the one that follows its last.

    Partitions hold whole buckets, sorted by these columns.
    """
    spark = docs.sparkSession
    rows = narrow(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("doc_id"), "text")
    ranges = shuffle_partitions(spark) * RANGES_PER_PARTITION
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0]
    splits = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splits, keys.to_numpy(), side="right").astype(np.int32))

    firsts = rows.select("doc_id", bucket_of("doc_id").alias("bucket")).groupBy("bucket").agg(F.min("doc_id").alias("key"))
    # One row per range, a bounded number.
    heads = sorted((r["bucket"], r["key"]) for r in firsts.collect())
    previous = {key: heads[i - 1][0] for i, (_, key) in enumerate(heads)}
    shared = spark.sparkContext.broadcast(previous)

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        held = shared.value
        own = np.searchsorted(splits, keys.to_numpy(), side="right").tolist()
        return pd.Series([[b, held[k]] if k in held else [b] for b, k in zip(own, keys.tolist())])

    spread = rows.select("doc_id", "text", F.posexplode(places("doc_id")).alias("is_next", "bucket"))
    return (
        spread.select("bucket", "is_next", "doc_id", "text")
        .repartition(shuffle_partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "is_next", "doc_id", "text")
    )


def _pairs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list[int], list[str], list[str]]]:
    """Keys, texts and next texts, in groups of about ``limit`` characters."""
    keys, texts, nexts, size = [], [], [], 0
    pending = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "is_next", "doc_id", "text")]
        for bucket, is_next, key, text in zip(*columns):
            text = text or ""
            if pending is not None and pending[0] == bucket:
                keys.append(pending[1])
                texts.append(pending[2])
                nexts.append(text)
                size += 2 * len(pending[2]) + len(text)
            # A successor itself is only looked at, and only the first one.
            pending = None if is_next else (bucket, key, text)
            if size > limit:
                yield keys, texts, nexts
                keys, texts, nexts, size = [], [], [], 0
    if keys:
        yield keys, texts, nexts


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited form, and their likeness to each other and to the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, nexts in _pairs(batches, CHUNK_CHARS):
            changed = [edited(t, n) for t, n in zip(texts, nexts)]
            raw = [e.encode() for e in changed]
            own, other = parse([t.encode() for t in texts]), parse(raw)
            # The next row's text is the next text, but for the last row of a bucket.
            lone = [i for i, n in enumerate(nexts) if i + 1 == len(texts) or n is not texts[i + 1]]
            extra = parse([nexts[i].encode() for i in lone])
            following = [np.concatenate([a[1:], a[:1]]) for a in own]
            for a, b in zip(following, extra):
                a[lone] = b
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if k == NULL_KEY else k for k in keys], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.array(_printed(*own)),
                    pa.array(_printed(*other)),
                    pa.array(_alike(own, other)),
                    pa.array(_alike(own, tuple(following))),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return with_successors(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
