"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints. A shingle's XXH64 votes on 64 bits; a bit is 1 if more than half of a
text's shingles (repeats included) have it.

Comparison. Within a block, bit plane p holds bit p of all rows, 64 rows to a word. A
row is compared with all others by flipping each plane by its own bit and adding
the planes into carry-save counters, one addition for 64 distances; a sticky
overflow marks distances beyond the radius, and after every few planes the rows
all of whose words are beyond it are abandoned.

Blocks. Fingerprints within a radius r agree on all bits of some choice of
``PARTS - r`` out of ``PARTS`` parts. Each distinct fingerprint is keyed by every such choice and keyed rows are
sorted, so rows of a key stand together; runs of small keys share a block,
which only adds comparisons. A block returns a spanning forest of its links, never
all pairs. A key with more than ``BLOCK_ROWS`` fingerprints is cut into several blocks;
links between these come from the fingerprints' neighbourhoods: two fingerprints are within
radius r exactly if some value is within r // 2 of one and r - r // 2 of the
other, and rows that meet in a value are linked to the smallest, which is an
aggregation that grows with the rows. Components of the links are found by joins.

Defined results: a text without a word has fingerprint 0, is linked like any other;
NULL texts are empty; documents with a NULL key get a fingerprint
and a component but never name one (a component of such documents only has a
NULL name); repeated rows are separate rows of one component; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, narrow, saved, text_chunks
from tidemart.llm.components import components

BITS = 64
SEED = 42
WORDS = 3
RADIUS = 2
PARTS = 4
BLOCK_ROWS = 2048
ABANDON_EVERY = 8
CHUNK_CHARS = 1 << 18


# --- fingerprints


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text, A-Z lower-cased; the whole sequence if shorter."""
    own = text.encode().lower().split()
    if not own:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(own)
    sizes = np.array([len(w) for w in own])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    n = max(1, len(own) - words + 1)
    ends = (begins + sizes)[min(words, len(own)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashed = [digest(joined[a:b], SEED) for a, b in zip(begins[:n].tolist(), ends.tolist())]
    return np.array(hashed, dtype=np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive groups of hashes, the bits set in over half of each group; 0 for an empty one."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    if not len(hashes):
        return out
    held = np.flatnonzero(sizes)
    begins = (np.cumsum(sizes) - sizes)[held]
    for bit in range(BITS):
        ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.uint32), begins)
        out[held] |= (2 * ones.astype(np.int64) > sizes[held]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every whole text, the fingerprint as a signed 64-bit integer."""
    rows = narrow(docs, id_column, text_column)
    rows = rows.withColumn("text_hash", text_hash(F.col("text")))

    def make():
        def step(batch: pa.RecordBatch):
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                hashes = [shingle_hashes(t, words) for t in texts]
                fps = majority(np.concatenate(hashes), np.array([len(h) for h in hashes]))
                same = {c: batch.column(c).slice(first, len(texts)) for c in ("doc_id", "text_hash")}
                yield {**same, "fp": fps.view(np.int64)}

        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"doc_id {key}, text_hash long, fp long")


def text_hash(text: Column) -> Column:
    """Tells the texts of repeated keys apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


# --- bit-sliced comparison


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(BITS, words): bit r of word w of plane p is bit p of row 64 * w + r."""
    padded = np.zeros(-(-len(fps) // 64) * 64, dtype=np.uint64)
    padded[: len(fps)] = fps
    bits = (padded[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")
    return packed.view("<u8")


def close_pairs(fps: np.ndarray, radius: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j and i >= first, of all rows within the radius of each other."""
    planes = bit_planes(fps)
    n_words = planes.shape[1]
    n_counters = max(1, radius.bit_length())
    left, right = [], []
    # A slab of rows at a time keeps counters in cache: rows x words numbers each.
    slab = max(64, (1 << 15) // n_words)
    for start in range(first, len(fps), slab):
        rows = np.arange(start, min(start + slab, len(fps)))
        counters = [np.zeros((len(rows), n_words), dtype=np.uint64) for _ in range(n_counters)]
        beyond = np.zeros((len(rows), n_words), dtype=np.uint64)
        # Rows that pad the last word, and those up to the row itself, are out from the start.
        number = np.arange(n_words) * 64
        done = np.clip(rows[:, None] + 1 - number[None, :], 0, 64)
        beyond |= np.where(done >= 64, ~np.uint64(0), (np.uint64(1) << (done & 63).astype(np.uint64)) - np.uint64(1))
        tail = len(fps) - number[-1]
        if tail < 64:
            beyond[:, -1] |= ~np.uint64(0) << np.uint64(tail)
        for plane in range(BITS):
            own = np.where((fps[rows] >> np.uint64(plane)) & np.uint64(1) == 1, ~np.uint64(0), np.uint64(0))
            carry = planes[plane][None, :] ^ own[:, None]
            for c in range(n_counters):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            beyond |= carry
            if plane % ABANDON_EVERY == ABANDON_EVERY - 1:
                beyond |= _over(counters, radius)
                alive = (beyond != ~np.uint64(0)).any(axis=1)
                if not alive.all():
                    rows, beyond = rows[alive], beyond[alive]
                    counters = [c[alive] for c in counters]
                if not len(rows):
                    break
        if len(rows):
            near = ~(beyond | _over(counters, radius))
            at, word = np.nonzero(near)
            bits = np.unpackbits(near[at, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            hit, bit = np.nonzero(bits)
            left.append(rows[at[hit]])
            right.append(word[hit] * 64 + bit)
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters' value is above the radius, bit by bit from the top."""
    over, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for c in range(len(counters) - 1, -1, -1):
        if (radius >> c) & 1:
            equal &= counters[c]
        else:
            over |= equal & counters[c]
            equal &= ~counters[c]
    return over


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[int]:
    """For each of ``n`` rows the smallest row linked to it, directly or not."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(left.tolist(), right.tolist()):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- links


def part_keys(fp: Column, radius: int, parts: int) -> Column:
    """An array of (choice, key): for each choice of parts - radius parts, the fingerprint with the others cleared."""
    edges = [BITS * i // parts for i in range(parts + 1)]
    keys = []
    for number, kept in enumerate(combinations(range(parts), parts - radius)):
        mask = sum(((1 << (edges[p + 1] - edges[p])) - 1) << edges[p] for p in kept)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def linked_blocks(keyed: DataFrame, radius: int) -> DataFrame:
    """(a, b): links among rows (choice, key, fp) that share a choice and key, a spanning forest per block.

    Rows must be grouped by (choice, key) within sorted partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, dtype=np.uint64)

        def links(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            fps = np.unique(fps)
            root = forest(len(fps), *close_pairs(fps, radius))
            own = np.flatnonzero(np.array(root) != np.arange(len(fps)))
            if len(own):
                ends = fps.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends[own]), pa.array(ends[np.array(root)[own]])], names=["a", "b"]
                )

        for fps in _runs(batches):
            if len(held) and len(held) + len(fps) > BLOCK_ROWS:
                yield from links(held)
                held = np.empty(0, dtype=np.uint64)
            held = np.concatenate([held, fps])
        if len(held) > 1:
            yield from links(held)

    return keyed.mapInArrow(run, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of each key with two or more rows, at most BLOCK_ROWS at a time.

    Many small keys are returned together, as long as none is cut.
    """
    rest = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("choice", "key", "fp")]
        if rest is not None:
            columns = [np.concatenate([r, c]) for r, c in zip(rest, columns)]
        choice, key, fp = columns
        if not len(fp):
            continue
        begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (choice[1:] != choice[:-1])]))
        # The last key may go on in the next batch.
        last = begins[-1] if len(fp) - begins[-1] < BLOCK_ROWS else len(fp)
        yield from _packs(begins[begins < last], last, fp)
        rest = [c[last:] for c in (choice, key, fp)]
    if rest is not None and len(rest[2]) > 1:
        yield rest[2].view(np.uint64)


def _packs(begins: np.ndarray, end: int, fp: np.ndarray) -> Iterator[np.ndarray]:
    ends = np.append(begins[1:], end)
    several = ends - begins > 1
    begins, ends = begins[several], ends[several]
    fps = fp.view(np.uint64)
    pack, size = [], 0
    for a, b in zip(begins.tolist(), ends.tolist()):
        for start in range(a, b, BLOCK_ROWS):
            part = fps[start : min(start + BLOCK_ROWS, b)]
            if size + len(part) > BLOCK_ROWS and pack:
                yield np.concatenate(pack)
                pack, size = [], 0
            pack.append(part)
            size += len(part)
    if pack:
        yield np.concatenate(pack)


def neighbourhood_links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that connect all fingerprints within the radius, by the values around each.

    Values within ``ceil(radius / 2)`` of a fingerprint are listed; those
    within the smaller ``radius // 2`` are marked. A marked row and any other that meet in a value are
    within the radius, so all rows of a value with a marked one are linked to the smallest marked.
    """
    near, far = radius // 2, radius - radius // 2
    flips = [sum(1 << b for b in bits) for n in range(far + 1) for bits in combinations(range(BITS), n)]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    around = F.array(*[F.lit(s) for s in signed])
    marked = F.bit_count("flip") <= near
    spread = fps.select("fp", F.explode(around).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), marked.alias("marked")
    )
    least = spread.groupBy("value").agg(
        F.min(F.when(F.col("marked"), F.col("fp"))).alias("b"), F.count("*").alias("rows")
    )
    met = least.where((F.col("rows") > 1) & F.col("b").isNotNull()).select("value", "b")
    return spread.join(met, "value").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b").distinct()


def near_links(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (fp) within the radius of each other."""
    keyed = fps.select("fp", F.explode(part_keys(F.col("fp"), radius, parts)).alias("k")).select(
        F.col("k.choice").alias("choice"), F.col("k.key").alias("key"), "fp"
    )
    crowded = keyed.groupBy("choice", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_ROWS)
    hot = keyed.join(crowded.select("choice", "key"), ["choice", "key"], "left_semi").select("fp").distinct()
    placed = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")
    return linked_blocks(placed, radius).union(neighbourhood_links(hot, radius))


def linked_classes(rows: DataFrame, radius: int, parts: int) -> DataFrame:
    """(fp, component) for each distinct fp of ``rows`` that has a link; the component is its smallest fp."""
    links = near_links(rows.select("fp").distinct(), radius, parts)
    return components(links).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links within the radius."""
    rows = saved(fingerprints(docs, words), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = linked_classes(rows, radius, parts)
    placed = classes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    parts: int = PARTS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the one of the smallest key, NULL last.

    Who stays is settled on narrow rows; texts move once, to meet the decisions. Of repeated
    rows (equal key and text) one stays.
    """
    rows = saved(fingerprints(docs, words, id_column, text_column), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (
        first.join(linked_classes(rows, radius, parts), "fp", "left")
        .groupBy(F.coalesce("component", "fp"))
        .agg(F.min("first").alias("first"))
        .select(_row_key(F.col("first.doc_id")).alias("__key"), F.col("first.text_hash").alias("__hash"))
    )
    place = ["__hash", "__key"]
    marked = docs.withColumns({"__hash": text_hash(F.col(f"`{text_column}`")), "__key": _row_key(F.col(f"`{id_column}`"))})
    same = Window.partitionBy(*place).orderBy("__hash")
    stays = marked.join(kept, place, "left_semi").withColumn("__nth", F.row_number().over(same))
    return stays.where(F.col("__nth") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def _row_key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("NULL"))
