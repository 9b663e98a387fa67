"""MinHash near-duplicates with an LSH forest.

Texts with equal sets of shingles are one class, named by a 128-bit hash of the set; all that follows works on classes.

Forest. A class has ``TREES * DEPTH`` minima of its shingle hashes; each tree orders the classes
by its own ``DEPTH`` of them. Neighbours in an order that share a prefix form a region. Every
region starts at ``LEAST_DEPTH``, where a pair at the similarity shares a region of some tree with
probability 1 - 3e-5; one that is too large for a task goes deeper until its parts fit, and a part too large at
the full depth is cut into chunks of which all pairs form regions of their own.

Candidates. Within a region, classes whose minima agree often enough (``LEAST_EQUAL`` of 128: a pair at the
similarity falls below with probability 2e-6) are linked loosely, as a spanning forest, never as all
pairs. Components of the loose links are clusters. The set of a class is built once more from its text and sent to
its cluster, where all pairs are compared exactly. A cluster too large for a task is split by
the forest again, its sets going to their regions.

Exact comparison. In a cluster the shingles are numbered; a class marks its own, and one pass over
the others' counts all intersections. Classes already connected are compared no further with each other, so a
group of many near copies takes a few passes.

Defined results: a text without a word has the empty set, is linked with nothing and is its own
component; NULL texts likewise; a text with fewer words than a shingle has one shingle, the whole sequence; documents
with a NULL key get a component but never name one; repeated rows are separate rows of one component; an
empty table gives an empty result; extra columns are ignored. Very long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, narrow, saved, text_chunks
from tidemart.llm.components import components
from tidemart.llm.word_hash import mix, word_hashes

WORDS = 5
SIMILARITY = 85
TREES = 8
DEPTH = 16
DEPTHS = (2, 3, 4, 6, 8, 11, DEPTH)
LEAST_EQUAL = 90
VALUE_BYTES = 2
REGION_ROWS = 8192
CLUSTER_ROWS = 4096
CLUSTER_SHINGLES = 1 << 21
# Regions up to this size are compared many at a time.
FEW = 24
CHUNK_CHARS = 1 << 19
NAME_BYTES = 16
_MULTIPLIERS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


# --- sets and minima


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(texts)
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(min(words, len(hashes))):
        rolled[: len(hashes) - k] = mix(rolled[: len(hashes) - k] + hashes[k:] * np.uint64(0x9E3779B97F4A7C15 + 2 * k))
    out, first = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(rolled[first : first + n - words + 1]))
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(hashes[first : first + n].tobytes(), n)], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        first += n
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, TREES * DEPTH) 16-bit minima; all ones for an empty set."""
    out = np.full((len(sets), TREES * DEPTH), 0xFFFF, dtype=">u2")
    held = np.flatnonzero([len(s) for s in sets])
    if len(held):
        flat = np.concatenate([sets[i] for i in held])
        begins = np.cumsum([0, *[len(sets[i]) for i in held[:-1]]])
        for i, (m, s) in enumerate(zip(_MULTIPLIERS, _SHIFTS)):
            # The high half of the smallest; its lower bits tell values apart.
            least = np.minimum.reduceat(flat * m + s, begins)
            out[held, i] = (mix(least) & np.uint64(0xFFFF)).astype(">u2")
    return out


def sketches(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, node, n_shingles, minima) of every whole text; NULL node and minima for an empty set."""
    rows = narrow(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))

    def make():
        def step(batch: pa.RecordBatch):
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                sets = shingle_sets(texts, words)
                values = minima(sets)
                same = {c: batch.column(c).slice(first, len(texts)) for c in ("doc_id", "text_hash")}
                yield {
                    **same,
                    "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "n_shingles": [len(s) for s in sets],
                    "minima": [v.tobytes() if len(s) else None for v, s in zip(values, sets)],
                }

        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"doc_id {key}, text_hash long, node binary, n_shingles long, minima binary")


# --- the forest


def regions(classes: DataFrame, max_rows: int, max_shingles: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(region, node) of all regions with two or more classes, and such rows of the parts too large at full depth.

    Regions are numbered by a hash of tree and prefix. ``classes`` holds (node, n_shingles, minima).
    """
    width = DEPTH * VALUE_BYTES
    trees = F.array(*[
        F.struct(F.lit(t).alias("tree"), F.substring("minima", t * width + 1, width).alias("order")) for t in range(TREES)
    ])
    open_rows = classes.select("node", "n_shingles", F.explode(trees).alias("t")).select("node", "n_shingles", "t.tree", "t.order")
    found = None
    for depth in DEPTHS:
        keyed = open_rows.withColumn("region", F.xxhash64("tree", F.substring("order", 1, depth * VALUE_BYTES)))
        sizes = keyed.groupBy("region").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles"))
        large = F.col("rows") > max_rows
        if max_shingles is not None:
            large = large | ((F.col("shingles") > max_shingles) & (F.col("rows") > 2))
        marked = keyed.join(sizes.where(F.col("rows") > 1).withColumn("large", large), "region")
        marked = saved(marked.select("region", "node", "n_shingles", "tree", "order", "large", "rows", "shingles"), "regions")
        fit = marked.where(~F.col("large")).select("region", "node")
        found = fit if found is None else found.unionByName(fit)
        rest = marked.where("large")
        if rest.isEmpty():
            return found, None
        open_rows = rest.select("node", "n_shingles", "tree", "order")
    return found, rest.select("region", "node", "n_shingles", "rows", "shingles")


def loose_links(found: DataFrame, deep: DataFrame | None, classes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the candidates of each region."""
    placed = (
        found.join(classes.select("node", "minima"), "node").repartition("region").sortWithinPartitions("region", "node")
    )

    def links(region: np.ndarray, rows: dict) -> tuple[np.ndarray, np.ndarray]:
        # The low bytes of the minima.
        values = np.frombuffer(b"".join(rows["minima"]), dtype=np.uint8).reshape(len(region), -1)[:, 1::2]
        return region_links(region, np.ascontiguousarray(values))

    linked = placed.mapInArrow(grouped("region", ("minima",), links), "a binary, b binary")
    if deep is not None:
        # Equal to the full depth: candidates all.
        least = deep.groupBy("region").agg(F.min("node").alias("b"))
        linked = linked.union(deep.join(least, "region").select(F.col("node").alias("a"), "b"))
    return linked.where(F.col("a") != F.col("b")).distinct()


def region_links(region: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that connect the candidates of each region; rows of a region stand together."""
    begins = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    sizes = np.diff(np.append(begins, len(region)))
    few = np.repeat(sizes <= FEW, sizes)
    place = np.arange(len(region)) - np.repeat(begins, sizes)
    end = np.repeat(sizes, sizes)
    root = np.arange(len(region))
    lefts, rights = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for lag in range(1, int(min(FEW, sizes.max(initial=0)))):
        rows = np.flatnonzero(few & (place + lag < end))
        for part in np.split(rows, range(1 << 15, len(rows), 1 << 15)):
            # A row linked to one before it needs no second link to the same tree of links.
            near = (values[part] == values[part + lag]).sum(axis=1) >= LEAST_EQUAL
            one, other = part[near], part[near] + lag
            new = root[one] != root[other]
            one, other = one[new], other[new]
            lefts.append(one)
            rights.append(other)
            root[other] = root[one]
    for begin, size in zip(begins[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
        own = values[begin : begin + size]
        one, other = connected(size, lambda i, rest: (own[rest] == own[i]).sum(axis=1) >= LEAST_EQUAL)
        lefts.append(one + begin)
        rights.append(other + begin)
    return np.concatenate(lefts), np.concatenate(rights)


def connected(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links (reached, reaching row) of a spanning forest of ``near``; each row is compared with those not yet reached."""
    rest, waiting = np.arange(n), []
    ones, others = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    while len(rest):
        if waiting:
            i = waiting.pop()
        else:
            i, rest = int(rest[0]), rest[1:]
            if not len(rest):
                break
        hit = near(i, rest)
        reached = rest[hit]
        if len(reached):
            rest = rest[~hit]
            waiting += reached.tolist()
            ones.append(reached)
            others.append(np.full(len(reached), i))
    return np.concatenate(ones), np.concatenate(others)


def grouped(
    key: str, columns: tuple[str, ...], links: Callable[[np.ndarray, dict], tuple[np.ndarray, np.ndarray]], rows: int = 8192
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives ``links`` whole groups of sorted rows, small groups together, and names its links by node.

    Rows that repeat the node of the row before them in a group are left out as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in ("node", *columns)}
        numbers: list[np.ndarray] = []
        count, last, closed = 0, None, 0

        def flush(n: int) -> pa.RecordBatch:
            nonlocal numbers, count
            number = np.concatenate(numbers)
            own = {c: v[:n] for c, v in held.items()}
            one, other = links(number[:n], own)
            node = own["node"]
            for c in held:
                held[c] = held[c][n:]
            numbers, count = [number[n:]], count - n
            return pa.RecordBatch.from_arrays(
                [pa.array([node[i] for i in rows_.tolist()], pa.binary()) for rows_ in (one, other)], names=["a", "b"]
            )

        for batch in batches:
            number = batch.column(key).to_numpy()
            node = batch.column("node").to_pylist()
            new = []
            for i, pair in enumerate(zip(number.tolist(), node)):
                if pair != last:
                    if last is not None and pair[0] != last[0]:
                        closed = count + len(new)
                    new.append(i)
                    last = pair
            if not new:
                continue
            at = pa.array(new, pa.int64())
            for c in held:
                held[c] += batch.column(c).take(at).to_pylist()
            numbers.append(number[new])
            count += len(new)
            if closed >= rows:
                yield flush(closed)
                closed = 0
        if count > 1:
            yield flush(count)

    return run


# --- exact comparison


def set_links(sets: list[np.ndarray], values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all sets with 100 * intersection >= least * union."""
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    mark = np.zeros(int(flat.max(initial=0)) + 1, dtype=bool)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        hit = (100 * small >= least * large) & ((values[rest] == values[i]).sum(axis=1) >= LEAST_EQUAL)
        at = rest[hit]
        if len(at):
            mine = flat[begins[i] : begins[i] + sizes[i]]
            mark[mine] = True
            shared = []
            # Slabs of rows keep the gathered shingles few.
            for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(sizes[at]) >> 20)) + 1):
                n = sizes[part]
                first = np.cumsum(n) - n
                shared.append(np.add.reduceat(mark[flat[np.arange(n.sum()) + np.repeat(begins[part] - first, n)]].astype(np.int64), first))
            mark[mine] = False
            both = np.concatenate(shared)
            hit[hit] = 100 * both >= least * (sizes[at] + sizes[i] - both)
        return hit

    return connected(len(sets), near)


def exact_links(placed: DataFrame, least: int) -> DataFrame:
    """(a, b): links that connect, within each group, the classes at the similarity. Rows are (cluster, node, minima, shingles)."""

    def links(cluster: np.ndarray, rows: dict) -> tuple[np.ndarray, np.ndarray]:
        ones, others = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        begins = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1]])).tolist()
        for a, b in zip(begins, [*begins[1:], len(cluster)]):
            if b - a > 1:
                sets = [np.frombuffer(s, dtype="<u8") for s in rows["shingles"][a:b]]
                values = np.frombuffer(b"".join(rows["minima"][a:b]), dtype=np.uint8).reshape(b - a, -1)[:, 1::2]
                one, other = set_links(sets, values, least)
                ones.append(one + a)
                others.append(other + a)
        return np.concatenate(ones), np.concatenate(others)

    sorted_ = placed.repartition("cluster").sortWithinPartitions("cluster", "node")
    return sorted_.mapInArrow(grouped("cluster", ("minima", "shingles"), links, 64), "a binary, b binary").distinct()


def clusters(classes: DataFrame, max_rows: int, max_shingles: int) -> DataFrame:
    """(node, cluster): the groups of classes to compare exactly; a node of a large cluster is in several."""
    loose = components(saved(loose_links(*regions(classes, REGION_ROWS), classes), "loose-links"))
    named = saved(loose.join(classes.select("node", "n_shingles"), "node"), "loose-clusters")
    sizes = named.groupBy("component").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles"))
    large = (F.col("rows") > max_rows) | ((F.col("shingles") > max_shingles) & (F.col("rows") > 2))
    marked = saved(named.join(sizes.where(F.col("rows") > 1).withColumn("large", large), "component"), "sized-clusters")
    whole = marked.where(~F.col("large")).select("node", F.xxhash64("component").alias("cluster"))
    crowd = marked.where("large").select("node")
    if crowd.isEmpty():
        return whole
    found, deep = regions(classes.join(crowd, "node", "left_semi"), max_rows, max_shingles)
    parts = whole.union(found.select("node", F.col("region").alias("cluster")))
    if deep is None:
        return parts
    # All pairs of chunks, each of at most half of what a task takes.
    share = F.greatest(F.col("rows") / (max_rows // 2), F.col("shingles") / (max_shingles // 2))
    chunks = F.ceil(share).cast("int")
    dealt = deep.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = dealt.select("node", "region", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    pair = F.xxhash64("region", F.least("chunk", "other"), F.greatest("chunk", "other"))
    return parts.union(other.select("node", pair.alias("cluster")))


def _row_key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("NULL"))


def class_links(
    docs: DataFrame, rows: DataFrame, words: int, least: int, max_rows: int, max_shingles: int, id_column: str, text_column: str
) -> DataFrame:
    """(a, b): links that connect the classes at the similarity. ``rows`` are the written sketches of ``docs``."""
    about = F.min(F.struct(_row_key(F.col("doc_id")).alias("row_key"), "text_hash"))
    classes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("n_shingles").alias("n_shingles"), F.min("minima").alias("minima"), about.alias("row")
    )
    classes = saved(classes.select("node", "n_shingles", "minima", "row.*"), "shingle-classes")
    placed = saved(clusters(classes, max_rows, max_shingles), "clusters")
    # One text of each class is read again; its set goes to the class's clusters.
    wanted = placed.groupBy("node").agg(F.collect_set("cluster").alias("clusters")).join(classes, "node")
    text = F.col(f"`{text_column}`").cast("string")
    texts = docs.select(_row_key(F.col(f"`{id_column}`")).alias("row_key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    chosen = texts.join(wanted, ["row_key", "text_hash"]).select("node", "minima", "clusters", "text")

    def make():
        def step(batch: pa.RecordBatch):
            for first, part in text_chunks(batch, CHUNK_CHARS):
                same = {c: batch.column(c).slice(first, len(part)) for c in ("node", "minima", "clusters")}
                yield {**same, "shingles": [s.astype("<u8").tobytes() for s in shingle_sets(part, words)]}

        return step

    sets = map_batches(chosen, make, "node binary, minima binary, clusters array<long>, shingles binary")
    return exact_links(sets.select(F.explode("clusters").alias("cluster"), "node", "minima", "shingles"), least)


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    least: int = SIMILARITY,
    max_rows: int = CLUSTER_ROWS,
    max_shingles: int = CLUSTER_SHINGLES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): components of texts with 100 * intersection >= least * union."""
    rows = saved(sketches(docs, words, id_column, text_column), "shingle-sketches")
    links = class_links(docs, rows, words, least, max_rows, max_shingles, id_column, text_column)
    linked = components(saved(links, "near-links"))
    least_key = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = least_key.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "node", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )
