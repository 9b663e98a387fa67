"""A prefix trie of conversations: balanced parentheses per shard, spines merged.

A node is a distinct sequence of first turns. Its key is the exclusive-or of two 64-bit hashes
of each turn with its depth, so keys of prefixes are running aggregates, and equal
keys mean equal sequences (128 bits). Members and their smallest key per node are one grouped pass.

Shards. The distinct paths are sorted by their keys and cut into ranges of about
``SHARD_NODES`` nodes. A shard writes its part of the trie as parentheses, an opening
one when a path enters a node and a closing one when the next path leaves it. Over these, blocks
of 64 hold their least excess in a tree, and ``find_close`` finds where each subtree ends;
the leaf pairs ``()`` between are counted by rank, and the savings of a subtree are the
difference of two cumulative sums. Nodes shared with the shard before (its
left spine) count their own saving and their place among the parent's children there only, so the rows of
a spine, one for each shard, simply add up.

Long conversations. A path is cut one turn below the last node it shares with another path; the rest is a
chain, whose figures follow from running sums of characters. Turns are numbered and
summed within sorted partitions, with the totals of earlier partitions added, so
one conversation may spread over many tasks.

Defined results: turns in order of turn, NULL first, ties by role and text; NULL roles and texts are
empty; repeated rows are turns of their own; rows with a NULL conversation key
take no part; a conversation without turns (after rebuilding) is a member of the root; an empty table
gives no node, not even the root; extra columns are ignored. The digest of the conversations that end
at a node is sequential by definition: they stream through one task in order, held nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import saved, shuffle_partitions

BLOCK = 64
SHARD_NODES = 1 << 19
QUERIES = 1 << 15
KEY = ["depth", "k1", "k2"]
SHARED_TURNS = 6
FAMILY = 100


# --- balanced parentheses


class Parentheses:
    """A trie as parentheses (1 opens, 0 closes) with a tree of the least excess of each block."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        steps = np.where(bits == 1, 1, -1).astype(np.int32)
        blocks = 1 << max(0, (-(-len(bits) // BLOCK) - 1).bit_length())
        # Beyond the end stands an excess that no search stops at.
        self.excess = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        self.excess[: len(bits)] = np.cumsum(steps)
        self.blocks = blocks
        self.least = np.empty(2 * blocks, dtype=np.int32)
        self.least[blocks:] = self.excess.reshape(-1, BLOCK).min(axis=1)
        for node in range(blocks.bit_length() - 2, -1, -1):
            low = 1 << node
            self.least[low : 2 * low] = np.minimum(self.least[2 * low : 4 * low : 2], self.least[2 * low + 1 : 4 * low : 2])
        self.least[0] = np.iinfo(np.int32).max

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """For each opening parenthesis the place of its closing one."""
        return np.concatenate([np.empty(0, dtype=np.int64)] + [
            self._close(opens[i : i + QUERIES]) for i in range(0, len(opens), QUERIES)
        ])

    def _close(self, opens: np.ndarray) -> np.ndarray:
        own = self.excess[opens]
        block = opens // BLOCK
        found, place = self._in_block(block, own, opens % BLOCK)
        at = np.flatnonzero(~found)
        node, level = block[at] + self.blocks, own[at]
        # Up to the first ancestor with a right sibling that goes below the level.
        going = np.arange(len(at))
        while len(going):
            here = node[going]
            right = here + 1
            met = (here & 1 == 0) & (self.least[np.where(here & 1 == 0, right, 0)] < level[going])
            node[going] = np.where(met, right, here >> 1)
            going = going[~met]
        # Down to its first block that does.
        while len(at) and node.min() < self.blocks:
            inner = node < self.blocks
            left = np.where(inner, 2 * node, 0)
            node = np.where(inner, np.where(self.least[left] < level, left, left + 1), node)
        if len(at):
            place[at] = self._in_block(node - self.blocks, level, np.full(len(at), -1))[1]
        return place

    def _in_block(self, block: np.ndarray, level: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        below = (self.excess.reshape(-1, BLOCK)[block] < level[:, None]) & (np.arange(BLOCK) > after[:, None])
        first = below.argmax(axis=1)
        return below[np.arange(len(block)), first], block * BLOCK + first


def shard_figures(lengths: np.ndarray, keys: np.ndarray, weights: np.ndarray, before: int, after: int, tails: np.ndarray) -> dict:
    """The nodes of one shard with their part of leaves, savings and children.

    ``keys`` (two columns) and ``weights`` belong to the turns of all paths, one path after the
    other. Nodes down to depth ``before`` of the first path stand in the shard before
    as well (-1: there is none); the last path shares ``after`` nodes with the next shard's first.
    """
    n = len(lengths)
    begins = np.cumsum(lengths) - lengths
    depth = np.arange(len(keys)) - np.repeat(begins, lengths) + 1
    path = np.repeat(np.arange(n), lengths)
    previous = begins[path - 1] + depth - 1
    inside = (path > 0) & (depth <= lengths[path - 1])
    alike = np.zeros(len(keys), dtype=bool)
    alike[inside] = (keys[inside] == keys[previous[inside]]).all(axis=1)
    shared = np.bincount(path, weights=alike, minlength=n).astype(np.int64)
    left = np.concatenate([[0], lengths[:-1]]) - shared
    counts = np.column_stack([left, lengths - shared]).ravel()
    bits = np.concatenate([[1], np.repeat(np.tile([0, 1], n), counts), np.zeros(lengths[-1] + 1, dtype=np.int64)])
    new = depth > shared[path]
    node_depth = np.concatenate([[0], depth[new]])
    carried = np.concatenate([[before >= 0], (path[new] == 0) & (depth[new] <= before)])
    own = np.where(carried, 0, np.concatenate([[0], weights[new]]))
    tree = Parentheses(bits)
    opens = np.flatnonzero(bits == 1)
    closes = tree.find_close(opens)
    # The node whose path goes on in the next shard is no leaf.
    leaf = (bits == 1) & (np.append(bits[1:], 0) == 0)
    ends = np.concatenate([[0], begins + lengths])
    if after == lengths[-1]:
        leaf[opens[-1] if shared[-1] < lengths[-1] else 0] = False
    rank = np.concatenate([[0], np.cumsum(leaf)])
    saving = np.concatenate([[0], np.cumsum(own)])
    last = np.searchsorted(opens, closes)
    # Children: nodes one deeper between the two parentheses, here for the first time.
    width = np.int64(len(bits) + 1)
    places = np.sort(node_depth[~carried] * width + opens[~carried])
    children = np.searchsorted(places, (node_depth + 1) * width + closes) - np.searchsorted(places, (node_depth + 1) * width + opens)
    # The last node of a path that was cut has the chain's first turn as its child.
    number = np.concatenate([[0], np.cumsum(new)])
    cut = tails & (lengths > 0)
    children[number[ends[1:][cut]]] += 1
    return {
        "depth": node_depth,
        "k1": np.concatenate([[0], keys[new, 0]]),
        "k2": np.concatenate([[0], keys[new, 1]]),
        "n_leaves": rank[closes] - rank[opens],
        "saved_tokens": saving[last] - saving[np.arange(len(opens))],
        "n_children": children,
    }


# --- turns


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, place, h1, h2, n_chars) of every turn: ``place`` rises along a conversation within a part."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    placed = rows.repartitionByRange(shuffle_partitions(conversations.sparkSession), *order).sortWithinPartitions(*order)
    turns = placed.select(
        "conv_id",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
    return saved(turns, "turns")


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their position in the conversation (from 1), and (conv_id, turns) of each conversation."""
    parts = turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    position = (F.col("place") - F.col("first") + F.col("base") + 1).alias("position")
    rows = turns.join(bases, ["conv_id", "part"]).select("conv_id", "part", position, "h1", "h2", "n_chars")
    return rows, parts.groupBy("conv_id").agg(F.sum("rows").alias("turns"))


def rebuilt(conversations: DataFrame, shared_turns: int = SHARED_TURNS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, part, depth, h1, h2, n_chars) of the rebuilt conversations, and their keys (conv_id).

    A conversation begins with the first h turns of its family's first one, h = crc32 of its key
    modulo ``shared_turns``, in place of its own first h.
    """
    rows, sizes = numbered(ordered_turns(conversations))
    rows = saved(rows, "numbered-turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared_turns
    base = F.col("conv_id") - F.col("conv_id") % family
    first = sizes.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    info = sizes.select("conv_id", base.alias("base"), head.alias("head")).join(first, "base", "left").select(
        "conv_id", "base", "head", F.least("head", F.coalesce("base_turns", F.lit(0))).alias("taken")
    )
    info = saved(info, "conversations")
    # A conversation's own turns meet its figures part by part, so a long one is no hot key.
    by_part = rows.select("conv_id", "part").distinct().join(info.select("conv_id", "head", "taken"), "conv_id")
    own = rows.join(by_part, ["conv_id", "part"]).where(F.col("position") > F.col("head")).select(
        "conv_id", "part", (F.col("position") - F.col("head") + F.col("taken")).alias("depth"), "h1", "h2", "n_chars"
    )
    lent = rows.where(F.col("position") < shared_turns).select(F.col("conv_id").alias("base"), "position", "h1", "h2", "n_chars")
    heads = info.where(F.col("taken") > 0).join(lent, "base").where(F.col("position") <= F.col("taken")).select(
        "conv_id", F.lit(-1).alias("part"), F.col("position").alias("depth"), "h1", "h2", "n_chars"
    )
    return own.unionByName(heads), info.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn as a prefix of its conversation: (conv_id, depth, k1, k2, p1, p2, n_chars, chars).

    ``k`` is the prefix's key, ``p`` that of the prefix without its last turn, ``chars`` the characters of both.
    """
    labelled = turns.select(
        "conv_id", "part", "depth", F.xxhash64("depth", "h1", "h2").alias("l1"), F.xxhash64("h2", "depth", "h1").alias("l2"), "n_chars"
    )
    sums = {"l1": F.bit_xor, "l2": F.bit_xor, "n_chars": F.sum}
    totals = labelled.groupBy("conv_id", "part").agg(*[f(c).alias(f"all_{c}") for c, f in sums.items()])
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "conv_id", "part", *[F.coalesce(f(f"all_{c}").over(earlier), F.lit(0)).alias(f"base_{c}") for c, f in sums.items()]
    )
    so_far = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = labelled.withColumns({f"run_{c}": f(c).over(so_far) for c, f in sums.items()}).join(bases, ["conv_id", "part"])
    key = {c: F.col(f"run_{c}").bitwiseXOR(F.col(f"base_{c}")) for c in ("l1", "l2")}
    return running.select(
        "conv_id",
        F.col("depth").cast("int").alias("depth"),
        key["l1"].alias("k1"),
        key["l2"].alias("k2"),
        key["l1"].bitwiseXOR(F.col("l1")).alias("p1"),
        key["l2"].bitwiseXOR(F.col("l2")).alias("p2"),
        "n_chars",
        (F.col("run_n_chars") + F.col("base_n_chars")).alias("chars"),
    )


# --- the trie


def conversation_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, **rebuilding) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    turns, keys = rebuilt(conversations, **rebuilding)
    return prefix_trie(saved(prefixes(turns), "prefixes"), keys, shard_nodes)


def prefix_trie(rows: DataFrame, keys: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node from prefixes (as ``prefixes`` gives them, written) and the members' keys (conv_id)."""
    zero = F.lit(0).cast("long")
    root = keys.select("conv_id", F.lit(0).alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "n_chars", "chars")])
    with_root = rows.unionByName(root)
    nodes = with_root.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.min(c).alias(c) for c in ("p1", "p2", "n_chars")]
    )
    nodes = saved(nodes, "trie-nodes")
    last = with_root.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2", "chars")).alias("end")).select("conv_id", "end.*")
    ends = saved(last, "conversation-ends")
    figures = path_figures(rows, nodes, ends, shard_nodes)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    nothing = hashlib.sha256().hexdigest()
    return (
        nodes.join(figures, KEY)
        .join(end_digests(ends), KEY, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def path_figures(rows: DataFrame, nodes: DataFrame, ends: DataFrame, shard_nodes: int) -> DataFrame:
    """(depth, k1, k2, n_leaves, saved_tokens, n_children) of every node."""
    paths = ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"), F.min("chars").alias("all_chars"))
    paths = paths.withColumnRenamed("depth", "turns").select("conv_id", "turns", "copies", "all_chars")
    of_paths = saved(rows.join(paths.select("conv_id"), "conv_id", "left_semi").drop("p1", "p2"), "paths")
    several = of_paths.groupBy(*KEY).agg(F.count("*").alias("paths")).where(F.col("paths") > 1).drop("paths")
    forks = of_paths.join(several, KEY, "left_semi").groupBy("conv_id").agg(F.max("depth").alias("fork"))
    cut = paths.join(forks, "conv_id", "left").withColumn("kept", F.least("turns", F.coalesce("fork", F.lit(0)) + 1)).drop("fork")
    cut = saved(cut, "cut-paths")
    placed = of_paths.join(cut, "conv_id")
    # What the turns from here to the end of the path save.
    rest = ((F.col("copies") - 1) * (F.col("all_chars") - F.col("chars") + F.col("n_chars"))).cast("long")
    chains = placed.where(F.col("depth") > F.col("kept")).select(
        *KEY,
        F.lit(1).cast("long").alias("n_leaves"),
        rest.alias("saved_tokens"),
        (F.col("depth") < F.col("turns")).cast("long").alias("n_children"),
    )
    ends_in_chain = (F.col("depth") == F.col("kept")) & (F.col("kept") < F.col("turns"))
    weight = F.when(ends_in_chain, rest).otherwise((F.col("n_convs") - 1) * F.col("n_chars"))
    kept = placed.where(F.col("depth") <= F.col("kept")).join(nodes.select(*KEY, "n_convs"), KEY)
    listed = (
        kept.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "k1", "k2", weight.alias("weight")))).alias("steps"))
        .select(
            "conv_id",
            F.transform("steps", lambda s: F.struct(s["k1"].alias("k1"), s["k2"].alias("k2"))).alias("path"),
            F.transform("steps", lambda s: s["weight"]).alias("weights"),
        )
    )
    none = "array<struct<k1:bigint,k2:bigint>>"
    whole = cut.join(listed, "conv_id", "left").select(
        F.coalesce("path", F.array().cast(none)).alias("path"),
        F.coalesce("weights", F.array().cast("array<bigint>")).alias("weights"),
        (F.col("kept") < F.col("turns")).alias("tail"),
    )
    shards = shard_rows(saved(whole, "trie-paths"), shard_nodes)
    sums = [F.sum(c).cast("long").alias(c) for c in ("n_leaves", "saved_tokens", "n_children")]
    return shards.unionByName(chains).groupBy(*KEY).agg(*sums)


def shard_rows(paths: DataFrame, shard_nodes: int) -> DataFrame:
    """The figures of every shard's nodes from (path, weights, tail), one row per distinct path."""
    size = paths.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    ranges = paths.repartitionByRange(max(1, -(-size // shard_nodes)), "path").withColumn("shard", F.spark_partition_id())
    placed = saved(ranges, "trie-shards")
    by_shard = Window.orderBy("shard")
    spans = placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))

    def common(one: Column, other: Column) -> Column:
        # Keys name whole prefixes, so the keys two paths have in common are their common prefix.
        return F.coalesce(F.size(F.array_intersect(one, other)), F.lit(-1))

    # One row per shard, two numbers each.
    bounds = spans.select(
        "shard",
        F.when(F.lag("last").over(by_shard).isNotNull(), common(F.lag("last").over(by_shard), F.col("first"))).otherwise(-1).alias("before"),
        F.when(F.lead("first").over(by_shard).isNotNull(), common(F.col("last"), F.lead("first").over(by_shard))).otherwise(-1).alias("after"),
    )

    def figures(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("number")
        lengths = part["turns"].to_numpy()
        keys = np.column_stack([_flat(part["k1"]), _flat(part["k2"])])
        before, after = int(part["before"].iloc[0]), int(part["after"].iloc[0])
        return pd.DataFrame(shard_figures(lengths, keys, _flat(part["weights"]), before, after, part["tail"].to_numpy()))

    in_order = Window.partitionBy("shard").orderBy("path")
    flat = placed.withColumn("number", F.row_number().over(in_order)).join(F.broadcast(bounds), "shard").select(
        "shard", "number", F.size("path").cast("long").alias("turns"), "path.k1", "path.k2", "weights", "tail", "before", "after"
    )
    return flat.groupBy("shard").applyInPandas(
        figures, "depth int, k1 long, k2 long, n_leaves long, saved_tokens long, n_children long"
    )


def _flat(column: pd.Series) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype=np.int64), *[np.asarray(x, dtype=np.int64) for x in column]])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the digest of the ascending conversation keys that end at each node."""
    placed = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, conv_id in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id")]):
                if key != current:
                    if current is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(f",{conv_id}".encode())
            yield _digest_batch(done)
        if current is not None:
            yield _digest_batch([(*current, digest.hexdigest())])

    return placed.mapInArrow(run, "depth int, k1 long, k2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*KEY, "ends_sha256"])
