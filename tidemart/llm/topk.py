"""Exact top-k inner products with a three-phase uniform threshold.

A vector's score is a sum over ``GROUPS`` groups of its components; for a query, each group
has a list of local scores, and the lists are spread over blocks of rows.

1. Gather: every block returns its best k local scores of each group with the
   exact totals of their rows. The k-th best distinct row gathered for a query is a safe
   cutoff: k rows reach it.
2. Broadcast the cutoff: a row whose local scores are all below ``cutoff / GROUPS`` stays
   below the cutoff, so each block collects the entries at or above this uniform
   threshold, from any group; all rows that can be among the best are collected.
3. Resolve: of the rows collected, those whose known local scores plus the
   threshold for the unknown ones can still reach the cutoff get their other
   local scores, and each block returns its best k exact totals; the best k of
   all blocks are the result.

Queries form blocks of at most ``QUERY_BLOCK`` rows on average (by a hash of the key), rows
form blocks of one Arrow batch; each pair of blocks is a few matrix products in one
task. Blocks are joined by the number of the query block, so nothing that
grows with the tables is sent to the driver or broadcast by hand.

Components are turned into floor(256 * x). Products are exact: in doubles while
they stay below 2**53, in Python integers beyond; totals are cut to 64 bits.

Defined results: vectors that are NULL or hold a NULL or non-finite component,
and rows with a NULL key, take no part; a query is compared with vectors of its
own length only; rows that share the query's key are its own; repeated keys are separate candidates and
one query, that of the smallest vector; ties go to the smaller key; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, saved

GROUPS = 4
QUERY_BLOCK = 1024
SCALE = 256
TOP = np.iinfo(np.int64)


def packed(vectors: DataFrame, by_block: int | None = None) -> DataFrame:
    """Blocks (dimensions, ids, matrix) of the valid rows of (vec_id, embedding).

    With ``by_block`` the rows are first grouped into that many blocks, numbered ``query_block``.
    """
    valid = vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    def block(ids: np.ndarray, rows: list) -> list[dict]:
        sizes = np.array([len(r) for r in rows])
        out = []
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            matrix = np.floor(SCALE * np.array([rows[i] for i in at], dtype=np.float64).reshape(len(at), size))
            out.append({"dimensions": int(size), "ids": ids[at].astype("<i8").tobytes(), "matrix": matrix.astype("<f8").tobytes()})
        return out

    if by_block is None:

        def make():
            def step(batch: pa.RecordBatch):
                out = block(batch.column("vec_id").to_numpy(), batch.column("embedding").to_pylist())
                yield {c: [o[c] for o in out] for c in ("dimensions", "ids", "matrix")}

            return step

        return map_batches(valid, make, "dimensions int, ids binary, matrix binary")

    import pandas as pd

    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = block(rows["vec_id"].to_numpy(), [np.asarray(r) for r in rows["embedding"]])
        return pd.DataFrame([{"query_block": key[0], **o} for o in out])

    number = F.pmod(F.xxhash64("vec_id"), F.lit(by_block)).cast("int")
    return (
        valid.groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("query_block", number)
        .groupBy("query_block")
        .applyInPandas(gather, "query_block int, dimensions int, ids binary, matrix binary")
    )


def _matrix(ids: bytes, matrix: bytes, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, dtype="<i8")
    return keys, np.frombuffer(matrix, dtype="<f8").reshape(len(keys), dimensions)


def local_scores(queries: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The score of every row for every query, one array per group of components."""
    width = -(-queries.shape[1] // GROUPS) if queries.shape[1] else 1
    groups = [slice(i * width, (i + 1) * width) for i in range(GROUPS)]
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if largest < 2**53:
        return [queries[:, g] @ rows[:, g].T for g in groups]
    whole = [np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (queries, rows)]
    return [np.asarray(whole[0][:, g].dot(whole[1][:, g].T), dtype=object) for g in groups]


def _cut(totals: np.ndarray) -> np.ndarray:
    """Totals cut to the range of 64-bit integers; doubles here are exact and far inside it."""
    if totals.dtype != object:
        return totals.astype(np.int64)
    return np.clip(totals, int(TOP.min), int(TOP.max)).astype(np.int64)


def _best(ids: np.ndarray, totals: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest totals, ties to the smaller key."""
    # The bitwise complement orders downwards and has no overflow.
    return np.lexsort((ids, ~totals))[:k]


def _gathered(k: int):
    """Phase 1 for a pair of blocks: the best k rows of each group's list, with their totals."""

    def rows_of(row: dict) -> dict:
        query_ids, queries = _matrix(row["query_ids"], row["queries"], row["dimensions"])
        ids, matrix = _matrix(row["ids"], row["matrix"], row["dimensions"])
        lists = local_scores(queries, matrix)
        out = {"query_id": [], "vec_id": [], "score": []}
        total = _cut(sum(lists))
        few = min(len(ids), k + 1)
        for q, query in enumerate(query_ids.tolist()):
            places: set[int] = set()
            for scores in lists:
                line = scores[q]
                top = np.argpartition(-line, few - 1)[:few] if few < len(ids) else np.arange(len(ids))
                places.update(top.tolist())
            places = [p for p in places if ids[p] != query]
            at = np.array(places, dtype=np.int64)
            at = at[_best(ids[at], total[q][at], k)]
            out["query_id"] += [query] * len(at)
            out["vec_id"] += ids[at].tolist()
            out["score"] += total[q][at].tolist()
        return out

    return rows_of


def _resolved(k: int):
    """Phases 2 and 3 for a pair of blocks: the best k exact totals among the rows collected."""

    def rows_of(row: dict) -> dict:
        query_ids, queries = _matrix(row["query_ids"], row["queries"], row["dimensions"])
        ids, matrix = _matrix(row["ids"], row["matrix"], row["dimensions"])
        cutoffs = dict(zip(row["cutoff_ids"] or [], row["cutoffs"] or []))
        lists = local_scores(queries, matrix)
        out = {"query_id": [], "vec_id": [], "score": []}
        for q, query in enumerate(query_ids.tolist()):
            # With fewer than k rows gathered there is no cutoff: all rows count.
            cutoff = cutoffs.get(query)
            if cutoff is None:
                at = np.arange(len(ids))
            else:
                share = cutoff / GROUPS
                reached = np.zeros(len(ids), dtype=bool)
                bound = np.zeros(len(ids))
                for scores in lists:
                    line = scores[q]
                    reached |= line >= share
                    bound = bound + np.maximum(line, share)
                # One more for rounding the share.
                at = np.flatnonzero(reached & (bound >= cutoff - 1))
            at = at[ids[at] != query]
            if not len(at):
                continue
            total = _cut(sum(scores[q][at] for scores in lists))
            best = _best(ids[at], total, k)
            out["query_id"] += [query] * len(best)
            out["vec_id"] += ids[at[best]].tolist()
            out["score"] += total[best].tolist()
        return out

    return rows_of


def _per_pair(pairs: DataFrame, rows_of) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                yield rows_of(row)

        return step

    return map_batches(pairs, make, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each query; Spark keeps k per task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each of ``queries``, both (vec_id, embedding)."""
    n_queries = queries.count()
    n_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    rows = saved(packed(vectors), "vector-blocks")
    asked = saved(
        packed(queries, n_blocks).withColumnsRenamed({"ids": "query_ids", "matrix": "queries"}), "query-blocks"
    )
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("query_block")
    pairs = rows.select("*", numbers).join(asked, ["query_block", "dimensions"])
    first = _per_pair(pairs, _gathered(k))
    kth = _ranked(first.dropDuplicates(["query_id", "vec_id"]), k).where(F.col("rank") == k)
    number = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("query_block")
    cutoffs = (
        kth.select(number, "query_id", "score")
        .groupBy("query_block")
        .agg(F.collect_list(F.struct("query_id", "score")).alias("own"))
        .select("query_block", F.col("own.query_id").alias("cutoff_ids"), F.col("own.score").alias("cutoffs"))
    )
    # One row per query block, at most the block's queries in it.
    cutoffs = saved(cutoffs, "cutoffs")
    found = _per_pair(pairs.join(cutoffs, "query_block", "left"), _resolved(k))
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
