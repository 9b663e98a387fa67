"""Row selection: one row per key, and the first N rows of a slice.

Both are written so that a key or slice holding a large share of the table
never has to pass through one task as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_LANE = "__lane"


def lowest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, for each key, the row that sorts first by ``order``.

    ``row_number() = 1`` is planned with a partial group limit before the
    shuffle, so each map task sends at most one row per key: a key with many
    copies is reduced where it is read.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def lowest_n(df: DataFrame, order: str, n: int, lanes: int = 4096) -> DataFrame:
    """Exactly the ``n`` rows that sort first by ``order``, or all if there are fewer.

    Rows without a value sort last; equal values are told apart by a hash of the
    row, so only rows that are equal in every column may stay beyond ``n``.

    Sorting a huge table to cut it off early would bring the leading rows of
    every map task into one. Here the narrow sort key alone is ranked in
    parallel lanes; a row outside the best ``n`` of its lane cannot be among the
    best ``n`` overall, so at most ``lanes * n`` keys remain to find the exact
    cut-off. The wide rows are then only filtered against it.
    """
    key = F.struct(
        F.col(order).isNull().alias("missing"),
        F.col(order).alias("value"),
        F.xxhash64(*df.columns).alias("row"),
    )
    lane = F.pmod(F.col("key.row"), F.lit(lanes))
    window = Window.partitionBy(_LANE).orderBy("key")
    lane_best = (
        df.select(key.alias("key"))
        .withColumn(_LANE, lane)
        .withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) <= n)
    )
    cutoff = lane_best.select("key").orderBy("key").limit(n).agg(F.max("key"))
    return df.filter(key <= cutoff.scalar())
