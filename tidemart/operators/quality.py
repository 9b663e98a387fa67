"""Data checks on marts: failing rows for each rule, and one-pass suites.

The rule functions return the offending rows. A suite only needs counts, so it
evaluates every row-level rule of a table in one aggregation over one scan;
key uniqueness takes a grouped pass of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.contracts import (
    CATEGORIES,
    FRESHNESS_ERROR_HOURS,
    FRESHNESS_WARN_HOURS,
    SEGMENTS,
    SENTIMENT_STATUSES,
)
from tidemart.session import scratch_dir

# 8 bytes each; hashed for the join, several times that.
BROADCAST_HASHES = 1 << 20


def _is_missing(column: str) -> Column:
    return F.col(column).isNull()


def _is_unlisted(column: str, values: Sequence[str]) -> Column:
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def _is_outside(column: str, low: float | None, high: float | None) -> Column:
    below = F.lit(False) if low is None else F.col(column) < low
    above = F.lit(False) if high is None else F.col(column) > high
    return F.coalesce(below | above, F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(_is_missing(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not listed; NULL passes."""
    return df.filter(_is_unlisted(column, values))


def accepted_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside the inclusive range; NULL passes."""
    return df.filter(_is_outside(column, low, high))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values found more than once, with their count; NULL passes."""
    counted = df.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("copies"))
    return counted.filter("copies > 1")


def unique_by_hash(df: DataFrame, column: str) -> DataFrame:
    """As ``unique``, in two passes for long keys of which few repeat.

    The first counts 64-bit hashes, so 8 bytes a key are shuffled however long keys are; the second
    counts the keys whose hash repeats, which also tells unequal keys of one hash apart. The hashes that
    repeat are written, and broadcast if they are few; else the keys are shuffled to meet them.
    """
    spark = df.sparkSession
    filled = df.dropna(subset=[column])
    hashed = filled.select(F.xxhash64(column).alias("__hash"))
    repeated = hashed.groupBy("__hash").agg(F.count("*").alias("copies")).filter("copies > 1").select("__hash")
    path = scratch_dir(spark, "repeated-hashes")
    repeated.write.parquet(path)
    repeated = spark.read.schema("__hash BIGINT").parquet(path)
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    suspects = filled.select(column, F.xxhash64(column).alias("__hash")).join(repeated, "__hash", "left_semi")
    return unique(suspects.drop("__hash"), column)


def share_sum(revenue: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Days whose category shares do not add up to one; a NULL total passes."""
    totals = revenue.groupBy("order_date").agg(
        F.sum("category_revenue_share").alias("total_share")
    )
    return totals.filter(F.abs(F.col("total_share") - 1) > tolerance)


def freshness(
    tables: Mapping[str, DataFrame],
    now: dt.datetime,
    warn_hours: int = FRESHNESS_WARN_HOURS,
    error_hours: int = FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Latest load of each table and its status: pass, warn or error.

    A limit is exceeded when the table is strictly older; an empty table has
    no load at all and is an error.
    """
    checks = []
    for name, df in tables.items():
        latest = df.agg(F.max("loaded_at").alias("last_loaded_at"))
        checks.append(latest.select(F.lit(name).alias("table_name"), "last_loaded_at"))
    age = F.lit(now).cast("timestamp") - F.col("last_loaded_at").cast("timestamp")
    fresh_for = {
        hours: age <= F.make_dt_interval(hours=F.lit(hours)) for hours in (warn_hours, error_hours)
    }
    status = F.when(fresh_for[warn_hours], "pass").when(fresh_for[error_hours], "warn")
    return reduce(DataFrame.unionByName, checks).withColumn("status", status.otherwise("error"))


@dataclass(frozen=True)
class Checks:
    """The rules that apply to one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    between: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)


def mart_checks(categories: Sequence[str] = CATEGORIES) -> dict[str, Checks]:
    """The rules of the four marts; ``categories`` lists the known categories."""
    return {
        "fct_daily_revenue": Checks(
            not_null=["order_date", "product_category", "revenue"],
            accepted={"product_category": categories},
            between={"revenue": (0, None)},
        ),
        "fct_funnel_conversion": Checks(
            not_null=["event_date"],
            unique=["event_date"],
            between={"end_to_end_conversion": (0, 1)},
        ),
        "fct_category_sentiment": Checks(
            not_null=["product_category"],
            unique=["product_category"],
            accepted={"sentiment_status": SENTIMENT_STATUSES},
            between={"pct_positive": (0, 1)},
        ),
        "dim_user_segments": Checks(
            not_null=["user_id"],
            unique=["user_id"],
            accepted={"segment": SEGMENTS},
            between={"propensity_score": (0, 1)},
        ),
    }


def run_checks(name: str, df: DataFrame, checks: Checks) -> DataFrame:
    """(check_name, failures) for every rule of one table."""
    broken: dict[str, Column] = {f"not_null_{c}": _is_missing(c) for c in checks.not_null}
    broken |= {f"accepted_values_{c}": _is_unlisted(c, v) for c, v in checks.accepted.items()}
    broken |= {f"accepted_range_{c}": _is_outside(c, *r) for c, r in checks.between.items()}
    results = []
    if broken:
        counts = df.agg(*[F.count_if(is_bad).alias(rule) for rule, is_bad in broken.items()])
        rows = [
            F.struct(F.lit(f"{name}.{rule}").alias("check_name"), F.col(rule).alias("failures"))
            for rule in broken
        ]
        results.append(counts.select(F.inline(F.array(*rows))))
    for column in checks.unique:
        results.append(_failures(f"{name}.unique_{column}", unique(df, column)))
    return reduce(DataFrame.unionByName, results)


def run_suite(marts: Mapping[str, DataFrame], categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """(check_name, failures) for the given marts, including the share total."""
    rules = mart_checks(categories)
    results = [run_checks(name, df, rules[name]) for name, df in marts.items()]
    if "fct_daily_revenue" in marts:
        shares = share_sum(marts["fct_daily_revenue"])
        results.append(_failures("fct_daily_revenue.share_sum", shares))
    return reduce(DataFrame.unionByName, results)


def _failures(check: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.lit(check).alias("check_name"), F.count("*").alias("failures"))
