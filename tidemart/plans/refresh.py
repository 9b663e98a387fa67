"""Daily aggregates kept up to date by recomputing only the days that new batches touched."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.gold import daily_sales, funnel_daily
from tidemart.sources.tables import read_table, read_table_or_empty
from tidemart.streaming.key_index import LINEAGE_SCHEMA
from tidemart.streaming.silver import KeyedTable

PLACE = re.compile(r"/stream_id=([^/]*)/batch_id=([^/]*)/event_date=([^/]*)/")


def touched(table: DataFrame, done: set[tuple[str, int]]) -> tuple[list[dt.date], set[tuple[str, int]]]:
    """The days that hold rows of batches not ``done``, and these batches, by the names of the files alone."""
    days, batches = set(), set()
    for file in table.inputFiles():
        stream, batch, day = map(unquote, PLACE.search(file).groups())
        if (stream, int(batch)) not in done:
            batches.add((stream, int(batch)))
            days.add(dt.date.fromisoformat(day))
    return sorted(days), batches


def refresh_days(
    spark: SparkSession, source: KeyedTable, aggregate: Callable[[DataFrame], DataFrame], day_column: str, path: str
) -> list[dt.date]:
    """Recompute the touched days of a daily aggregate of ``source`` and overwrite their partitions; the days.

    ``aggregate`` must give rows of a day from that day's rows. The batches taken in are recorded
    after the days were written, so a crash between repeats the work. A compacted source has new
    batches throughout and is taken in whole.
    """
    done_path = f"{path}_batches"
    done = {tuple(r) for r in read_table_or_empty(spark, done_path, LINEAGE_SCHEMA).collect()}
    stored = source.stored(spark)
    days, batches = touched(stored, done)
    if days:
        rows = aggregate(stored.where(F.col("event_date").isin(days)).drop("stream_id", "batch_id"))
        writer = rows.hint("rebalance", day_column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(day_column).parquet(path)
        spark.createDataFrame(sorted(batches), LINEAGE_SCHEMA).coalesce(1).write.mode("append").parquet(done_path)
    return days


def refresh_gold(spark: SparkSession, events: KeyedTable, orders: KeyedTable, root: str) -> dict[str, list[dt.date]]:
    """Both daily tables under ``root``; the days recomputed of each."""
    return {
        "daily_sales": refresh_days(
            spark, orders, lambda rows: daily_sales(rows, unique_orders=True), "order_date", f"{root}/daily_sales"
        ),
        "funnel_daily": refresh_days(spark, events, funnel_daily, "event_date", f"{root}/funnel_daily"),
    }


def read_daily(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/{name}")
