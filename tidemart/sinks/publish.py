"""Batch sinks: lake tables, compact exports, warehouse tables, CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.contracts import WAREHOUSE_TABLES
from tidemart.sources.schemas import Difference, check_schema
from tidemart.sources.tables import read_if_exists, read_table

Writer = Callable[[DataFrame, str], None]

ROWS_PER_EXPORT = 1_000_000


def overwrite_table(df: DataFrame, path: str, *partitions: str) -> int:
    """Replace a lake table and return its row count.

    The count comes from the footers of the files just written, so the plan
    itself runs once.

    For a partitioned table the rows are grouped by partition first, so a day or
    category becomes a few full files rather than one per task, and a large one
    is split again by the adaptive planner.
    """
    if partitions:
        df = df.hint("rebalance", *partitions)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return read_table(df.sparkSession, path).count()


def export_files(written: DataFrame, path: str, rows_per_file: int = ROWS_PER_EXPORT) -> int:
    """Export a written table as few files, one while it is small; file count.

    ``written`` must be a plain table scan: coalescing a longer plan would run
    its whole computation in as few tasks. Its rows are counted from file
    footers, and every ``rows_per_file`` of them get another file.
    """
    files = max(1, -(-written.count() // rows_per_file))
    written.coalesce(files).write.mode("overwrite").parquet(path)
    return files


def export_csv(df: DataFrame, path: str) -> None:
    """A mart as CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def parquet_writer(root: str) -> Writer:
    """Warehouse tables as Parquet folders."""
    return lambda df, table: df.write.mode("overwrite").parquet(f"{root}/{table}")


def catalog_writer(database: str = "default") -> Writer:
    """Warehouse tables in the session catalog."""
    return lambda df, table: df.write.mode("overwrite").saveAsTable(f"{database}.{table}")


def connector_writer(fmt: str, options: Mapping[str, str]) -> Writer:
    """Warehouse tables through a connector such as ``jdbc``; the caller supplies
    its options and has its package on the classpath."""

    def write(df: DataFrame, table: str) -> None:
        df.write.format(fmt).options(**options).option("dbtable", table).mode("overwrite").save()

    return write


def publish(spark: SparkSession, gold_root: str, write: Writer) -> dict[str, int | None]:
    """Full refresh of the warehouse's raw tables from gold; rows per table.

    Every table gets its load time. One whose gold side has not been written yet
    is skipped and reported as ``None``.
    """
    loaded: dict[str, int | None] = {}
    for name, (table, schema) in WAREHOUSE_TABLES.items():
        gold = read_if_exists(spark, f"{gold_root}/{name}")
        if gold is None:
            loaded[table] = None
            continue
        check_schema(schema, gold.schema, f"{gold_root}/{name}")
        stamped = gold.to(StructType.fromDDL(schema)).withColumn("loaded_at", F.current_timestamp())
        write(stamped, table)
        loaded[table] = gold.count()
    return loaded


def publish_run(spark: SparkSession, gold_root: str, root: str, writer: Callable[[str], Writer] = parquet_writer) -> str | None:
    """Publish all warehouse tables or none of them: the run's id, or ``None`` where a gold table is missing.

    The tables are written under a folder of the run; readers find a run through the list of finished
    ones, to which it is added last, as one file. Until then, and if any table fails, they
    keep reading the run before.
    """
    run_id = uuid.uuid4().hex
    loaded = publish(spark, gold_root, writer(f"{root}/runs/{run_id}"))
    if None in loaded.values():
        return None
    finished = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("finished_at"))
    finished.coalesce(1).write.mode("append").parquet(f"{root}/finished")
    return run_id


def published_run(spark: SparkSession, root: str) -> str | None:
    """The run that readers see: the one finished last."""
    finished = read_if_exists(spark, f"{root}/finished", "run_id STRING, finished_at TIMESTAMP")
    return None if finished is None else finished.agg(F.max_by("run_id", "finished_at")).first()[0]


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of one published run, so that they belong together."""
    run_id = published_run(spark, root)
    if run_id is None:
        return {}
    return {table: read_table(spark, f"{root}/runs/{run_id}/{table}") for table, _ in WAREHOUSE_TABLES.values()}


def ensure_table(spark: SparkSession, path: str, schema: str) -> list[Difference]:
    """Create an empty table with the declared schema unless one is there; how that one differs.

    A table that lacks a declared column, or holds one in a type that does not fit, is an error.
    """
    found = read_if_exists(spark, path)
    if found is None:
        spark.createDataFrame([], schema).write.parquet(path)
        return []
    return check_schema(schema, found.schema, path)
