"""Staged files into a warehouse table, each file once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemart.sources.tables import strict_cast
from tidemart.streaming.key_index import LINEAGE
from tidemart.streaming.triggers import DRAIN

FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
LOADED, EMPTY, FAILED = "loaded", "empty", "failed"


def start_ingest(
    spark: SparkSession,
    stage: str,
    staged_schema: str,
    table_schema: str,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = DRAIN,
) -> StreamingQuery:
    """Load new Parquet files of ``stage``; the checkpoint remembers the old ones.

    ``staged_schema`` is the layout of the files, ``table_schema`` the types the
    table declares. A value that does not convert fails the batch, and nothing
    of it is committed. With a ``processingTime`` trigger files are picked up as
    they arrive. Each row keeps its file and load time for the load history.
    """
    files = spark.readStream.schema(staged_schema).parquet(stage)
    tracked = files.withColumn("source_file", F.col("_metadata.file_path"))
    typed = strict_cast(tracked, f"{table_schema}, source_file STRING")
    loaded = typed.withColumn("loaded_at", F.current_timestamp())
    writer = loaded.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path)


def load_history(
    loaded: DataFrame, hours: int | None = None, now: dt.datetime | Column | None = None
) -> DataFrame:
    """Rows and last load time per source file; of the last ``hours`` only, if given."""
    if hours is not None:
        end = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        start = end - F.make_dt_interval(hours=F.lit(hours))
        loaded = loaded.filter(F.col("loaded_at") >= start)
    return loaded.groupBy("source_file").agg(
        F.count("*").alias("rows_loaded"), F.max("loaded_at").alias("last_loaded_at")
    )


def start_tracked_ingest(
    spark: SparkSession,
    stage: str,
    staged_schema: str,
    table_schema: str,
    path: str,
    history: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = DRAIN,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Load new Parquet files of ``stage`` file by file: a bad file is left out whole and the others are loaded.

    The stream is one of file names, so that every file gets a row in ``history``: those with
    rows, those without any, and those in which a value does not convert, with the first such value. At most
    ``files_per_trigger`` names are in hand at once. Rows and history are written under the
    stream and batch, so a replayed batch writes the same again. An unreadable file stops the stream.
    """
    names = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.parquet")
    files = names.option("maxFilesPerTrigger", files_per_trigger).load(stage).select("path", "length")

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        found = [tuple(r) for r in batch.collect()]
        if not found:
            return
        stamps = {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
        staged = session.read.schema(staged_schema).parquet(*[name for name, _ in found])
        rows = staged.withColumns({"source_file": _plain(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))})
        judged = rows.withColumn("__problem", first_problem(table_schema))
        listed = session.createDataFrame(found, "source_file STRING, bytes BIGINT").withColumn("source_file", _plain(F.col("source_file")))
        written = listed.join(_summary(judged), "source_file", "left").select("source_file", "bytes", *_status())
        _rewrite(written.withColumns(stamps | {"loaded_at": F.current_timestamp()}), history)
        bad = session.read.parquet(history).where(_same_batch(stream_id, batch_id) & (F.col("status") == FAILED))
        good = judged.join(bad.select("source_file"), "source_file", "left_anti")
        typed = strict_cast(good, f"{table_schema}, source_file STRING")
        _rewrite(typed.withColumns(stamps | {"loaded_at": F.current_timestamp()}), path)

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def first_problem(table_schema: str) -> Column:
    """The first value of a staged row that does not convert to its declared type, as text; NULL if all do."""
    problems = []
    for wanted in StructType.fromDDL(table_schema):
        bad = F.col(wanted.name).isNotNull() & F.col(wanted.name).try_cast(wanted.dataType).isNull()
        said = F.concat(F.lit(f"{wanted.name}: not a {wanted.dataType.simpleString()}: "), F.col(wanted.name).cast("string"))
        problems.append(F.when(bad, said))
    return F.coalesce(*problems)


def file_history(history: DataFrame, hours: int | None = None, now: dt.datetime | Column | None = None) -> DataFrame:
    """One row per file: status, rows loaded, rows refused, the first error, load time; of the last ``hours``, if given."""
    if hours is not None:
        end = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        history = history.filter(F.col("loaded_at") >= end - F.make_dt_interval(hours=F.lit(hours)))
    return history.drop(*LINEAGE)


def _plain(name: Column) -> Column:
    """Paths as one reader and another write them: a single slash after the scheme."""
    return F.regexp_replace(name, "^([A-Za-z0-9]+):/+", "$1:/")


def _summary(judged: DataFrame) -> DataFrame:
    return judged.groupBy("source_file").agg(
        F.count("*").alias("rows"), F.count("__problem").alias("bad_rows"), F.min("__problem").alias("error")
    )


def _status() -> list[Column]:
    bad, rows = F.coalesce("bad_rows", F.lit(0)), F.coalesce("rows", F.lit(0))
    return [
        F.when(bad > 0, FAILED).when(rows == 0, EMPTY).otherwise(LOADED).alias("status"),
        F.when(bad > 0, F.lit(0)).otherwise(rows).cast("bigint").alias("rows_loaded"),
        bad.cast("bigint").alias("bad_rows"),
        "error",
    ]


def _same_batch(stream_id: str, batch_id: int) -> Column:
    return (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)


def _rewrite(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LINEAGE).parquet(path)
