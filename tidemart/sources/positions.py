"""The position of each record in files that carry none: files in order of name, records in order of file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ["__file", "__block"]
# Formats whose reader knows a row's number in its file, whatever the splits.
ROW_INDEXED = {"parquet"}


def read_numbered(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", name: str = "seq", limit: int | None = None) -> DataFrame:
    """The records of a folder with their position from 0 in ``name``; the first ``limit`` only, if given.

    Positions depend on the files alone, not on splits or tasks. Rows are counted per file (per
    split of a text file), a window over these few rows gives what lies before each, and the records are
    numbered where they are read. A limit reads the leading files only: the others are left out by
    name before the scan.
    """
    reader = spark.read.schema(schema).format(fmt)
    scan = _placed(reader.load(path), fmt)
    files = scan.groupBy(*_PLACE).agg(F.min("__row").alias("first"), F.max("__row").alias("last"), F.count("*").alias("rows"))
    before = Window.orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    # A split's rows are numbered without gaps, so none are lost between the first and the last.
    bases = files.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    if limit is not None:
        leading = [r[0] for r in bases.where(F.col("base") < limit).select("__file").distinct().collect()]
        if not leading:
            return spark.createDataFrame([], f"{schema}, {name} BIGINT")
        scan = scan.where(F.col("__file").isin(leading))
    position = F.col("base") + F.col("__row") - F.col("first")
    # One row per file, so the records are not shuffled.
    numbered = scan.join(F.broadcast(bases.select(*_PLACE, "first", "base")), _PLACE).withColumn(name, position)
    if limit is not None:
        numbered = numbered.where(F.col(name) < limit)
    return numbered.drop(*_PLACE, "__row", "first", "base")


def _placed(records: DataFrame, fmt: str) -> DataFrame:
    """Records with file, block and a number that rises without gaps along a block."""
    if fmt in ROW_INDEXED:
        block, row = F.lit(0).cast("bigint"), F.col("_metadata.row_index")
    else:
        # A task reads a split's lines in order.
        block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return records.select("*", F.col("_metadata.file_path").alias("__file"), block.alias("__block"), row.alias("__row"))
