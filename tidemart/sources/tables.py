"""Batch table access."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}

# The fullest of the tasks may read this many times its share before a table is spread.
UNEVEN = 2
# A task of a sized shuffle gets about this many rows.
ROWS_PER_TASK = 250_000


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; a declared schema skips reading file footers to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or ``None`` when it has not been written yet.

    Only a missing table is tolerated; any other failure is raised.
    """
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return None
        raise


def read_table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = read_if_exists(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def spread(table: DataFrame, min_tasks: int) -> DataFrame:
    """A table scan over at least ``min_tasks`` tasks.

    For work that costs far more than the read (decoding, a model), on files too
    few to occupy the executors. A Parquet row group is read by one task, whatever
    the number of splits, so the rows each task gets are counted, which reads no
    column. Tables whose rows already come evenly in enough tasks are not shuffled.
    """
    held = table.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("rows"))
    tasks, most, rows = held.agg(F.count("*"), F.max("rows"), F.sum("rows")).first()
    enough = tasks >= min_tasks and most * min_tasks <= UNEVEN * rows
    return table if enough else table.repartition(min_tasks)


def shuffle_tasks(*tables: DataFrame) -> int:
    """The tasks a shuffle of stored tables takes with at most ``ROWS_PER_TASK`` rows each, by their row counts.

    A count reads no column.
    """
    return -(-sum(table.count() for table in tables) // ROWS_PER_TASK)


def read_typed(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Columns of staged files cast to a declared schema; a bad value is an error.

    ``columns`` is a DDL schema. Only the named columns are read.
    """
    return strict_cast(spark.read.parquet(path), columns)


def strict_cast(staged: DataFrame, columns: str) -> DataFrame:
    """Select and cast the declared columns; fail the job on the first bad value."""
    casts = []
    for wanted in StructType.fromDDL(columns):
        value = F.col(wanted.name).try_cast(wanted.dataType)
        bad = F.col(wanted.name).isNotNull() & value.isNull()
        problem = F.concat(
            F.lit(f"{wanted.name}: not a {wanted.dataType.simpleString()}: "),
            F.col(wanted.name).cast("string"),
        )
        casts.append(F.when(bad, F.raise_error(problem)).otherwise(value).alias(wanted.name))
    return staged.select(*casts)
