"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemart.session import scratch_dir

# Words as the contracts define them: runs of anything but the ASCII white space
# characters. ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def narrow(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names; other columns cannot clash."""
    return docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )


def fold(column: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL for a NULL key."""
    return F.crc32(column.cast("string").cast("binary")) % folds


def map_batches(
    frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with a per-task setup.

    ``make()`` runs once per task and returns a function from a record batch to
    any number of column dictionaries (Arrow arrays or lists), one per output
    batch. Workers outlive tasks: ``done()``, if the function has it, drops what it remembered.
    """
    spark_schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        try:
            for batch in batches:
                for columns in step(batch):
                    yield pa.RecordBatch.from_arrays(
                        [
                            columns[f.name].cast(f.type)
                            if isinstance(columns[f.name], pa.Array)
                            else pa.array(columns[f.name], type=f.type)
                            for f in target
                        ],
                        schema=target,
                    )
        finally:
            getattr(step, "done", lambda: None)()

    return frame.mapInArrow(run, spark_schema)


def text_chunks(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a batch (NULL as empty) in groups of about ``limit`` characters.

    A group holds at least one text, so a text longer than the limit stands
    alone. Yields the first row's number and the texts.
    """
    first, size, texts = 0, 0, []
    for row, text in enumerate(batch.column(column).to_pylist()):
        text = text or ""
        if texts and size + len(text) > limit:
            yield first, texts
            first, size, texts = row, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    Intermediate tables are read a few times at most, so a smaller file is worth the time to pack it.
    """
    spark: SparkSession = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
