"""Bronze: every record as it arrived, appended by topic."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.streaming.triggers import DRAIN


def bronze_records(records: DataFrame) -> DataFrame:
    """Log position, key as text, the value's bytes untouched, and arrival time."""
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        "value",
        F.current_timestamp().alias("ingested_at"),
    )


def start_bronze(
    records: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, Any] = DRAIN
) -> StreamingQuery:
    """Append a stream of Kafka records to the bronze table."""
    writer = bronze_records(records).writeStream.format("parquet").partitionBy("topic")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
