"""Outgoing events: topic, key and JSON value of each record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.contracts import TOPIC_CLICKSTREAM, TOPIC_ORDERS


def route_events(events: DataFrame, *passthrough: str) -> DataFrame:
    """Kafka records for event rows: purchases go to the order topic.

    The key is the user, which keeps one user's events in one partition. Columns
    named in ``passthrough`` stay beside the record and out of its value.
    """
    body = [name for name in events.columns if name not in passthrough]
    topic = F.when(F.col("event_type") == "purchase", TOPIC_ORDERS).otherwise(TOPIC_CLICKSTREAM)
    return events.select(
        topic.alias("topic"),
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in body])).cast("binary").alias("value"),
        *passthrough,
    )


def publish_events(events: DataFrame, options: Mapping[str, str]) -> None:
    """Write routed events to Kafka; needs the Kafka connector on the classpath."""
    route_events(events).write.format("kafka").options(**options).save()
