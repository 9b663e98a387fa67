"""Streaming sources with the Kafka record layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemart.contracts import KAFKA_RECORD, TOPIC_CLICKSTREAM, TOPIC_ORDERS


def kafka_options(
    bootstrap: str,
    username: str | None = None,
    password: str | None = None,
    topics: Sequence[str] = (TOPIC_CLICKSTREAM, TOPIC_ORDERS),
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: all topics from the start, tolerant of expiry.

    ``min_partitions`` splits large offset ranges over more tasks than the topic
    has partitions, so that one hot partition does not hold up a batch;
    ``max_offsets_per_trigger`` bounds the batches a long backlog is drained in.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
        }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The live source; needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession, path: str, schema: str = KAFKA_RECORD, **options: str
) -> DataFrame:
    """Parquet files as a stream: offline Kafka records, or the bronze table."""
    return spark.readStream.schema(schema).options(**options).parquet(path)
