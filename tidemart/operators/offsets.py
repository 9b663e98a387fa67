"""Lost log offsets: gaps between the offsets present, per topic and partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOG = ["topic", "partition"]
SPAN = 1 << 20


def lost_ranges(log: DataFrame, expected: DataFrame | None = None, span: int = SPAN) -> DataFrame:
    """(topic, partition, first_lost, last_lost, lost): the longest runs of offsets that are not in ``log``.

    ``expected`` (topic, partition, first_offset, next_offset) states what each partition should hold, as the
    broker reports it; without it, only gaps between present offsets are known. Copies of an offset and
    rows without one do not matter.

    Offsets are cut into spans: gaps within a span come from a window over that span, gaps between spans from
    a window over one row per span. No window covers a whole log partition.
    """
    present = log.where(F.col("offset").isNotNull()).select(*LOG, "offset")
    if expected is not None:
        # The offsets just outside what is expected bound the first and the last gap.
        edges = expected.select(*LOG, F.explode(F.array(F.col("first_offset") - 1, "next_offset")).alias("offset"))
        inside = present.join(expected, LOG).where(
            (F.col("offset") >= F.col("first_offset")) & (F.col("offset") < F.col("next_offset"))
        )
        present = inside.select(*LOG, "offset").union(edges)
    spanned = present.withColumn("span", F.floor(F.col("offset") / span).cast("bigint"))
    distinct = spanned.distinct()
    within = Window.partitionBy(*LOG, "span").orderBy("offset")
    inner = distinct.withColumn("next", F.lead("offset").over(within)).select(*LOG, "offset", "next")
    spans = distinct.groupBy(*LOG, "span").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    along = Window.partitionBy(*LOG).orderBy("span")
    outer = spans.select(*LOG, F.col("high").alias("offset"), F.lead("low").over(along).alias("next"))
    return (
        inner.union(outer)
        .where(F.col("next") > F.col("offset") + 1)
        .select(
            *LOG,
            (F.col("offset") + 1).alias("first_lost"),
            (F.col("next") - 1).alias("last_lost"),
            (F.col("next") - F.col("offset") - 1).alias("lost"),
        )
    )
