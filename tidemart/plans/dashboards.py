"""Dashboard worksheets as queries over the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.contracts import FUNNEL_COLUMNS


def only_categories(mart: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    """The dashboard-wide category filter; ``None`` shows all."""
    if categories is None:
        return mart
    return mart.filter(F.col("product_category").isin(*categories))


def revenue_trend(
    revenue: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """Revenue by day and category beside the 7-row average, in a date range.

    The average comes from the mart, so days before ``first`` still count in it.
    """
    shown = only_categories(revenue, categories)
    if first is not None:
        shown = shown.filter(F.col("order_date") >= F.lit(first))
    if last is not None:
        shown = shown.filter(F.col("order_date") <= F.lit(last))
    return shown.groupBy("order_date", "product_category").agg(
        F.sum("revenue").alias("revenue"), F.sum("revenue_7d_avg").alias("revenue_7d_avg")
    )


def funnel_steps(funnel: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """The funnel as one row per step, with its percentage of the step before.

    All steps of a day sit in one row, so the previous step is simply the
    neighbouring column and no window or shuffle is needed to look it up.
    ``by=()`` gives the funnel of the whole period.
    """
    steps = list(FUNNEL_COLUMNS.values())
    totals = funnel.groupBy(*by).agg(*[F.sum(step).alias(step) for step in steps])
    bars = []
    for number, (step, before) in enumerate(zip(steps, [None, *steps]), start=1):
        previous = F.lit(None).cast("bigint") if before is None else F.col(before)
        bars.append(
            F.struct(
                F.lit(number).alias("step_no"),
                F.lit(step).alias("step"),
                F.col(step).alias("events"),
                previous.alias("previous"),
            )
        )
    percent = F.round(F.col("events") * 100 / F.nullif("previous", F.lit(0)), 2)
    return (
        totals.select(*by, F.inline(F.array(*bars)))
        .withColumn("pct_of_previous", percent)
        .drop("previous")
        .orderBy(*by, F.desc("events"), "step_no")
    )


def sentiment_quadrant(sentiment: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Categories placed against the average revenue and average sentiment.

    The averages are windows over the mart's few rows, one per category, so the
    mart is computed once.
    """
    shown = only_categories(sentiment, categories)
    everything = Window.partitionBy()
    mean_revenue = F.avg(F.col("total_revenue").cast("decimal(28,6)")).over(everything)
    mean_sentiment = F.avg(F.col("avg_sentiment").cast("decimal(12,6)")).over(everything)
    sells = F.when(F.col("total_revenue") >= mean_revenue, "high").otherwise("low")
    pleases = F.when(
        F.col("avg_sentiment").cast("decimal(12,6)") >= mean_sentiment, "high"
    ).otherwise("low")
    return shown.withColumn(
        "quadrant", F.concat(sells, F.lit(" revenue, "), pleases, F.lit(" sentiment"))
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    """Users and average propensity by segment and score band."""
    score = F.col("propensity_score").try_cast("decimal(18,12)")
    return segments.groupBy("segment", "score_band").agg(
        F.count("*").alias("users"), F.round(F.avg(score), 4).alias("avg_propensity")
    )
