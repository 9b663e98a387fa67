"""Staging models: thin, typed views over the raw warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.contracts import FUNNEL_COLUMNS


def stg_daily_sales(raw: DataFrame) -> DataFrame:
    kept = raw.filter("order_date IS NOT NULL AND revenue >= 0")
    return kept.select(
        "order_date",
        F.lower("product_category").alias("product_category"),
        "orders",
        "units",
        "revenue",
        "loaded_at",
    )


def stg_funnel_daily(raw: DataFrame) -> DataFrame:
    steps = FUNNEL_COLUMNS.values()
    return raw.dropna(subset=["event_date"]).select("event_date", *steps, "loaded_at")


def stg_review_sentiment(raw: DataFrame) -> DataFrame:
    kept = raw.filter(F.col("review_id").isNotNull() & F.col("star_rating").between(1, 5))
    return kept.select(
        "review_id",
        F.lower("product_category").alias("product_category"),
        "star_rating",
        "review_text",
        F.upper("sentiment_label").alias("sentiment_label"),
        "sentiment_score",
        "review_date",
        "loaded_at",
    )


def stg_user_propensity(raw: DataFrame) -> DataFrame:
    kept = raw.filter(F.col("user_id").isNotNull() & F.col("propensity_score").between(0, 1))
    return kept.select(
        "user_id",
        "sessions_30d",
        "events_30d",
        "cart_adds_30d",
        "purchases_prior",
        "propensity_score",
        F.upper("score_band").alias("score_band"),
        "model_version",
        "scored_at",
        "loaded_at",
    )
