"""Reporting marts over the staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.contracts import HEALTHY_SENTIMENT, LOYAL_PURCHASES, WATCH_SENTIMENT
from tidemart.functions.numeric import ratio


def fct_daily_revenue(sales: DataFrame) -> DataFrame:
    """Day x category revenue with its share of the day and a 7-row average.

    Revenue stays decimal up to the division, so both windows are exact. The
    input has one row per day and category: the windows hold one day's
    categories and one category's days, however many orders lie beneath.
    """
    day = Window.partitionBy("order_date")
    week = Window.partitionBy("product_category").orderBy("order_date").rowsBetween(-6, 0)
    return (
        sales.select("order_date", "product_category", "orders", "units", "revenue")
        .withColumn("day_revenue", F.sum("revenue").over(day))
        .withColumn("category_revenue_share", ratio("revenue", "day_revenue"))
        .withColumn("revenue_7d_avg", F.round(F.avg("revenue").over(week), 2))
        .drop("day_revenue")
    )


# Rate column -> (step, the step it is measured against).
FUNNEL_RATES = {
    "view_rate": ("product_views", "page_views"),
    "cart_rate": ("add_to_carts", "product_views"),
    "checkout_rate": ("checkouts", "add_to_carts"),
    "purchase_rate": ("purchases", "checkouts"),
    "end_to_end_conversion": ("purchases", "page_views"),
}


def fct_funnel_conversion(funnel: DataFrame) -> DataFrame:
    """Step-through rates per day; NULL where the earlier step is empty."""
    rates = {name: ratio(*pair, places=4) for name, pair in FUNNEL_RATES.items()}
    return funnel.drop("loaded_at").withColumns(rates)


def fct_category_sentiment(reviews: DataFrame, sales: DataFrame) -> DataFrame:
    """Sentiment per category beside its revenue, where there is any."""
    score = F.col("sentiment_score").try_cast("decimal(12,6)")
    by_category = reviews.groupBy("product_category").agg(
        F.count("*").alias("reviews"),
        F.avg("star_rating").alias("stars"),
        F.avg(score).alias("sentiment"),
        F.count_if(F.col("sentiment_label") == "POSITIVE").alias("positive"),
    )
    revenue = sales.groupBy("product_category").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("total_revenue")
    )
    status = (
        F.when(F.col("sentiment") >= HEALTHY_SENTIMENT, "HEALTHY")
        .when(F.col("sentiment") >= WATCH_SENTIMENT, "WATCH")
        .otherwise("AT RISK")
    )
    return by_category.join(revenue, "product_category", "left").select(
        "product_category",
        "reviews",
        F.round("stars", 2).alias("avg_stars"),
        F.round("sentiment", 3).cast("double").alias("avg_sentiment"),
        ratio("positive", "reviews", places=3).alias("pct_positive"),
        "total_revenue",
        status.alias("sentiment_status"),
    )


def dim_user_segments(users: DataFrame) -> DataFrame:
    """Users with the first segment whose rule they meet."""
    rules = [
        ("LOYAL", F.col("purchases_prior") >= LOYAL_PURCHASES),
        ("CUSTOMER", F.col("purchases_prior") >= 1),
        ("HOT_PROSPECT", F.col("score_band") == "HIGH"),
        ("CART_ABANDONER", F.col("cart_adds_30d") > 0),
    ]
    matches = [F.when(rule, F.lit(segment)) for segment, rule in rules]
    return users.select(
        "user_id",
        "sessions_30d",
        "events_30d",
        "cart_adds_30d",
        "purchases_prior",
        "propensity_score",
        "score_band",
        F.coalesce(*matches, F.lit("BROWSER")).alias("segment"),
        "model_version",
        "scored_at",
    )
