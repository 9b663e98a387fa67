"""The batch jobs in dependency order, each reading and writing named folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart.contracts import BRONZE, WAREHOUSE_TABLES
from tidemart.functions.sentiment import lexicon_sentiment, score_reviews
from tidemart.operators.gold import daily_sales, funnel_daily, user_features
from tidemart.operators.propensity import (
    TreeSettings,
    fit_propensity,
    labelled_features,
    load_model,
    predict,
    propensity_table,
    ranking_metrics,
    register_model,
    with_split,
)
from tidemart.operators.reviews import load_reviews
from tidemart.plans import marts, staging
from tidemart.session import scratch_dir
from tidemart.sinks.publish import Writer, ensure_table, export_files, overwrite_table, publish
from tidemart.sources.kafka import file_stream
from tidemart.sources.schemas import Difference
from tidemart.sources.tables import read_table, spread
from tidemart.streaming.bronze import start_bronze
from tidemart.streaming.silver import compact, events_table, orders_table, start_silver
from tidemart.streaming.triggers import DRAIN


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def silver_events(self) -> str:
        return f"{self.root}/silver/events"

    @property
    def silver_orders(self) -> str:
        return f"{self.root}/silver/orders"

    @property
    def reviews(self) -> str:
        return f"{self.root}/raw/reviews"

    @property
    def models(self) -> str:
        return f"{self.root}/models/purchase_propensity"

    def gold(self, name: str = "") -> str:
        return f"{self.root}/gold/{name}".rstrip("/")

    def export(self, name: str) -> str:
        return f"{self.root}/exports/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def run_bronze(lake: Lake, records: DataFrame, trigger: Mapping[str, Any] = DRAIN) -> StreamingQuery:
    """Start landing a stream of Kafka records."""
    return start_bronze(records, lake.bronze, lake.checkpoint("bronze"), trigger)


def run_silver(
    spark: SparkSession,
    lake: Lake,
    trigger: Mapping[str, Any] = DRAIN,
    checkpoint: str = "silver",
    same_day_copies: bool = False,
    rejects_path: str | None = None,
    **source: str,
) -> StreamingQuery:
    """Start the keyed upserts from bronze.

    ``source`` are file stream options; ``maxBytesPerTrigger`` splits a long
    backlog into batches whose keys stay within the broadcast limit. With
    ``same_day_copies`` a batch is checked against the stored days it spans only.
    """
    return start_silver(
        file_stream(spark, lake.bronze, BRONZE, **source),
        events_table(lake.silver_events, same_day_copies),
        orders_table(lake.silver_orders, same_day_copies),
        lake.checkpoint(checkpoint),
        trigger,
        rejects_path,
    )


def run_compact(spark: SparkSession, lake: Lake, into: Lake) -> dict[str, int]:
    """Merge the silver batches into day files under another root; rows per table."""
    tables = {"events": events_table, "orders": orders_table}
    merged = {}
    for name, table in tables.items():
        source, target = getattr(lake, f"silver_{name}"), getattr(into, f"silver_{name}")
        merged[name] = compact(spark, table(source), target).read(spark).count()
    return merged


def run_setup(spark: SparkSession, lake: Lake) -> dict[str, list[Difference]]:
    """Create the published gold tables that are not there yet; how those that are differ from what is declared."""
    return {name: ensure_table(spark, lake.gold(name), schema) for name, (_, schema) in WAREHOUSE_TABLES.items()}


def run_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rebuild the gold aggregates and their single-file exports."""
    events = events_table(lake.silver_events).read(spark)
    orders = orders_table(lake.silver_orders).read(spark)
    tables = {
        "daily_sales": daily_sales(orders, unique_orders=True),
        "funnel_daily": funnel_daily(events),
        "user_features": user_features(events, orders, unique_orders=True),
    }
    rows = {name: overwrite_table(df, lake.gold(name)) for name, df in tables.items()}
    for name in tables:
        export_files(read_table(spark, lake.gold(name)), lake.export(name))
    return rows


def run_reviews(
    spark: SparkSession, lake: Lake, paths_by_category: Mapping[str, str], **limits: int | None
) -> int:
    """Load the review slices whole, unless ``limits`` of ``load_reviews`` are given."""
    reviews = load_reviews(spark, paths_by_category, **limits)
    return overwrite_table(reviews, lake.reviews, "product_category")


def run_sentiment(
    spark: SparkSession,
    lake: Lake,
    sentiment: Callable[[str], Column] = lexicon_sentiment,
    min_tasks: int | None = None,
) -> int:
    """Score the review table; a heavy model may ask for ``min_tasks`` at least."""
    reviews = read_table(spark, lake.reviews)
    if min_tasks is not None:
        reviews = spread(reviews, min_tasks)
    scored = score_reviews(reviews, sentiment)
    return overwrite_table(scored, lake.gold("review_sentiment"))


def run_propensity(
    spark: SparkSession, lake: Lake, label_day: dt.date, settings: TreeSettings = TreeSettings()
) -> tuple[int, int]:
    """Train, register, score every user: (version, users).

    The label is a purchase on or after ``label_day``, the features are counted
    over the days before it. The users scored are those of the gold features.
    """
    events = events_table(lake.silver_events).read(spark)
    orders = orders_table(lake.silver_orders).read(spark)
    path = scratch_dir(spark, "labelled")
    with_split(labelled_features(events, orders, label_day)).write.parquet(path)
    sides = read_table(spark, path)
    training = sides.filter("side = 'train'")
    model = fit_propensity(training, settings)
    validation = predict(model, sides.filter("side = 'validation'"))
    metrics = ranking_metrics(validation).first().asDict()
    logged = {name: value for name, value in metrics.items() if name not in ("users", "unranked")}
    register_model(spark, model, lake.models, settings, logged, training)
    version, latest = load_model(spark, lake.models)
    features = read_table(spark, lake.gold("user_features"))
    scores = propensity_table(predict(latest, features), version)
    return version, overwrite_table(scores, lake.gold("user_propensity"))


def run_publish(spark: SparkSession, lake: Lake, write: Writer) -> dict[str, int | None]:
    return publish(spark, lake.gold(), write)


def staged(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models over the raw tables; lazy, so marts read through them."""
    return {
        "daily_sales": staging.stg_daily_sales(raw["raw_daily_sales"]),
        "funnel_daily": staging.stg_funnel_daily(raw["raw_funnel_daily"]),
        "review_sentiment": staging.stg_review_sentiment(raw["raw_review_sentiment"]),
        "user_propensity": staging.stg_user_propensity(raw["raw_user_propensity"]),
    }


def register_views(models: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make models available to ``spark.sql`` under their names."""
    for name, model in models.items():
        model.createOrReplaceTempView(f"{prefix}{name}")


def build_marts(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts from the four raw tables."""
    stage = staged(raw)
    return {
        "fct_daily_revenue": marts.fct_daily_revenue(stage["daily_sales"]),
        "fct_funnel_conversion": marts.fct_funnel_conversion(stage["funnel_daily"]),
        "fct_category_sentiment": marts.fct_category_sentiment(
            stage["review_sentiment"], stage["daily_sales"]
        ),
        "dim_user_segments": marts.dim_user_segments(stage["user_propensity"]),
    }


def run_marts(raw: Mapping[str, DataFrame], write: Writer, threads: int = 4) -> None:
    """Materialise the marts; the staging models stay views.

    The marts do not depend on each other, so their jobs are submitted together.
    """
    with ThreadPoolExecutor(threads) as pool:
        jobs = [pool.submit(write, mart, name) for name, mart in build_marts(raw).items()]
        for job in jobs:
            job.result()
