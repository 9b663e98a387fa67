"""Every operator as a named query over the given tables.

Each entry takes the session and the folder of test tables. Money and
timestamps are returned as double and zone-less timestamp, the forms other
engines compare against.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.contracts import (
    BAND_EDGES,
    BRONZE,
    KAFKA_RECORD,
    RAW_DAILY_SALES,
)
from tidemart.functions.sentiment import (
    lexicon_scorer,
    lexicon_sentiment,
    model_sentiment,
    score_reviews,
    star_agreement,
)
from tidemart.operators import gold, offsets, propensity, quality
from tidemart.operators.reviews import load_reviews, type_reviews
from tidemart.operators.silver import clean_events as keep_clean
from tidemart.operators.silver import parse_events as parse
from tidemart.operators.silver import reject_events
from tidemart.operators.silver import split_orders as flat_orders
from tidemart.plans import dashboards, marts, pipeline, refresh, staging
from tidemart.plans.pipeline import Lake, run_bronze, run_silver
from tidemart.session import configure, scratch_dir
from tidemart.sinks import publish as sinks
from tidemart.sources import schemas
from tidemart.sources import testdata as td
from tidemart.sources.kafka import file_stream
from tidemart.sources.tables import read_if_exists, read_table, read_typed
from tidemart.streaming import ingest
from tidemart.streaming.key_index import LINEAGE
from tidemart.streaming.routing import route_events
from tidemart.streaming.silver import events_table, orders_table
from tidemart.streaming.triggers import DRAIN, every

Query = Callable[[SparkSession, str], DataFrame]

# The test events end on this day; it is the label day of the propensity job.
LABEL_DAY = dt.date(2024, 1, 30)
# The registry query is about versions, not about the model.
REGISTRY_TREES = 2
# As many as a tree has bins by default.
STUMP_VALUES = 32
AS_OF = dt.date(2024, 1, 20)
NOW = dt.datetime(2024, 2, 2, 0, 30, tzinfo=dt.timezone.utc)
SCORED_AT = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)
PART_TYPES = ["economy", "large", "medium", "promo", "small", "standard"]

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return {name: _comparable(build) for name, build in _QUERIES.items()}


def _comparable(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = build(configure(spark), sf_dir)
        forms = {}
        for column in result.schema:
            if isinstance(column.dataType, T.DecimalType):
                forms[column.name] = F.col(f"`{column.name}`").cast("double")
            elif isinstance(column.dataType, T.TimestampType):
                forms[column.name] = F.col(f"`{column.name}`").cast("timestamp_ntz")
        return result.withColumns(forms)

    run.__name__ = build.__name__
    return run


# --- silver ----------------------------------------------------------------------


def _flat(events: DataFrame) -> DataFrame:
    return events.select("*", "order.*").drop("order")


@query
def parse_events(spark, sf_dir):
    return _flat(td.parsed_events(spark, sf_dir))


@query
def clean_events(spark, sf_dir):
    return _flat(td.silver_events(spark, sf_dir))


@query
def quarantine_counts(spark, sf_dir):
    rejected = reject_events(td.parsed_events(spark, sf_dir))
    return rejected.groupBy("reject_reason", "event_type").agg(F.count("*").alias("records"))


@query
def split_orders(spark, sf_dir):
    return td.silver_orders(spark, sf_dir)


@query
def route_events_to_topics(spark, sf_dir):
    payloads = td.event_payloads(spark, sf_dir)
    routed = route_events(payloads, "number", "user_number", "timestamp")
    value = F.col("value").cast("string")
    return routed.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.get_json_object(value, "$.event_id").alias("event_id"),
        F.get_json_object(value, "$.event_type").alias("event_type"),
        F.get_json_object(value, "$.order.order_id").alias("order_id"),
    )


def _stored_silver(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events and their orders from a written silver table, so that payloads are decoded once."""
    path = scratch_dir(spark, "silver")
    td.silver_events(spark, sf_dir).write.parquet(path)
    events = read_table(spark, path)
    return events, flat_orders(events)


# --- gold ------------------------------------------------------------------------


@query
def daily_sales(spark, sf_dir):
    return gold.daily_sales(td.silver_orders(spark, sf_dir), unique_orders=True)


@query
def daily_sales_tpch(spark, sf_dir):
    return gold.daily_sales(td.line_orders(spark, sf_dir))


@query
def funnel_daily(spark, sf_dir):
    return gold.funnel_daily(td.silver_events(spark, sf_dir))


@query
def user_behavior(spark, sf_dir):
    return gold.user_behavior(td.silver_events(spark, sf_dir))


@query
def user_purchases(spark, sf_dir):
    return gold.user_purchases(td.silver_orders(spark, sf_dir))


@query
def user_features(spark, sf_dir):
    return gold.user_features(*_stored_silver(spark, sf_dir), unique_orders=True)


@query
def user_features_as_of(spark, sf_dir):
    return gold.user_features(*_stored_silver(spark, sf_dir), as_of=AS_OF, unique_orders=True)


# --- raw tables as the warehouse would hold them -----------------------------------


def _loaded(df: DataFrame, day: str, hours: int) -> DataFrame:
    """Stamp rows as loaded some hours after the start of their day."""
    lag = F.make_dt_interval(hours=F.lit(hours))
    return df.withColumn("loaded_at", F.col(day).cast("timestamp") + lag)


def _raw_sales(spark, sf_dir):
    return _loaded(daily_sales(spark, sf_dir), "order_date", 24)


def _raw_line_sales(spark, sf_dir):
    return _loaded(daily_sales_tpch(spark, sf_dir), "order_date", 24)


def _raw_funnel(spark, sf_dir):
    return _loaded(funnel_daily(spark, sf_dir), "event_date", 48)


def _whole_reviews(spark, sf_dir):
    """All reviews with their whole texts."""
    return type_reviews(td.review_records(spark, sf_dir))


def _prose_sentiment(text):
    return lexicon_sentiment(text, td.PROSE_POSITIVE, td.PROSE_NEGATIVE)


def _raw_sentiment(spark, sf_dir):
    scored = score_reviews(_whole_reviews(spark, sf_dir), _prose_sentiment)
    return _loaded(scored, "review_date", 24)


def _visitors(spark, sf_dir):
    """Feature rows per session: the test users all buy, single visits differ."""
    visits = [
        rows.withColumn("user_id", F.col("session_id")) for rows in _stored_silver(spark, sf_dir)
    ]
    return gold.user_features(*visits, unique_orders=True)


def _rule_scored(spark, sf_dir):
    """A SQL-expressible stand-in for the model: the share of cart additions."""
    share = F.col("cart_adds_30d") / F.col("events_30d")
    return _visitors(spark, sf_dir).withColumn("propensity_score", share)


def _raw_propensity(spark, sf_dir):
    scores = propensity.propensity_table(_rule_scored(spark, sf_dir), "rule")
    when = F.lit(SCORED_AT).cast("timestamp")
    return scores.withColumns({"scored_at": when, "loaded_at": when})


# --- staging and marts -------------------------------------------------------------


@query
def stg_daily_sales(spark, sf_dir):
    return staging.stg_daily_sales(_raw_sales(spark, sf_dir))


@query
def stg_funnel_daily(spark, sf_dir):
    return staging.stg_funnel_daily(_raw_funnel(spark, sf_dir))


@query
def stg_review_sentiment(spark, sf_dir):
    return staging.stg_review_sentiment(_raw_sentiment(spark, sf_dir))


@query
def stg_user_propensity(spark, sf_dir):
    return staging.stg_user_propensity(_raw_propensity(spark, sf_dir))


@query
def fct_daily_revenue(spark, sf_dir):
    return marts.fct_daily_revenue(stg_daily_sales(spark, sf_dir))


@query
def fct_daily_revenue_tpch(spark, sf_dir):
    return marts.fct_daily_revenue(staging.stg_daily_sales(_raw_line_sales(spark, sf_dir)))


@query
def fct_funnel_conversion(spark, sf_dir):
    return marts.fct_funnel_conversion(stg_funnel_daily(spark, sf_dir))


@query
def fct_category_sentiment(spark, sf_dir):
    return marts.fct_category_sentiment(
        stg_review_sentiment(spark, sf_dir), stg_daily_sales(spark, sf_dir)
    )


@query
def dim_user_segments(spark, sf_dir):
    return marts.dim_user_segments(stg_user_propensity(spark, sf_dir))


# --- reviews and sentiment -----------------------------------------------------------


@query
def load_review_slices(spark, sf_dir):
    slices = td.write_review_slices(spark, sf_dir, scratch_dir(spark, "reviews"))
    return load_reviews(spark, slices)


@query
def load_first_reviews(spark, sf_dir):
    """The per-category limit where it cuts: the first 25 records of each slice."""
    slices = td.write_review_slices(spark, sf_dir, scratch_dir(spark, "reviews"))
    return load_reviews(spark, slices, limit=25).drop("review_title", "review_text")


@query
def load_unnumbered_reviews(spark, sf_dir):
    """Slices whose records carry no position: that of the record in the files."""
    slices = td.write_unnumbered_slices(spark, sf_dir, scratch_dir(spark, "reviews"))
    return load_reviews(spark, slices, numbered=False).drop("review_title", "review_text")


@query
def load_first_unnumbered_reviews(spark, sf_dir):
    """The first 25 records of such slices, of the leading files only."""
    slices = td.write_unnumbered_slices(spark, sf_dir, scratch_dir(spark, "reviews"))
    return load_reviews(spark, slices, limit=25, numbered=False).drop("review_title", "review_text")


@query
def score_sentiment(spark, sf_dir):
    return score_reviews(_whole_reviews(spark, sf_dir), _prose_sentiment).drop("review_text")


@query
def score_sentiment_model(spark, sf_dir):
    """The same score through the Arrow-batched model slot."""
    scorer = lexicon_scorer(td.PROSE_POSITIVE, td.PROSE_NEGATIVE)
    scored = score_reviews(_whole_reviews(spark, sf_dir), model_sentiment(scorer))
    return scored.drop("review_text")


@query
def score_sentiment_by_length(spark, sf_dir):
    """The same score with each task's texts in order of length."""
    scorer = lexicon_scorer(td.PROSE_POSITIVE, td.PROSE_NEGATIVE)
    scored = score_reviews(_whole_reviews(spark, sf_dir), model_sentiment(scorer), by_length=True)
    return scored.drop("review_text")


@query
def sentiment_agreement(spark, sf_dir):
    return star_agreement(score_sentiment(spark, sf_dir))


# --- propensity ----------------------------------------------------------------------


@query
def score_bands(spark, sf_dir):
    band = propensity.score_band("propensity_score").alias("score_band")
    return _rule_scored(spark, sf_dir).select("user_id", "propensity_score", band)


@query
def stratified_split_counts(spark, sf_dir):
    sides = propensity.with_split(_labelled(spark, sf_dir))
    return sides.groupBy("side", propensity.LABEL).agg(F.count("*").alias("users"))


@query
def ranking_metrics(spark, sf_dir):
    metrics = propensity.ranking_metrics(_rule_scored(spark, sf_dir))
    rates = ["positive_rate", "roc_auc", "avg_precision"]
    return metrics.withColumns({name: F.round(name, 9) for name in rates})


def _labelled(spark, sf_dir):
    return propensity.labelled_features(*_stored_silver(spark, sf_dir), LABEL_DAY)


def _stump_users(spark, sf_dir):
    """Visits with their counts and whether they ended in an order, counts capped."""
    visits = _visitors(spark, sf_dir)
    capped = {name: F.least(name, F.lit(STUMP_VALUES - 1)) for name in propensity.FEATURES}
    return visits.withColumns(capped)


@query
def propensity_stump(spark, sf_dir):
    """One boosting round of depth one, which has a closed form in SQL.

    Features have at most as many values as the trees have bins, so every cut
    between two values is tried.
    """
    users = _stump_users(spark, sf_dir)
    path = scratch_dir(spark, "stump")
    users.write.parquet(path)
    users = read_table(spark, path)
    model = propensity.fit_propensity(users, propensity.TreeSettings(trees=1, depth=1))
    scored = propensity.predict(model, users)
    return scored.select("user_id", F.round("propensity_score", 9).alias("propensity_score"))


# (application, folder of tables) -> model root and feature table, so that the
# two queries on the full model train it once per session.
_TRAINED: dict[tuple[str, str], tuple[str, str]] = {}


def _trained(spark, sf_dir):
    """(version, model, users with their side), trained on the 75 % side."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED or read_if_exists(spark, _TRAINED[key][1]) is None:
        root, path = scratch_dir(spark, "models"), scratch_dir(spark, "features")
        propensity.with_split(_labelled(spark, sf_dir)).write.parquet(path)
        users = read_table(spark, path)
        model = propensity.fit_propensity(users.filter("side = 'train'"))
        propensity.register_model(spark, model, root)
        _TRAINED[key] = (root, path)
    root, path = _TRAINED[key]
    return *propensity.load_model(spark, root), read_table(spark, path)


@query
def propensity_scores(spark, sf_dir):
    """Every user scored by the model registered last, in checkable totals."""
    version, model, users = _trained(spark, sf_dir)
    table = propensity.propensity_table(propensity.predict(model, users), version)
    score = F.col("propensity_score")
    low, medium = (F.lit(BAND_EDGES[band]) for band in ("LOW", "MEDIUM"))
    band = F.when(score <= low, "LOW").when(score <= medium, "MEDIUM").otherwise("HIGH")
    return table.agg(
        F.count("*").alias("users"),
        F.countDistinct("user_id").alias("distinct_users"),
        F.count_if(score.between(0, 1)).alias("in_range"),
        F.count_if(F.col("score_band") == band).alias("in_band"),
        F.max("model_version").alias("model_version"),
    )


@query
def propensity_metrics(spark, sf_dir):
    """Metrics of the held-out side, in the ranges they must lie in."""
    _, model, users = _trained(spark, sf_dir)
    held = propensity.ranking_metrics(propensity.predict(model, users.filter("side = 'validation'")))
    within = [F.coalesce(F.col(m).between(0, 1), F.lit(True)) for m in ("roc_auc", "avg_precision")]
    return held.select(
        "users",
        "unranked",
        F.round("positive_rate", 9).alias("positive_rate"),
        (within[0] & within[1]).cast("int").alias("in_range"),
    )


@query
def registry_roundtrip(spark, sf_dir):
    """Two versions registered, with their parameters and input example, read back."""
    root = scratch_dir(spark, "models")
    training = propensity.with_split(_labelled(spark, sf_dir)).filter("side = 'train'")
    settings = propensity.TreeSettings(trees=REGISTRY_TREES)
    for _ in range(2):
        model = propensity.fit_propensity(training, settings)
        propensity.register_model(spark, model, root, settings, training=training)
    registry = read_table(spark, f"{root}/registry")
    examples = [spark.read.json(f"{root}/examples/version={v}").count() for v in (1, 2)]
    return registry.select(
        "version",
        F.col("params")["trees"].cast("int").alias("trees"),
        F.col("params")["depth"].cast("int").alias("depth"),
        F.element_at(F.array(*map(F.lit, examples)), F.col("version")).cast("int").alias("example_rows"),
    )


# --- streaming -------------------------------------------------------------------------


def _topic_halves(spark, sf_dir) -> list[DataFrame]:
    """All log records, in the two parts they are delivered in."""
    records = td.kafka_records(spark, sf_dir)
    early = F.col("partition") < 2
    return [records.filter(early), records.filter(~early)]


def _deliver(spark, lake: Lake, records: DataFrame) -> None:
    """Append records to the files standing in for the topics, then land them."""
    records.write.mode("append").parquet(f"{lake.root}/log")
    run_bronze(lake, file_stream(spark, f"{lake.root}/log", KAFKA_RECORD)).awaitTermination()


def _upserted(spark, sf_dir) -> Lake:
    """Two deliveries drained into silver, then all of bronze once more without
    its checkpoint; that last pass must add nothing."""
    lake = Lake(scratch_dir(spark, "lake"))
    for records in _topic_halves(spark, sf_dir):
        _deliver(spark, lake, records)
        run_silver(spark, lake).awaitTermination()
    run_silver(spark, lake, checkpoint="silver-restarted").awaitTermination()
    return lake


@query
def stream_bronze(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    for records in _topic_halves(spark, sf_dir):
        _deliver(spark, lake, records)
    landed = spark.read.schema(BRONZE).parquet(lake.bronze)
    return landed.groupBy("topic", "partition").agg(
        F.count("*").alias("records"),
        F.countDistinct("key").alias("keys"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("ingested_at").alias("stamped"),
    )


@query
def lost_ranges(spark, sf_dir):
    """What a log lost, against what its partitions should hold."""
    return offsets.lost_ranges(*td.thinned_log(spark, sf_dir), span=1000)


@query
def upsert_events(spark, sf_dir):
    events = events_table(_upserted(spark, sf_dir).silver_events).read(spark)
    return _flat(events)


@query
def upsert_orders(spark, sf_dir):
    return orders_table(_upserted(spark, sf_dir).silver_orders).read(spark)


STAGED_SALES = "order_date DATE, product_category STRING, orders BIGINT, units BIGINT, revenue DOUBLE"


def _ingested(spark, sf_dir):
    """Line sales staged in two deliveries, each loaded as it comes, and one more
    load with nothing new."""
    root = scratch_dir(spark, "ingest")
    stage = f"{root}/stage"
    sales = daily_sales_tpch(spark, sf_dir).withColumn("revenue", F.col("revenue").cast("double"))
    early = F.col("order_date") < dt.date(1997, 1, 1)
    for delivery in (sales.filter(early), sales.filter(~early), None):
        if delivery is not None:
            delivery.write.mode("append").parquet(stage)
        ingest.start_ingest(
            spark, stage, STAGED_SALES, RAW_DAILY_SALES, f"{root}/raw", f"{root}/checkpoint"
        ).awaitTermination()
    return read_table(spark, f"{root}/raw")


@query
def ingest_files(spark, sf_dir):
    return _ingested(spark, sf_dir).drop("source_file", "loaded_at")


@query
def load_history(spark, sf_dir):
    """Rows per delivery: the files of one delivery are loaded together."""
    history = ingest.load_history(_ingested(spark, sf_dir))
    delivery = F.dense_rank().over(Window.orderBy("last_loaded_at")).alias("delivery")
    return (
        history.select(delivery, "rows_loaded")
        .groupBy("delivery")
        .agg(F.sum("rows_loaded").alias("rows_loaded"))
    )


def _tracked(spark, sf_dir, trigger=DRAIN) -> str:
    """Line sales staged in two files, one without rows, one with a value that is no number; the lake's root."""
    root = scratch_dir(spark, "tracked")
    sales = daily_sales_tpch(spark, sf_dir).withColumn("revenue", F.col("revenue").cast("double"))
    early = F.col("order_date") < dt.date(1997, 1, 1)
    text = "order_date DATE, product_category STRING, orders STRING, units BIGINT, revenue DOUBLE"
    as_text = sales.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(text)])
    spoiled = as_text.where(early).withColumn("orders", F.when(F.col("product_category") == "promo", "many").otherwise(F.col("orders")))
    deliveries = {"early": as_text.where(early), "late": as_text.where(~early), "empty": as_text.where("false"), "failed": spoiled}
    stream = None
    for name, rows in deliveries.items():
        rows.coalesce(1).write.parquet(f"{root}/stage/{name}")
        if stream is None:
            stream = ingest.start_tracked_ingest(
                spark, f"{root}/stage/*", text, RAW_DAILY_SALES, f"{root}/raw", f"{root}/history", f"{root}/checkpoint", trigger
            )
    if trigger is DRAIN:
        stream.awaitTermination()
        ingest.start_tracked_ingest(
            spark, f"{root}/stage/*", text, RAW_DAILY_SALES, f"{root}/raw", f"{root}/history", f"{root}/checkpoint", trigger
        ).awaitTermination()
    else:
        # The files came while the stream was polling; it stops when all are in.
        stream.processAllAvailable()
        stream.stop()
    return root


@query
def load_history_files(spark, sf_dir):
    """Every staged file with its status, those without rows and those left out as well."""
    history = ingest.file_history(read_table(spark, f"{_tracked(spark, sf_dir)}/history"))
    delivery = F.regexp_extract("source_file", "/([^/]+)/[^/]+$", 1).alias("delivery")
    return history.select(delivery, "status", "rows_loaded", "bad_rows", "error")


@query
def auto_ingest_files(spark, sf_dir):
    """The rows that arrived while a polling stream ran."""
    root = _tracked(spark, sf_dir, every("1 second"))
    return read_table(spark, f"{root}/raw").drop("source_file", "loaded_at", *LINEAGE)


@query
def refreshed_days(spark, sf_dir):
    """Daily tables after three deliveries, of which the last holds late records of earlier days only."""
    lake = Lake(scratch_dir(spark, "lake"))
    log = td.kafka_records(spark, sf_dir)
    later = F.col("timestamp") >= dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
    straggler = ~later & (F.col("partition") == 3)
    events, orders = events_table(lake.silver_events), orders_table(lake.silver_orders)
    for records in (log.where(~later & ~straggler), log.where(later), log.where(straggler)):
        _deliver(spark, lake, records)
        run_silver(spark, lake).awaitTermination()
        refresh.refresh_gold(spark, events, orders, lake.gold("by_day"))
    return refresh.read_daily(spark, lake.gold("by_day"), "daily_sales").select(
        "order_date", "product_category", "orders", "units", "revenue"
    )


# --- sinks -----------------------------------------------------------------------------


@query
def publish_warehouse(spark, sf_dir):
    """All four gold tables published to the catalog, read through SQL views."""
    root, database = scratch_dir(spark, "publish"), f"shop_{uuid.uuid4().hex}"
    gold_tables = {
        "daily_sales": daily_sales(spark, sf_dir),
        "funnel_daily": funnel_daily(spark, sf_dir),
        "review_sentiment": score_reviews(_whole_reviews(spark, sf_dir), _prose_sentiment),
        "user_propensity": _raw_propensity(spark, sf_dir).drop("loaded_at"),
    }
    written = {n: sinks.overwrite_table(df, f"{root}/gold/{n}") for n, df in gold_tables.items()}
    spark.sql(f"CREATE DATABASE {database}")
    published = sinks.publish(spark, f"{root}/gold", sinks.catalog_writer(database))
    raw = {table: spark.table(f"{database}.{table}") for table in published}
    pipeline.register_views(pipeline.staged(raw), f"{database}_")
    rows = []
    for (name, count), (table, sent) in zip(written.items(), published.items()):
        rows.append(
            spark.sql(
                f"SELECT '{table}' AS table_name, count(*) AS staged_rows, count(loaded_at) AS stamped,"
                f" {count}L AS written, {sent}L AS published FROM {database}_{name}"
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query
def publish_all_or_none(spark, sf_dir):
    """Totals that readers see after a full run and a second one, of other rows, that fails at its third table."""
    root = scratch_dir(spark, "publish")
    gold_tables = {
        "daily_sales": daily_sales(spark, sf_dir),
        "funnel_daily": funnel_daily(spark, sf_dir),
        "review_sentiment": score_reviews(_whole_reviews(spark, sf_dir), _prose_sentiment),
        "user_propensity": _raw_propensity(spark, sf_dir).drop("loaded_at"),
    }
    for name, rows in gold_tables.items():
        sinks.overwrite_table(rows, f"{root}/gold/{name}")
    first = sinks.publish_run(spark, f"{root}/gold", f"{root}/warehouse")
    sinks.overwrite_table(daily_sales(spark, sf_dir).limit(1), f"{root}/gold/daily_sales")

    def failing(path: str) -> sinks.Writer:
        write, written = sinks.parquet_writer(path), []

        def third_fails(rows: DataFrame, table: str) -> None:
            written.append(table)
            if len(written) == 3:
                raise OSError("disk full")
            write(rows, table)

        return third_fails

    try:
        sinks.publish_run(spark, f"{root}/gold", f"{root}/warehouse", failing)
    except OSError:
        pass
    seen = sinks.read_published(spark, f"{root}/warehouse")
    kept = F.lit(sinks.published_run(spark, f"{root}/warehouse") == first).alias("first_run")
    return reduce(
        DataFrame.unionByName,
        [t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows", kept) for name, t in seen.items()],
    )


DECLARED_TABLES = {
    "nation": "n_nationkey BIGINT, n_name STRING, n_regionkey STRING, n_comment STRING",
    "lineitem": "l_orderkey BIGINT, l_quantity DOUBLE, l_tax FLOAT, l_shipdate DATE, l_weight DOUBLE",
    "labels": "doc_id INT, quality INT, toxic INT",
}


@query
def schema_differences(spark, sf_dir):
    """How given tables differ from what is declared for them here, one row per column, with the rows concerned."""
    reports = [
        schemas.schema_report(read_table(spark, f"{sf_dir}/{name}.parquet"), declared).withColumn("table_name", F.lit(name))
        for name, declared in DECLARED_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def export_roundtrip(spark, sf_dir):
    """One gold table through every batch sink and back, totals per sink."""
    root = scratch_dir(spark, "exports")
    columns = ["order_date", "product_category", "orders", "units", "revenue"]
    sinks.overwrite_table(daily_sales_tpch(spark, sf_dir), f"{root}/gold/daily_sales")
    lake_table = read_table(spark, f"{root}/gold/daily_sales")
    sinks.export_files(lake_table, f"{root}/single")
    sinks.overwrite_table(lake_table, f"{root}/by_category", "product_category")
    sinks.publish(spark, f"{root}/gold", sinks.parquet_writer(f"{root}/warehouse"))
    sinks.export_csv(lake_table, f"{root}/csv")
    copies = {
        "lake": lake_table,
        "single_file": read_typed(spark, f"{root}/single", RAW_DAILY_SALES),
        "partitioned": read_table(spark, f"{root}/by_category", RAW_DAILY_SALES),
        "warehouse": read_table(spark, f"{root}/warehouse/raw_daily_sales").filter(
            "loaded_at IS NOT NULL"
        ),
        "csv": spark.read.option("header", True).schema(RAW_DAILY_SALES).csv(f"{root}/csv"),
    }
    named = [
        copy.select(F.lit(sink).alias("sink"), *columns) for sink, copy in copies.items()
    ]
    return (
        reduce(DataFrame.unionByName, named)
        .groupBy("sink")
        .agg(
            F.count("*").alias("rows_read"),
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
            F.countDistinct("order_date").alias("days"),
            F.countDistinct("product_category").alias("categories"),
        )
    )


# --- rows that break the rules, derived from the given tables -------------------------


@query
def odd_events(spark, sf_dir):
    """Events with missing fields, unreadable times and broken payloads: what stays."""
    return _flat(keep_clean(parse(td.odd_records(spark, sf_dir))))


@query
def odd_rejects(spark, sf_dir):
    rejected = reject_events(parse(td.odd_records(spark, sf_dir)))
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("records"))


@query
def odd_orders(spark, sf_dir):
    """Different events with one order id, totals that are no price."""
    return flat_orders(keep_clean(parse(td.odd_records(spark, sf_dir))))


@query
def odd_reviews(spark, sf_dir):
    """Blank and missing texts, stars out of range."""
    reviews = type_reviews(td.odd_reviews(spark, sf_dir))
    return reviews.select("review_id", "star_rating", F.length("review_text").alias("chars"))


@query
def odd_staging(spark, sf_dir):
    """Rows and totals that the four staging filters leave of broken raw tables."""
    staged = pipeline.staged(td.odd_raw(_raw_sales, _raw_funnel, _raw_sentiment, _raw_propensity, spark, sf_dir))
    totals = {
        "daily_sales": (F.sum("orders"), F.countDistinct("product_category")),
        "funnel_daily": (F.sum("page_views"), F.countDistinct("event_date")),
        "review_sentiment": (F.sum("star_rating"), F.countDistinct("sentiment_label")),
        "user_propensity": (F.sum("events_30d"), F.countDistinct("score_band")),
    }
    rows = [
        staged[name].agg(
            F.lit(name).alias("model"),
            F.count("*").alias("rows_kept"),
            total.cast("bigint").alias("total"),
            values.alias("distinct_values"),
        )
        for name, (total, values) in totals.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def repeated_keys(spark, sf_dir):
    """Event ids that the log holds several times, found by their hashes first."""
    return quality.unique_by_hash(parse(td.kafka_records(spark, sf_dir)), "event_id")


@query
def odd_checks(spark, sf_dir):
    """The check suite over marts with missing and repeated keys and uneven days."""
    return quality.run_suite(td.odd_marts(_marts(spark, sf_dir)))


# --- data quality ------------------------------------------------------------------------


MARTS: dict[str, Query] = {
    "fct_daily_revenue": fct_daily_revenue,
    "fct_funnel_conversion": fct_funnel_conversion,
    "fct_category_sentiment": fct_category_sentiment,
    "dim_user_segments": dim_user_segments,
}


def _marts(spark, sf_dir, names=tuple(MARTS)) -> dict[str, DataFrame]:
    """The marts as written tables: every check reads one, none rebuilds it."""
    root = scratch_dir(spark, "marts")
    write = sinks.parquet_writer(root)
    with ThreadPoolExecutor(len(names)) as pool:
        jobs = [pool.submit(write, MARTS[name](spark, sf_dir), name) for name in names]
        for job in jobs:
            job.result()
    return {name: read_table(spark, f"{root}/{name}") for name in names}


def _rules_of_kind(spark, sf_dir, kind: str) -> DataFrame:
    rules = {name: getattr(checks, kind) for name, checks in quality.mart_checks().items()}
    needed = [name for name, own in rules.items() if own]
    results = [
        quality.run_checks(name, mart, quality.Checks(**{kind: rules[name]}))
        for name, mart in _marts(spark, sf_dir, needed).items()
    ]
    return reduce(DataFrame.unionByName, results)


@query
def dq_not_null(spark, sf_dir):
    return _rules_of_kind(spark, sf_dir, "not_null")


@query
def dq_unique(spark, sf_dir):
    return _rules_of_kind(spark, sf_dir, "unique")


@query
def dq_accepted_values(spark, sf_dir):
    """Part types are not contract categories: every row of this mart fails."""
    revenue = fct_daily_revenue_tpch(spark, sf_dir)
    listed = quality.run_checks(
        "part_types", revenue, quality.Checks(accepted={"product_category": PART_TYPES})
    )
    unlisted = quality.accepted_values(
        revenue, "product_category", quality.CATEGORIES
    ).agg(F.lit("contract_categories").alias("check_name"), F.count("*").alias("failures"))
    marts_listed = _rules_of_kind(spark, sf_dir, "accepted")
    return marts_listed.unionByName(listed).unionByName(unlisted)


@query
def dq_accepted_range(spark, sf_dir):
    return quality.accepted_range(
        fct_funnel_conversion(spark, sf_dir), "end_to_end_conversion", 0, 1
    )


@query
def dq_share_sum(spark, sf_dir):
    """Totals of the check itself, so that a passing run still shows its days."""
    revenue = fct_daily_revenue_tpch(spark, sf_dir)
    failing = quality.share_sum(revenue).agg(F.count("*").alias("failing_days"))
    days = revenue.agg(F.countDistinct("order_date").alias("days"))
    return days.select("days", failing.scalar().alias("failing_days"))


@query
def dq_freshness(spark, sf_dir):
    tables = {
        "raw_daily_sales": _raw_sales(spark, sf_dir),
        "raw_funnel_daily": _raw_funnel(spark, sf_dir),
        "raw_review_sentiment": _raw_sentiment(spark, sf_dir),
        "raw_user_propensity": _raw_propensity(spark, sf_dir),
    }
    return quality.freshness(tables, NOW)


@query
def dq_suite(spark, sf_dir):
    return quality.run_suite(_marts(spark, sf_dir))


# --- dashboards ----------------------------------------------------------------------------


@query
def bi_revenue_trend(spark, sf_dir):
    return dashboards.revenue_trend(
        fct_daily_revenue_tpch(spark, sf_dir),
        first=dt.date(1996, 1, 1),
        last=dt.date(1997, 12, 31),
        categories=["economy", "promo", "standard"],
    )


@query
def bi_funnel_steps(spark, sf_dir):
    return dashboards.funnel_steps(fct_funnel_conversion(spark, sf_dir))


@query
def bi_funnel_order(spark, sf_dir):
    """The place each row of the sorted funnel has."""
    shown = dashboards.funnel_steps(fct_funnel_conversion(spark, sf_dir), by=())
    path = scratch_dir(spark, "funnel")
    # One row per step: five rows in all.
    shown.coalesce(1).select("step", F.monotonically_increasing_id().alias("place")).write.parquet(path)
    return read_table(spark, path)


@query
def bi_funnel_total(spark, sf_dir):
    return dashboards.funnel_steps(fct_funnel_conversion(spark, sf_dir), by=())


@query
def bi_sentiment_quadrant(spark, sf_dir):
    return dashboards.sentiment_quadrant(fct_category_sentiment(spark, sf_dir))


@query
def bi_segments(spark, sf_dir):
    return dashboards.segment_sizes(dim_user_segments(spark, sf_dir))
