"""The jobs of the pipeline for spark-submit.

    spark-submit tidemart/jobs.py --root s3a://lake gold

Order: bronze, silver, gold; reviews, sentiment; propensity after gold; then
publish, marts, checks. ``checks`` ends with status 1 if a rule fails or a table
is too old, so that a scheduler stops there.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemart.contracts import BRONZE, WAREHOUSE_TABLES  # noqa: E402
from tidemart.operators import quality  # noqa: E402
from tidemart.operators.offsets import lost_ranges  # noqa: E402
from tidemart.operators.propensity import TreeSettings  # noqa: E402
from tidemart.plans import pipeline  # noqa: E402
from tidemart.plans.refresh import refresh_gold  # noqa: E402
from tidemart.session import cluster_settings, configure  # noqa: E402
from tidemart.sinks.publish import catalog_writer, connector_writer, export_csv, overwrite_table  # noqa: E402
from tidemart.sources.kafka import file_stream, kafka_options, kafka_stream  # noqa: E402
from tidemart.sources.tables import read_table  # noqa: E402
from tidemart.streaming.silver import events_table, orders_table  # noqa: E402
from tidemart.streaming.triggers import DRAIN, every  # noqa: E402

MARTS = [
    "fct_daily_revenue",
    "fct_funnel_conversion",
    "fct_category_sentiment",
    "dim_user_segments",
]


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="jobs")
    options.add_argument("--root", required=True, help="folder of the lake")
    options.add_argument("--volume", type=int, help="bytes of the largest shuffle, to size partitions")
    jobs = options.add_subparsers(dest="job", required=True)
    jobs.add_parser("setup", help="create the published tables that are not there; report how others differ")
    bronze = jobs.add_parser("bronze", help="land the topics")
    bronze.add_argument("--bootstrap", help="Kafka brokers")
    bronze.add_argument("--login", help="JSON file with username and password")
    bronze.add_argument("--files", help="folder of Parquet log records instead of Kafka")
    silver = jobs.add_parser("silver", help="upsert events and orders")
    silver.add_argument("--max-bytes", type=int, help="most bronze bytes per batch")
    silver.add_argument("--rejects", help="folder to keep rejected records in")
    silver.add_argument(
        "--same-day-copies", action="store_true", help="copies of a key carry the same day"
    )
    for job in (bronze, silver):
        job.add_argument("--every", help="keep running, one batch per interval")
    jobs.add_parser("gold", help="daily sales, funnel, user features")
    jobs.add_parser("refresh", help="daily tables by day, only the days of new batches")
    lost = jobs.add_parser("lost", help="offset ranges missing from bronze")
    lost.add_argument("--expected", help="Parquet folder: topic, partition, first_offset, next_offset")
    reviews = jobs.add_parser("reviews", help="load the review slices")
    reviews.add_argument("slices", nargs="+", metavar="CATEGORY=PATH")
    reviews.add_argument("--unnumbered", action="store_true", help="the files hold no seq column")
    reviews.add_argument("--limit", type=int, help="only the first records of each slice")
    reviews.add_argument("--title-chars", type=int, help="cut titles")
    reviews.add_argument("--text-chars", type=int, help="cut texts")
    jobs.add_parser("sentiment", help="score the reviews")
    propensity = jobs.add_parser("propensity", help="train, register and score")
    propensity.add_argument(
        "--label-day", type=dt.date.fromisoformat, required=True, help="first day of the label window"
    )
    trees = TreeSettings()
    propensity.add_argument("--trees", type=int, default=trees.trees)
    propensity.add_argument("--depth", type=int, default=trees.depth)
    propensity.add_argument("--learning-rate", type=float, default=trees.learning_rate)
    compact = jobs.add_parser("compact", help="merge the silver batches, with the stream stopped")
    compact.add_argument("--into", required=True, help="root of the lake that gets the merged tables")
    publish = jobs.add_parser("publish", help="refresh the warehouse tables")
    publish.add_argument("--database", default="default")
    publish.add_argument("--connector", help="data source to publish through, such as jdbc")
    publish.add_argument("--options", help="JSON file with the connector's options")
    for name, text in (("marts", "build the marts"), ("checks", "run the data checks")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("--database", default="default", help="of the warehouse tables")
        job.add_argument("--marts-database", default="default")
    csv = jobs.add_parser("csv", help="export the marts as CSV")
    csv.add_argument("--marts-database", default="default")
    return options


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    lake = pipeline.Lake(args.root.rstrip("/"))
    match args.job:
        case "setup":
            return pipeline.run_setup(spark, lake)
        case "bronze":
            if args.files:
                records = file_stream(spark, args.files)
            else:
                login = json.loads(Path(args.login).read_text()) if args.login else {}
                records = kafka_stream(spark, kafka_options(args.bootstrap, **login))
            trigger = every(args.every) if args.every else DRAIN
            return pipeline.run_bronze(lake, records, trigger).awaitTermination()
        case "silver":
            trigger = every(args.every) if args.every else DRAIN
            source = {"maxBytesPerTrigger": str(args.max_bytes)} if args.max_bytes else {}
            return pipeline.run_silver(
                spark,
                lake,
                trigger,
                same_day_copies=args.same_day_copies,
                rejects_path=args.rejects,
                **source,
            ).awaitTermination()
        case "compact":
            return pipeline.run_compact(spark, lake, pipeline.Lake(args.into.rstrip("/")))
        case "gold":
            return pipeline.run_gold(spark, lake)
        case "refresh":
            events, orders = events_table(lake.silver_events), orders_table(lake.silver_orders)
            return refresh_gold(spark, events, orders, lake.gold("by_day"))
        case "lost":
            expected = read_table(spark, args.expected) if args.expected else None
            ranges = lost_ranges(read_table(spark, lake.bronze, BRONZE), expected)
            return overwrite_table(ranges, lake.gold("lost_ranges"))
        case "reviews":
            slices = dict(s.split("=", 1) for s in args.slices)
            limits = {"limit": args.limit, "title_chars": args.title_chars, "text_chars": args.text_chars}
            limits["numbered"] = not args.unnumbered
            return pipeline.run_reviews(spark, lake, slices, **limits)
        case "sentiment":
            return pipeline.run_sentiment(spark, lake)
        case "propensity":
            settings = TreeSettings(args.trees, args.learning_rate, args.depth)
            return pipeline.run_propensity(spark, lake, args.label_day, settings)
        case "publish":
            if args.connector:
                options = json.loads(Path(args.options).read_text())
                return pipeline.run_publish(spark, lake, connector_writer(args.connector, options))
            return pipeline.run_publish(spark, lake, catalog_writer(args.database))
        case "marts":
            raw = _tables(spark, args.database, [table for table, _ in WAREHOUSE_TABLES.values()])
            return pipeline.run_marts(raw, catalog_writer(args.marts_database))
        case "csv":
            for name, mart in _tables(spark, args.marts_database, MARTS).items():
                export_csv(mart, f"{lake.root}/csv/{name}")
            return MARTS
        case "checks":
            raw = _tables(spark, args.database, [table for table, _ in WAREHOUSE_TABLES.values()])
            now = dt.datetime.now(dt.timezone.utc)
            failures = quality.run_suite(_tables(spark, args.marts_database, MARTS)).collect()
            fresh = quality.freshness(raw, now).collect()
            return {r.check_name: r.failures for r in failures} | {
                r.table_name: r.status for r in fresh
            }


def _tables(spark: SparkSession, database: str, names: list[str]) -> dict:
    return {name: spark.table(f"{database}.{name}") for name in names}


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    builder = SparkSession.builder.appName(f"tidemart-{args.job}")
    if args.volume:
        builder = builder.config(map=cluster_settings(args.volume))
    spark = configure(builder.getOrCreate())
    result = run(spark, args)
    print(result)
    if args.job == "checks" and any(v not in (0, "pass", "warn") for v in result.values()):
        sys.exit(1)


if __name__ == "__main__":
    main()
