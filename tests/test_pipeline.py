import ast
import datetime as dt

import pytest
from library_rows import SF_TINY
from pyspark.errors import AnalysisException, SparkRuntimeException

from tidemart import catalogue, jobs
from tidemart.contracts import CATEGORIES, RAW_DAILY_SALES
from tidemart.functions.sentiment import lexicon_sentiment
from tidemart.operators import quality
from tidemart.operators.propensity import TreeSettings
from tidemart.plans import pipeline
from tidemart.session import cluster_settings, scratch_dir, shared_root
from tidemart.sinks import publish as sinks
from tidemart.sources import tables, testdata
from tidemart.sources.kafka import file_stream


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = pipeline.Lake(str(tmp_path_factory.mktemp("lake")))
    testdata.kafka_records(spark, SF_TINY).repartition(6).write.parquet(f"{lake.root}/log")
    log = file_stream(spark, f"{lake.root}/log", maxFilesPerTrigger="3")
    pipeline.run_bronze(lake, log).awaitTermination()
    pipeline.run_silver(spark, lake, maxFilesPerTrigger="4").awaitTermination()
    return lake


def test_every_job_in_order(spark, lake):
    rows = pipeline.run_gold(spark, lake)
    assert rows == {
        "daily_sales": catalogue.daily_sales(spark, SF_TINY).count(),
        "funnel_daily": 30,
        "user_features": 15,
    }
    assert pipeline.run_gold(spark, lake) == rows

    early = pipeline.run_publish(spark, lake, sinks.parquet_writer(lake.gold("early")))
    assert early["raw_review_sentiment"] is None and early["raw_daily_sales"] == rows["daily_sales"]

    slices = testdata.write_review_slices(spark, SF_TINY, f"{lake.root}/corpus")
    reviews = pipeline.run_reviews(spark, lake, slices)
    assert reviews == 87
    assert pipeline.run_sentiment(spark, lake, lexicon_sentiment) == reviews
    few = TreeSettings(trees=2)
    assert pipeline.run_propensity(spark, lake, catalogue.LABEL_DAY, few) == (1, 15)
    assert pipeline.run_propensity(spark, lake, catalogue.LABEL_DAY, few) == (2, 15)
    # Everybody has bought by then, so a window over all days has one class only.
    with pytest.raises(ValueError, match="both classes"):
        pipeline.run_propensity(spark, lake, dt.date(2024, 1, 2), few)

    spark.sql("CREATE DATABASE IF NOT EXISTS shop_raw")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_marts")
    loaded = pipeline.run_publish(spark, lake, sinks.catalog_writer("shop_raw"))
    assert loaded == {
        "raw_daily_sales": rows["daily_sales"],
        "raw_funnel_daily": 30,
        "raw_review_sentiment": reviews,
        "raw_user_propensity": 15,
    }
    raw = {name: spark.table(f"shop_raw.{name}") for name in loaded}
    assert all("loaded_at" in df.columns for df in raw.values())
    pipeline.register_views(pipeline.staged(raw), "stg_")
    assert spark.sql("SELECT count(*) FROM stg_funnel_daily").first()[0] == 30
    pipeline.run_marts(raw, sinks.catalog_writer("shop_marts"))
    names = ["fct_daily_revenue", "fct_funnel_conversion", "fct_category_sentiment"]
    marts = {name: spark.table(f"shop_marts.{name}") for name in [*names, "dim_user_segments"]}
    failures = dict(quality.run_suite(marts).collect())
    assert len(failures) == 17
    failing = {name for name, count in failures.items() if count}
    assert failing <= {"fct_funnel_conversion.accepted_range_end_to_end_conversion"}
    now = dt.datetime.now() + dt.timedelta(minutes=5)
    assert {r.status for r in quality.freshness(raw, now).collect()} == {"pass"}
    sinks.export_csv(marts["fct_daily_revenue"], f"{lake.root}/csv")
    back = spark.read.option("header", True).csv(f"{lake.root}/csv")
    assert back.columns == marts["fct_daily_revenue"].columns
    assert back.count() == rows["daily_sales"]


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    log, root = str(tmp_path / "log"), str(tmp_path / "lake")
    testdata.kafka_records(spark, SF_TINY).write.parquet(log)
    spark.sql("CREATE DATABASE IF NOT EXISTS job_raw")
    spark.sql("CREATE DATABASE IF NOT EXISTS job_marts")
    slices = testdata.write_review_slices(spark, SF_TINY, str(tmp_path / "corpus"))
    databases = ["--database", "job_raw", "--marts-database", "job_marts"]
    features = f"{root}/gold/user_propensity"
    for arguments in (
        ["bronze", "--files", log],
        ["silver", "--max-bytes", "1000000"],
        ["gold"],
        ["reviews", *[f"{category}={path}" for category, path in slices.items()]],
        ["sentiment"],
    ):
        jobs.main(["--root", root, *arguments])
    scores = catalogue._raw_propensity(spark, SF_TINY).drop("loaded_at")
    scores.write.parquet(features)
    for arguments in (["publish", "--database", "job_raw"], ["marts", *databases]):
        jobs.main(["--root", root, *arguments])
    jobs.main(["--root", root, "csv", "--marts-database", "job_marts"])
    capsys.readouterr()
    broken = spark.table("job_marts.dim_user_segments").limit(1)
    rules_hold = False
    try:
        jobs.main(["--root", root, "checks", *databases])
        rules_hold = True
    except SystemExit as stop:
        assert stop.code == 1
    report = ast.literal_eval(capsys.readouterr().out)
    assert rules_hold == all(v in (0, "pass", "warn") for v in report.values())
    broken.write.mode("append").saveAsTable("job_marts.dim_user_segments")
    with pytest.raises(SystemExit) as stop:
        jobs.main(["--root", root, "checks", *databases])
    assert stop.value.code == 1
    capsys.readouterr()
    assert len(report) == 17 + 4
    assert report["dim_user_segments.unique_user_id"] == 0
    assert report["raw_daily_sales"] == "pass"
    assert spark.read.option("header", True).csv(f"{root}/csv/dim_user_segments").count() > 0


def test_exports_are_one_file_while_small(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    df = spark.read.parquet(path)
    assert sinks.export_files(df, str(tmp_path / "one")) == 1
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    assert sinks.export_files(df, str(tmp_path / "few"), rows_per_file=40) == 3
    assert spark.read.parquet(str(tmp_path / "few")).count() == 100


def test_cluster_settings_follow_the_data(spark, tmp_path, capsys):
    settings = cluster_settings(100 * 2**40)
    assert settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "409600"
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in cluster_settings(0)}
    try:
        with pytest.raises(Exception):
            jobs.main(["--root", str(tmp_path), "--volume", str(2**40), "sentiment"])
        assert spark.conf.get(name) == "4096"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_partitioned_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(12).selectExpr("id", "concat('c', id % 3) AS category")
    assert sinks.overwrite_table(df, path, "category") == 12
    assert sinks.overwrite_table(df.filter("id < 2"), path, "category") == 2
    assert {p.name for p in (tmp_path / "t").glob("category=*")} == {"category=c0", "category=c1"}


def test_ensure_table_creates_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.ensure_table(spark, path, RAW_DAILY_SALES)
    assert spark.read.schema(RAW_DAILY_SALES).parquet(path).count() == 0
    spark.createDataFrame([(None, "a", 1, 1, None)], RAW_DAILY_SALES).write.mode("append").parquet(path)
    sinks.ensure_table(spark, path, RAW_DAILY_SALES)
    assert spark.read.parquet(path).count() == 1


def test_only_a_missing_table_is_skipped(spark, tmp_path):
    assert tables.read_if_exists(spark, str(tmp_path / "nowhere")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        tables.read_if_exists(spark, str(tmp_path / "empty"))


def test_typed_read_fails_on_a_bad_value(spark, tmp_path):
    spark.createDataFrame([("1.5",), ("x",)], "revenue STRING").write.parquet(str(tmp_path / "s"))
    with pytest.raises(SparkRuntimeException, match="revenue: not a decimal"):
        tables.read_typed(spark, str(tmp_path / "s"), "revenue DECIMAL(18,2)").collect()


def test_scratch_follows_the_session_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_category_list_matches_the_review_slices(spark, tmp_path):
    slices = testdata.write_review_slices(spark, SF_TINY, str(tmp_path / "c"))
    assert list(slices) == CATEGORIES
