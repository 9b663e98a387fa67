"""Steps whose tasks must not grow with the tables."""

from library_rows import SF_TINY
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from tidemart import catalogue
from tidemart.operators import propensity
from tidemart.sources import tables
from tidemart.sources import testdata as td
from tidemart.streaming import key_index


def rows_by_task(table):
    return [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]


def test_one_row_group_is_spread_whatever_its_splits(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "uuid() AS name").coalesce(1).write.parquet(f"{tmp_path}/one")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        table = tables.read_table(spark, f"{tmp_path}/one")
        assert table.rdd.getNumPartitions() >= 4 and len(rows_by_task(table)) == 1
        spread = rows_by_task(tables.spread(table, 4))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(spread) == 4 and sum(spread) == 50_000


def test_even_tasks_are_not_shuffled(spark):
    table = spark.range(0, 1000, 1, 4)
    assert tables.spread(table, 4) is table
    assert sum(rows_by_task(tables.spread(spark.range(0), 4))) == 0


def training_rows(spark, values):
    number = F.col("id")
    return spark.range(2000).select(
        F.concat(F.lit("u"), number).alias("user_id"),
        (number % 13).alias("sessions_30d"),
        (number % values).alias("events_30d"),
        (number % 5).alias("cart_adds_30d"),
        ((number % 13 + number % 5 + number % 7) > 10).cast("int").alias("did_purchase"),
    )


def test_features_of_few_values_give_the_same_model_in_bins(spark, monkeypatch):
    users, settings = training_rows(spark, 31), propensity.TreeSettings(trees=3, depth=3)
    scores = []
    for exact_rows in (10_000, 100):
        monkeypatch.setattr(propensity, "EXACT_ROWS", exact_rows)
        model = propensity.fit_propensity(users, settings)
        scored = propensity.predict(model, users).select("user_id", F.round("propensity_score", 9))
        scores.append({tuple(r) for r in scored.collect()})
        assert isinstance(model.stages[0], Bucketizer) == (exact_rows == 100)
    assert scores[0] == scores[1]


def test_boosting_passes_over_bounded_rows_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(propensity, "EXACT_ROWS", 100)
    fitted, fit = [], propensity.Pipeline.fit

    def spy(pipeline, rows):
        fitted.append(rows)
        return fit(pipeline, rows)

    monkeypatch.setattr(propensity.Pipeline, "fit", spy)
    users = training_rows(spark, 2000).withColumn("sessions_30d", F.col("events_30d") * 2)
    model = propensity.fit_propensity(users, propensity.TreeSettings(trees=2, depth=2))
    assert all(len(splits) <= propensity.BINS + 2 for splits in model.stages[0].getSplitsArray())
    (rows,) = fitted
    # 32 bins of events and sessions alike, 5 counts of cart additions, 2 labels.
    assert rows.count() <= 320 and rows.rdd.getNumPartitions() == 1
    assert rows.agg(F.sum("users")).first()[0] == 2000
    assert propensity.predict(model, users).where("propensity_score BETWEEN 0 AND 1").count() == 2000


def sorted_rows(table):
    return sorted(map(tuple, table.collect()), key=str)


def test_line_orders_shuffle_by_rows(spark, monkeypatch):
    few = sorted_rows(catalogue.daily_sales_tpch(spark, SF_TINY))
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 500)
    lines = td.line_orders(spark, SF_TINY)
    assert lines.rdd.getNumPartitions() == tables.shuffle_tasks(
        *[td.table(spark, SF_TINY, name) for name in ("lineitem", "orders", "part")]
    )
    assert max(rows_by_task(lines)) < 2000
    assert sorted_rows(catalogue.daily_sales_tpch(spark, SF_TINY)) == few


def test_unnumbered_slices_have_files_by_bytes(spark, monkeypatch, tmp_path):
    few = sorted_rows(catalogue.load_unnumbered_reviews(spark, SF_TINY))
    text_bytes = td.table(spark, SF_TINY, "documents").agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(td, "BYTES_PER_TASK", text_bytes // 6)
    folders = td.write_unnumbered_slices(spark, SF_TINY, f"{tmp_path}/slices")
    files = {f.rsplit("/", 1)[1].split("-")[1] for path in folders.values() for f in spark.read.parquet(path).inputFiles()}
    assert len(files) >= 10
    assert sorted_rows(catalogue.load_unnumbered_reviews(spark, SF_TINY)) == few


def test_a_batch_before_any_stored_key_is_not_probed(spark, monkeypatch, tmp_path):
    def refuse(*_):
        raise AssertionError("probed")

    index = key_index.KeyIndex(f"{tmp_path}/index", "event_id", 4)
    batch = spark.range(50).select(F.concat(F.lit("k"), "id").alias("event_id"))
    with monkeypatch.context() as patch:
        patch.setattr(key_index, "probed", refuse)
        assert index.possible(batch, F.lit(False)).count() == 0
    index.add(batch.select("event_id", F.lit("s").alias("stream_id"), F.lit(0).cast("bigint").alias("batch_id")))
    assert index.possible(batch, F.lit(False)).count() == 50
