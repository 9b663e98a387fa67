import pytest
from pyspark.sql import functions as F

from tidemart.functions.sentiment import model_sentiment, score_reviews
from tidemart.operators.quality import unique, unique_by_hash
from tidemart.sinks.publish import ensure_table, publish_run, published_run, read_published
from tidemart.sources import schemas

DECLARED = "a BIGINT, b INT, c STRING, d DECIMAL(10,2), e DOUBLE"
FOUND = "A INT, b BIGINT, c INT, d DECIMAL(12,3), x STRING"


def test_one_entry_per_difference(spark):
    found = spark.createDataFrame([(1, 2**40, 7, None, "x"), (None, 5, None, None, None)], FOUND)
    assert [d[:2] for d in schemas.schema_differences(DECLARED, found.schema)] == [
        ("a", "narrowed"), ("b", "widened"), ("c", "changed"), ("d", "widened"), ("e", "missing"), ("x", "extra"),
    ]
    report = {r.column_name: r.rows_affected for r in schemas.schema_report(found, DECLARED).collect()}
    assert report == {"a": 0, "b": 1, "c": 0, "d": 0, "e": 2, "x": 1}
    assert schemas.schema_report(found, found.schema).count() == 0
    with pytest.raises(schemas.SchemaMismatch, match="b: widened.*e: missing"):
        schemas.check_schema(DECLARED, found.schema, "table")


def test_ensure_table_checks_the_one_that_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ensure_table(spark, path, "a BIGINT, b STRING") == []
    assert ensure_table(spark, path, "a BIGINT, b STRING") == []
    assert [d.difference for d in ensure_table(spark, path, "a BIGINT")] == ["extra"]
    with pytest.raises(schemas.SchemaMismatch):
        ensure_table(spark, path, "a BIGINT, b STRING, c INT")


def shuffled_bytes(frame):
    """Bytes given to all shuffles of a run, from the metrics of the exchanges that ran."""
    frame.collect()
    waiting, total = [frame._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def test_hashes_of_keys_are_shuffled_instead_of_keys(spark):
    keys = spark.range(60_000).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit("-key")).alias("k"))
    rows = keys.union(keys.limit(50)).union(spark.createDataFrame([(None,)] * 3, "k string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_hash, plain = unique_by_hash(rows, "k"), unique(rows, "k")
        written = shuffled_bytes(rows.select(F.xxhash64("k").alias("h")).groupBy("h").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(by_hash.collect()) == sorted(plain.collect()) and by_hash.count() == 50
    # The first pass writes the repeated hashes, so its shuffle is measured by itself.
    assert 0 < shuffled_bytes(by_hash) + written < shuffled_bytes(plain) / 2


def test_batches_by_length_hold_texts_of_like_length(spark):
    texts = [(f"r{i}", "books", 5, "x" * (1 + (i * 7919) % 3000), None) for i in range(600)] + [("none", "books", 5, None, None)]
    schema = "review_id string, product_category string, star_rating int, review_text string, review_date date"
    reviews = spark.createDataFrame(texts, schema).coalesce(2)

    def spreads():
        # The score of a text is the spread of lengths in its batch.
        def score(batch):
            lengths = [len(t) for t in batch]
            return [float(max(lengths) - min(lengths))] * len(batch)

        return score

    def lengths():
        return lambda batch: [float(len(t)) for t in batch]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "32")
    try:
        widest = {}
        for flag in (False, True):
            scored = score_reviews(reviews, model_sentiment(spreads), by_length=flag)
            widest[flag] = max(r.sentiment_score for r in scored.collect())
        same = [
            sorted((r.review_id, r.sentiment_score) for r in score_reviews(reviews, model_sentiment(lengths), by_length=f).collect())
            for f in (False, True)
        ]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert widest[False] > 2500 and widest[True] < 600 and same[0] == same[1]


def test_a_failing_table_leaves_the_run_before(spark, tmp_path):
    from tidemart.contracts import WAREHOUSE_TABLES

    gold, root = str(tmp_path / "gold"), str(tmp_path / "warehouse")
    assert read_published(spark, root) == {}
    for name, (_, schema) in WAREHOUSE_TABLES.items():
        assert publish_run(spark, gold, root) is None
        spark.createDataFrame([], schema).write.parquet(f"{gold}/{name}")
    first = publish_run(spark, gold, root)
    assert published_run(spark, root) == first

    def failing(path):
        def write(rows, table):
            raise OSError("disk full")

        return write

    with pytest.raises(OSError):
        publish_run(spark, gold, root, failing)
    assert published_run(spark, root) == first
    assert set(read_published(spark, root)) == {t for t, _ in WAREHOUSE_TABLES.values()}
    assert publish_run(spark, gold, root) == published_run(spark, root) != first


def test_setup_creates_what_is_missing(spark, tmp_path):
    from tidemart.contracts import WAREHOUSE_TABLES
    from tidemart.plans.pipeline import Lake, run_setup

    lake = Lake(str(tmp_path))
    extra = spark.createDataFrame([], f"{WAREHOUSE_TABLES['daily_sales'][1]}, note STRING")
    extra.write.parquet(lake.gold("daily_sales"))
    found = run_setup(spark, lake)
    assert [d.column for d in found.pop("daily_sales")] == ["note"] and set(map(len, found.values())) == {0}
    assert all(spark.read.parquet(lake.gold(name)).count() == 0 for name in WAREHOUSE_TABLES)
    spark.createDataFrame([], "order_date DATE").write.mode("overwrite").parquet(lake.gold("daily_sales"))
    with pytest.raises(schemas.SchemaMismatch, match="daily_sales.*missing"):
        run_setup(spark, lake)
