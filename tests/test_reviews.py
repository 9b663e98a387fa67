import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.contracts import REVIEW_SOURCE, REVIEWS
from tidemart.functions import sentiment as sent
from tidemart.operators.reviews import load_reviews, type_reviews


@pytest.fixture
def slices(spark, tmp_path):
    def build(rows_by_category):
        paths = {}
        for category, rows in rows_by_category.items():
            paths[category] = str(tmp_path / category)
            spark.createDataFrame(rows, REVIEW_SOURCE).write.parquet(paths[category])
        return paths

    return build


def test_limit_counts_blank_records_and_drops_them_after(spark, slices):
    rows = [
        (2, 5.0, "t", "third", 0),
        (0, 4.9, "t", "  \n ", 0),
        (1, 4.9, None, " two\t words ", 86_400_000),
        (3, 5.0, "t", "fourth", 0),
    ]
    kept = load_reviews(spark, slices({"books": rows, "beauty": rows[:1]}), limit=3).collect()
    assert sorted(r.review_id for r in kept) == ["beauty-2", "books-1", "books-2"]
    row = next(r for r in kept if r.review_id == "books-1")
    assert (row.star_rating, row.review_title, row.review_text) == (4, "", "two words")
    assert row.review_date == dt.date(1970, 1, 2)
    assert kept[0].__fields__ == [c.split()[0] for c in REVIEWS.replace("\n", "").split(",")]


def test_slices_can_be_json_lines(spark, tmp_path):
    line = '{"seq": %d, "rating": 4.5, "title": "t", "text": "line %d", "timestamp": 0, "x": 1}'
    (tmp_path / "books.jsonl").write_text("\n".join(line % (i, i) for i in range(5)))
    paths = {"books": str(tmp_path / "books.jsonl")}
    kept = load_reviews(spark, paths, limit=2, fmt="json").collect()
    assert sorted(r.review_text for r in kept) == ["line 0", "line 1"]


def test_text_rules(spark):
    rows = [
        (0, 3.0, "x" * 300, "a" * 2500, None),
        (1, 0.0, "no stars", "text", 0),
        (2, None, "no stars", "text", 0),
        (3, 6.0, "too many", "text", 0),
        (4, 1.0, "null text", None, 0),
        (5, 1.0, "wide spaces", " a　 b ", 0),
    ]
    raw = spark.createDataFrame(rows, REVIEW_SOURCE).withColumn("product_category", F.lit("books"))
    kept = {r.review_id: r for r in type_reviews(raw).collect()}
    assert set(kept) == {"books-0", "books-5"}
    assert (len(kept["books-0"].review_title), len(kept["books-0"].review_text)) == (300, 2500)
    assert kept["books-0"].review_date == dt.date(1970, 1, 1)
    assert kept["books-5"].review_text == "a b"
    cut = {r.review_id: r for r in type_reviews(raw, 200, 2000).collect()}
    assert (len(cut["books-0"].review_title), len(cut["books-0"].review_text)) == (200, 2000)


def test_slices_are_loaded_whole_unless_told_otherwise(spark, slices):
    rows = [(i, 4.0, "t" * 500, "x" * 9_000, 0) for i in range(5_500)]
    kept = load_reviews(spark, slices({"books": rows}))
    assert kept.count() == 5_500
    assert kept.agg(F.min(F.length("review_title")), F.min(F.length("review_text"))).first() == (500, 9_000)


TEXTS = ["Great, GREAT phone", "bad bad good", "nothing here", "", None, "goodbad good-bad", "naïve bad"]


def test_lexicon_column_and_model_slot_agree(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i INT, review_text STRING")
    words = (sent.POSITIVE_WORDS, sent.NEGATIVE_WORDS)
    udf = sent.model_sentiment(sent.lexicon_scorer(*words))
    both = df.select("i", sent.lexicon_sentiment("review_text").alias("a"), udf("review_text").alias("b"))
    rows = both.orderBy("i").collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert [round(r.a.sentiment_score, 4) for r in rows] == [1, -0.3333, 0, 0, 0, 0, -1]
    assert [r.a.sentiment_label[:3] for r in rows] == ["POS", "NEG", "POS", "POS", "POS", "POS", "NEG"]


def test_the_scorer_is_built_per_task_not_per_batch(spark, tmp_path):
    marker = str(tmp_path / "builds")

    def build():
        with open(marker, "a") as file:
            file.write("x")
        return lambda texts: [0.5] * len(texts)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        texts = spark.range(100).coalesce(1).select(F.col("id").cast("string").alias("t"))
        texts.select(sent.model_sentiment(build)("t")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert open(marker).read() == "x"


def test_score_and_agreement(spark):
    rows = [
        ("r1", "books", 5, "t", "great", None),
        ("r2", "books", 1, "t", "great", None),
        ("r3", "books", 3, "t", "bad", None),
        ("r4", "books", 2, "t", "bad bad good", None),
    ]
    scored = sent.score_reviews(spark.createDataFrame(rows, REVIEWS), sent.lexicon_sentiment)
    assert [r.sentiment_score for r in scored.orderBy("review_id").collect()] == [1, 1, -1, -0.3333]
    row = sent.star_agreement(scored).first()
    assert row.reviews == 3 and row.agreement == pytest.approx(2 / 3)


def test_scorer_slot_takes_any_callable(spark):
    def build():
        return lambda texts: list(pd.Series(texts).str.len().mul(-0.1))

    row = spark.createDataFrame([("abc",)], "t STRING").select(
        sent.model_sentiment(build)("t").alias("s")
    ).first()
    assert row.s.sentiment_label == "NEGATIVE" and row.s.sentiment_score == pytest.approx(-0.3)
