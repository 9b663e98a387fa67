import pytest

from tidemart.contracts import REVIEW_FIELDS
from tidemart.operators.offsets import lost_ranges
from tidemart.operators.reviews import load_reviews
from tidemart.sources.positions import read_numbered


def records(spark, numbers):
    return spark.createDataFrame([(5.0, "t", f"text {n}", 0) for n in numbers], REVIEW_FIELDS)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_positions_are_those_in_the_files_whatever_the_splits(spark, tmp_path, fmt):
    path = str(tmp_path / "slice")
    records(spark, range(400)).repartitionByRange(4, "text").sortWithinPartitions("text").write.format(fmt).save(path)
    order = sorted(f"text {n}" for n in range(400))
    try:
        for split_bytes in (None, 700, 3000):
            if split_bytes:
                spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
            found = {r.seq: r.text for r in read_numbered(spark, path, REVIEW_FIELDS, fmt).collect()}
            assert [found[i] for i in range(400)] == order
            first = read_numbered(spark, path, REVIEW_FIELDS, fmt, limit=7)
            assert sorted((r.seq, r.text) for r in first.collect()) == list(enumerate(order[:7]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_limit_leaves_later_files_out_by_name(spark, tmp_path):
    path = str(tmp_path / "slice")
    records(spark, range(90)).coalesce(1).write.option("maxRecordsPerFile", 10).parquet(path)
    first = read_numbered(spark, path, REVIEW_FIELDS, limit=12)
    assert sorted(r.text for r in first.collect()) == sorted(f"text {n}" for n in range(12))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = first._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count(".parquet") >= 2 and "file_path" in plan


def test_empty_folders_and_limits_beyond_the_slice(spark, tmp_path):
    path = str(tmp_path / "none")
    records(spark, []).write.parquet(path)
    assert read_numbered(spark, path, REVIEW_FIELDS, limit=3).count() == 0
    paths = {"books": str(tmp_path / "few")}
    records(spark, range(3)).coalesce(1).write.parquet(paths["books"])
    kept = load_reviews(spark, paths, limit=10, numbered=False)
    assert sorted(r.review_id for r in kept.collect()) == ["books-0", "books-1", "books-2"]


def test_lost_ranges_across_spans(spark):
    present = [n for n in range(100, 400) if not (117 <= n <= 117 or 190 <= n < 340)]
    rows = [("a", 0, n) for n in present for _ in range(2)] + [("a", 1, 7), ("b", 0, None)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long")
    found = {tuple(r) for r in lost_ranges(log, span=16).collect()}
    assert found == {("a", 0, 117, 117, 1), ("a", 0, 190, 339, 150)}
    expected = spark.createDataFrame(
        [("a", 0, 90, 402), ("a", 1, 7, 8), ("b", 0, 3, 9), ("c", 2, 5, 5)],
        "topic string, partition int, first_offset long, next_offset long",
    )
    found = {tuple(r) for r in lost_ranges(log, expected, span=16).collect()}
    assert found == {
        ("a", 0, 90, 99, 10), ("a", 0, 117, 117, 1), ("a", 0, 190, 339, 150), ("a", 0, 400, 401, 2), ("b", 0, 3, 8, 6),
    }
