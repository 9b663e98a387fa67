import datetime as dt

import pytest

from tidemart.operators import quality

NOW = dt.datetime(2026, 9, 10)


@pytest.fixture
def values(spark):
    return spark.createDataFrame([("a", 0.5), ("a", 1.5), ("b", -0.1), (None, None)], "k STRING, v DOUBLE")


def test_failing_rows(values):
    assert quality.not_null(values, "k").count() == 1
    assert quality.accepted_values(values, "k", ["a"]).count() == 1
    assert quality.accepted_range(values, "v", 0, 1).count() == 2
    assert quality.accepted_range(values, "v", low=0).count() == 1
    assert quality.unique(values, "k").collect() == [("a", 2)]


def test_one_pass_counts_equal_the_failing_rows(values):
    checks = quality.Checks(
        not_null=["k", "v"], unique=["k"], accepted={"k": ["a"]}, between={"v": (0, 1)}
    )
    counts = dict(quality.run_checks("t", values, checks).collect())
    assert counts == {
        "t.not_null_k": 1,
        "t.not_null_v": 1,
        "t.accepted_values_k": 1,
        "t.accepted_range_v": 2,
        "t.unique_k": 1,
    }


def test_share_sum(spark):
    rows = [(1, 0.5), (1, 0.4999), (2, 0.5), (2, 0.4), (3, None)]
    df = spark.createDataFrame(rows, "order_date INT, category_revenue_share DOUBLE")
    assert [r.order_date for r in quality.share_sum(df).collect()] == [2]


def test_the_suite_has_seventeen_checks():
    rules = quality.mart_checks().values()
    generic = sum(
        len(r.not_null) + len(r.unique) + len(r.accepted) + len(r.between) for r in rules
    )
    assert generic + 1 == 17


def test_freshness(spark):
    ages = {"h35": 35, "h36": 36, "h37": 37, "h72": 72, "h73": 73}
    tables = {
        name: spark.createDataFrame([(NOW - dt.timedelta(hours=h),), (None,)], "loaded_at TIMESTAMP")
        for name, h in ages.items()
    }
    tables["empty"] = spark.createDataFrame([], "loaded_at TIMESTAMP")
    status = {r.table_name: r.status for r in quality.freshness(tables, NOW).collect()}
    assert status == {
        "h35": "pass",
        "h36": "pass",
        "h37": "warn",
        "h72": "warn",
        "h73": "error",
        "empty": "error",
    }
