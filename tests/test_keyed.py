import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemart.operators.keyed import lowest_n, lowest_per_key


def test_lowest_n_matches_brute_force(spark):
    values = random.Random(7).sample(range(100_000), 3000)
    df = spark.createDataFrame([(v, f"row {v}") for v in values], "seq BIGINT, text STRING")
    for n in (1, 10, 2999, 3000, 5000):
        kept = sorted(r.seq for r in lowest_n(df.repartition(5), "seq", n, lanes=16).collect())
        assert kept == sorted(values)[:n]


def test_lowest_n_with_missing_and_equal_positions(spark):
    values = [3, None, 1, 1, 2, None, 1]
    df = spark.createDataFrame([(v, f"row {i}") for i, v in enumerate(values)], "seq BIGINT, text STRING")
    for n in range(1, 9):
        kept = [r.seq for r in lowest_n(df.repartition(3), "seq", n, lanes=4).collect()]
        expected = sorted(values, key=lambda v: (v is None, v or 0))[:n]
        assert sorted(kept, key=lambda v: (v is None, v or 0)) == expected


def test_lowest_n_of_nothing(spark):
    assert lowest_n(spark.createDataFrame([], "seq BIGINT"), "seq", 5).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60))
def test_lowest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k INT, o INT")
    kept = {r.k: r.o for r in lowest_per_key(df, ["k"], ["o"]).collect()}
    expected = {}
    for key, value in rows:
        expected[key] = min(value, expected.get(key, value))
    assert kept == expected
