"""Each registered query beside its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest
from library_rows import SF_TINY

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points
from compare import TABLES, rows

from tidemart import catalogue

# The full model takes minutes to fit; test_propensity runs fewer trees.
SLOW = {"propensity_scores", "propensity_metrics"}
STATEMENTS = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_TINY}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in catalogue.queries() if n not in SLOW])
def test_query_equals_sql(spark, db, name):
    result = entry_points.queries()[name](spark, SF_TINY)
    expected = db.sql(STATEMENTS[name])
    assert sorted(result.columns) == sorted(expected.columns)
    mine = rows(result.columns, result.collect())
    assert mine and mine == rows(expected.columns, expected.fetchall())


def test_entry_has_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_every_query_of_the_library_has_sql():
    assert not set(catalogue.queries()) - set(STATEMENTS)
