import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from text_rows import DOCUMENTS, ODD_ROWS, SF  # noqa: E402


@pytest.fixture(scope="session")
def given():
    """Rows of the given tables as dictionaries."""
    connection = duckdb.connect()

    def rows(table, where="true"):
        relation = connection.sql(f"SELECT * FROM '{SF}/{table}.parquet' WHERE {where}")
        return [dict(zip(relation.columns, r)) for r in relation.fetchall()]

    return rows


@pytest.fixture(scope="session")
def results(spark):
    """Rows of a registered query over the smallest tables."""
    from tidemart.llm import queries

    held = {}

    def of(name):
        if name not in held:
            held[name] = [r.asDict(recursive=True) for r in queries.queries()[name](spark, SF).collect()]
        return held[name]

    return of


@pytest.fixture
def odd(spark):
    """The odd rows, with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD_ROWS, DOCUMENTS)
    clashing = ["score", "node", "fp", "component", "size", "target", "rank", "bucket", "key", "position", "n_tokens", "copies"]
    return frame.withColumns({c: F.lit(c) for c in clashing})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
