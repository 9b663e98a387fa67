import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from tidemart.contracts import KAFKA_RECORD  # noqa: E402
from tidemart.session import configure  # noqa: E402

from library_rows import ARRIVED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidemart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def log(spark):
    """Log records from payloads: dicts are encoded, bytes and None kept."""

    def build(payloads, first_offset=0):
        rows = []
        for number, payload in enumerate(payloads, start=first_offset):
            value = json.dumps(payload).encode() if isinstance(payload, dict) else payload
            rows.append((b"ada", value, "clickstream", 0, number, ARRIVED))
        return spark.createDataFrame(rows, KAFKA_RECORD)

    return build
