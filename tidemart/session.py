"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package relies on.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Review texts reach 100 KB and more; bound Arrow batches by bytes as well.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

MIB = 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def cluster_settings(shuffle_bytes: int, partition_bytes: int = 256 * MIB) -> dict[str, str]:
    """Settings to start a cluster session with, for a given largest shuffle.

    The initial partition count is sized for the data; the adaptive planner
    merges small partitions again, so a generous count costs little, whereas too
    few partitions spill. Scans read splits of the same size.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.parquet.mergeSchema": "false",
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    }


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemart-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset; a cluster job without a
    shared folder would lose its intermediate tables with an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return _local_root()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root (created by the first write)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a checkpoint folder without overriding the cluster's."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
