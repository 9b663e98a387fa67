"""Silver: insert-only keyed upserts of each micro-batch, safe to replay.

Parquet has no MERGE, so a table is laid out in partitions
``stream_id / batch_id / event_date``. Batch *b* is checked against every
stored row except those its own stream wrote in batch *b* or later, and then
overwrites exactly its own partitions. A replayed batch therefore rewrites what
it wrote before; a stream restarted without its checkpoint gets a new
``stream_id`` and finds all its keys already stored. One writer per table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.contracts import SILVER_EVENTS, SILVER_ORDERS
from tidemart.operators.silver import clean_events, parse_events, reject_events, split_orders
from tidemart.sources.tables import read_table_or_empty
from tidemart.streaming.key_index import LINEAGE, LINEAGE_SCHEMA, KeyIndex
from tidemart.streaming.triggers import DRAIN

# The stream that merged batches are kept under.
COMPACTED = "compacted"

# A batch's keys are broadcast up to this many bytes of key text; hashed, they take
# several times as much on each executor.
BROADCAST_KEY_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class KeyedTable:
    """A table unique by ``key``.

    A batch is checked through the table's key index (see ``key_index``), which
    reads the stored keys of those files only that may hold one of its keys, on whatever day.
    ``same_day_copies`` states that copies of a key always carry the same
    ``event_date``, as they do when a producer resends a record unchanged; then no index
    is kept and a batch is checked against the partitions from its first day to its last.
    """

    path: str
    key: str
    schema: str
    same_day_copies: bool = False
    key_buckets: int = 32

    @property
    def index(self) -> KeyIndex:
        return KeyIndex(f"{self.path}_keys", self.key, self.key_buckets)

    def stored(self, spark: SparkSession) -> DataFrame:
        """All rows with their lineage columns; empty before the first write."""
        return read_table_or_empty(spark, self.path, f"{self.schema}, {LINEAGE_SCHEMA}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as readers see it."""
        return self.stored(spark).drop(*LINEAGE)


def events_table(path: str, same_day_copies: bool = False) -> KeyedTable:
    return KeyedTable(path, "event_id", SILVER_EVENTS, same_day_copies)


def orders_table(path: str, same_day_copies: bool = False) -> KeyedTable:
    return KeyedTable(path, "order_id", SILVER_ORDERS, same_day_copies)


def unseen(
    batch: DataFrame, stored: DataFrame, key: str, broadcast_bytes: int = BROADCAST_KEY_BYTES
) -> DataFrame:
    """Rows of a persisted batch whose key is not stored yet.

    The stored side is the large one. When the batch's keys fit the broadcast
    limit, the stored keys are only scanned and matched in place, and the few
    matches are what the batch is joined to; nothing of the stored table is
    shuffled. Larger batches fall back to a shuffled anti join.
    """
    key_bytes = batch.agg(F.sum(F.octet_length(key))).first()[0]
    if key_bytes is None:
        return batch.filter(F.col(key).isNotNull())
    known = stored.select(key)
    if key_bytes <= broadcast_bytes:
        known = known.join(F.broadcast(batch.select(key)), key, "left_semi")
    return batch.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def candidates(batch: DataFrame, table: KeyedTable, stream_id: str, batch_id: int) -> DataFrame:
    """The stored rows, by key, that a batch is checked against, cut to whole files."""
    replaced = (F.col("stream_id") == stream_id) & (F.col("batch_id") >= batch_id)
    if not table.same_day_copies:
        return table.index.possible(batch, replaced)
    first, last = batch.agg(F.min("event_date"), F.max("event_date")).first()
    others = table.stored(batch.sparkSession).filter(~replaced)
    return others.filter(F.col("event_date").between(F.lit(first), F.lit(last)))


def insert_new(batch: DataFrame, table: KeyedTable, stream_id: str, batch_id: int) -> None:
    """Write the rows of one batch whose keys are new to the table, then their keys to its index.

    The rebalance groups rows by day for the partitioned write and lets the
    adaptive planner split a day that is much larger than the others.
    """
    if not table.same_day_copies:
        table.index.complete(table.stored(batch.sparkSession))
    fresh = unseen(batch, candidates(batch, table, stream_id, batch_id), table.key)
    stamped = fresh.hint("rebalance", "event_date").withColumns(
        {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LINEAGE, "event_date").parquet(table.path)
    if not table.same_day_copies:
        mine = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
        table.index.add(table.stored(batch.sparkSession).filter(mine).select(table.key, *LINEAGE))


def compact(spark: SparkSession, table: KeyedTable, path: str) -> KeyedTable:
    """A copy of a table under ``path`` with all finished batches merged into day files.

    The last batch of each stream keeps its own partition: only that one can be
    replayed, and a replay overwrites it. Earlier batches become one partition
    per day, whatever their number. Run it while the stream is stopped, then start
    the stream on the copy with the same checkpoint; the old folder stays as it is.
    """
    stored = table.stored(spark)
    last = stored.groupBy("stream_id").agg(F.max("batch_id").alias("last_batch"))
    # One row per stream, so the join is a broadcast of a few rows by size.
    marked = stored.join(last, "stream_id")
    final = F.col("batch_id") == F.col("last_batch")
    merged = marked.withColumns(
        {
            "stream_id": F.when(final, F.col("stream_id")).otherwise(F.lit(COMPACTED)),
            "batch_id": F.when(final, F.col("batch_id")).otherwise(F.lit(0).cast("bigint")),
        }
    ).select(*stored.columns)
    merged.hint("rebalance", "event_date").write.partitionBy(*LINEAGE, "event_date").parquet(path)
    return replace(table, path=path)


def make_upsert(
    events: KeyedTable, orders: KeyedTable, rejects_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback: clean, then events, then orders.

    Orders are split from the whole clean batch, not from the rows just
    inserted, so a crash between the two writes is repaired by the replay.
    Rejected rows are kept only when a path is given for them.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        parsed = parse_events(batch)
        clean = clean_events(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        new_orders = split_orders(clean).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            insert_new(clean, events, stream_id, batch_id)
            insert_new(new_orders, orders, stream_id, batch_id)
        finally:
            new_orders.unpersist()
            clean.unpersist()
        if rejects_path is not None:
            stamped = reject_events(parsed).withColumns(
                {"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")}
            )
            writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*LINEAGE).parquet(rejects_path)

    return upsert


def start_silver(
    bronze: DataFrame,
    events: KeyedTable,
    orders: KeyedTable,
    checkpoint: str,
    trigger: Mapping[str, Any] = DRAIN,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Run the upsert over a stream of bronze rows."""
    writer = bronze.writeStream.foreachBatch(make_upsert(events, orders, rejects_path))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
