import datetime as dt
import re

import pytest
from library_rows import event, order
from pyspark.sql import functions as F

from tidemart.contracts import BRONZE, KAFKA_RECORD, RAW_DAILY_SALES
from tidemart.sources.kafka import file_stream, kafka_options
from tidemart.streaming import bronze, ingest, silver
from tidemart.streaming.key_index import KeyIndex, probed
from tidemart.streaming.routing import route_events
from tidemart.streaming.triggers import every


class Paths:
    def __init__(self, root):
        self.log, self.bronze = f"{root}/log", f"{root}/bronze"
        self.events = silver.events_table(f"{root}/events")
        self.orders = silver.orders_table(f"{root}/orders")
        self.rejects = f"{root}/rejects"
        self.root = root


@pytest.fixture
def lake(tmp_path):
    return Paths(str(tmp_path))


def drain(spark, lake, checkpoint="main", **options):
    log = file_stream(spark, lake.log, KAFKA_RECORD)
    bronze.start_bronze(log, lake.bronze, f"{lake.root}/cp-bronze").awaitTermination()
    stream = file_stream(spark, lake.bronze, BRONZE)
    silver.start_silver(
        stream, lake.events, lake.orders, f"{lake.root}/cp-{checkpoint}", **options
    ).awaitTermination()


def ids(spark, lake):
    events = sorted(r.event_id for r in lake.events.read(spark).collect())
    orders = sorted(r.order_id for r in lake.orders.read(spark).collect())
    return events, orders


def test_bronze_keeps_the_bytes(spark, lake, log):
    log([event("e1"), b"junk \xff", None]).write.parquet(lake.log)
    records = file_stream(spark, lake.log, KAFKA_RECORD)
    bronze.start_bronze(records, lake.bronze, f"{lake.root}/cp").awaitTermination()
    rows = spark.read.schema(BRONZE).parquet(lake.bronze).orderBy("offset").collect()
    assert [r.value for r in rows][1:] == [bytearray(b"junk \xff"), None]
    assert {r.topic for r in rows} == {"clickstream"} and rows[0].key == "ada"
    assert all(r.ingested_at is not None for r in rows)


def test_silver_is_unique_over_batches_replays_and_lost_checkpoints(spark, lake, log):
    first = [event("e1"), event("e1"), event("e2", "purchase", order=order("o1"))]
    second = [event("e2", "purchase", order=order("o1")), event("e3"), event("e4", "hack")]
    third = [event("e5", "purchase", order=order("o2")), event("e6", "purchase", order=order(None))]
    log(first).write.parquet(lake.log)
    drain(spark, lake)
    assert ids(spark, lake) == (["e1", "e2"], ["o1"])
    log(second, 10).write.mode("append").parquet(lake.log)
    drain(spark, lake)
    assert ids(spark, lake) == (["e1", "e2", "e3"], ["o1"])
    drain(spark, lake)
    assert ids(spark, lake) == (["e1", "e2", "e3"], ["o1"])
    drain(spark, lake, "lost")
    assert ids(spark, lake) == (["e1", "e2", "e3"], ["o1"])
    log(third, 20).write.mode("append").parquet(lake.log)
    drain(spark, lake, "lost")
    assert ids(spark, lake) == (["e1", "e2", "e3", "e5", "e6"], ["o1", "o2"])


def test_compaction_merges_batches_and_stays_safe_to_replay(spark, lake, log):
    payloads = [event(f"e{i}", "purchase", order=order(f"o{i % 9}")) for i in range(12)]
    for number in range(4):
        log(payloads[3 * number : 3 * number + 3], 10 * number).write.mode("append").parquet(lake.log)
        drain(spark, lake)
    before = ids(spark, lake)
    lake.events = silver.compact(spark, lake.events, f"{lake.root}/events-2")
    lake.orders = silver.compact(spark, lake.orders, f"{lake.root}/orders-2")
    assert ids(spark, lake) == before
    streams = {r.stream_id for r in lake.events.stored(spark).select("stream_id").distinct().collect()}
    assert silver.COMPACTED in streams and len(streams) == 2
    # The last batch again, all of the log again, and new records.
    drain(spark, lake)
    drain(spark, lake, "lost")
    assert ids(spark, lake) == before
    log([event("e99")], 90).write.mode("append").parquet(lake.log)
    drain(spark, lake)
    assert ids(spark, lake)[0] == sorted([*before[0], "e99"])


def test_the_first_write_wins(spark, lake, log):
    log([event("e1", device="mobile")]).write.parquet(lake.log)
    drain(spark, lake)
    log([event("e1", device="tablet")], 5).write.mode("append").parquet(lake.log)
    drain(spark, lake)
    assert [r.device for r in lake.events.read(spark).collect()] == ["mobile"]


def test_same_day_lookup_reads_only_the_days_of_the_batch(spark, lake, log):
    table = silver.events_table(lake.events.path, same_day_copies=True)

    def insert(payloads, batch):
        clean = silver.clean_events(silver.parse_events(log(payloads))).persist()
        silver.insert_new(clean, table, "s1", batch)

    other = {"event_ts": "2026-08-01T00:00:00Z"}
    insert([event("e1"), event("e2", **other)], 0)
    insert([event("e1"), event("e2", **other), event("e3")], 1)
    assert sorted(r.event_id for r in table.read(spark).collect()) == ["e1", "e2", "e3"]
    batch = silver.clean_events(silver.parse_events(log([event("e9")])))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        narrow = silver.candidates(batch, table, "s1", 2).select("event_id")
        plan = narrow._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert re.search(r"event_date#\d+ [=>]", filters)
    days = {r.event_date for r in silver.candidates(batch, table, "s1", 2).collect()}
    assert days == {dt.date(2025, 3, 14)}


def insert(log, table, payloads, batch, stream="s1"):
    clean = silver.clean_events(silver.parse_events(log(payloads))).persist()
    silver.insert_new(clean, table, stream, batch)
    clean.unpersist()


def batch_of(log, *names, **changes):
    return silver.clean_events(silver.parse_events(log([event(n, **changes) for n in names])))


def test_a_batch_reads_only_the_key_files_that_may_hold_its_keys(spark, lake, log):
    table = lake.events
    for number in range(4):
        insert(log, table, [event(f"b{number}-{i}") for i in range(60)], number)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        keys = table.index.keys(spark).count()
        # Copies of two keys, on another day, among new keys.
        later = {"event_ts": "2026-08-01T00:00:00Z"}
        batch = batch_of(log, "b0-3", "b2-7", *[f"new-{i}" for i in range(40)], **later).persist()
        stored = silver.candidates(batch, table, "s2", 0)
        assert {"b0-3", "b2-7"} <= {r.event_id for r in stored.collect()}
        assert keys == 240 and stored.count() < keys / 3
        fresh = silver.unseen(batch, stored, "event_id")
        assert sorted(r.event_id for r in fresh.collect()) == sorted(f"new-{i}" for i in range(40))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # Of the stored keys only hit folders are scanned, and no exchange stands over them.
    scan = plan[plan.index("FileScan parquet") :]
    assert "PartitionFilters: [concat_ws" in scan
    assert "SortMergeJoin" not in plan and not re.search(r"Exchange hashpartitioning.*\n.*FileScan", plan)
    new = silver.candidates(batch_of(log, *[f"none-{i}" for i in range(5)]), table, "s2", 0)
    assert new.count() < keys / 10


def test_batches_missing_from_the_index_are_found(spark, lake, log):
    """A crash after the rows were written and before their keys; then the stream starts anew."""
    insert(log, lake.events, [event("e1"), event("e2")], 0)
    rows = lake.events.stored(spark).withColumn("batch_id", F.lit(1).cast("bigint")).withColumn("event_id", F.concat("event_id", F.lit("-b")))
    rows.write.mode("append").partitionBy("stream_id", "batch_id", "event_date").parquet(lake.events.path)
    insert(log, lake.events, [event("e1"), event("e1-b"), event("e3")], 0, "s2")
    assert sorted(r.event_id for r in lake.events.read(spark).collect()) == ["e1", "e1-b", "e2", "e2-b", "e3"]


def test_filters_hold_every_key(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), "event_id", 7)
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("event_id"), F.lit("s/1 x").alias("stream_id"), (F.col("id") % 3).alias("batch_id"))
    index.add(keys)
    asked = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("event_id"))
    met = probed(index.filters(spark), asked, "event_id", index.bucket())
    hits = {(r.event_id, r.batch_id) for r in met.collect()}
    assert {(f"k{i}", i % 3) for i in range(3000)} <= hits
    assert len(hits) - 3000 < 0.03 * 6000 * 3
    index.complete(keys.where("false"))
    assert index.possible(asked, F.lit(True)).count() == 0


def test_a_replayed_batch_rewrites_only_itself(spark, lake, log):
    def insert(payloads, batch, stream="s1"):
        clean = silver.clean_events(silver.parse_events(log(payloads))).persist()
        silver.insert_new(clean, lake.events, stream, batch)

    insert([event("e1"), event("e2")], 0)
    insert([event("e2"), event("e3")], 1)
    insert([event("e2"), event("e3")], 1)
    insert([event("e3"), event("e4")], 0, "s2")
    stored = lake.events.stored(spark).select("event_id", "stream_id", "batch_id").collect()
    assert sorted(tuple(r) for r in stored) == [
        ("e1", "s1", 0),
        ("e2", "s1", 0),
        ("e3", "s1", 1),
        ("e4", "s2", 0),
    ]


@pytest.mark.parametrize("limit, scan_is_shuffled", [(10**6, False), (0, True)])
def test_small_batches_never_shuffle_the_stored_table(spark, tmp_path, limit, scan_is_shuffled):
    path = str(tmp_path / "stored")
    spark.range(1000).select(F.concat(F.lit("e"), "id").alias("event_id")).write.parquet(path)
    stored = spark.read.schema("event_id STRING").parquet(path)
    batch = spark.createDataFrame([("e5",), ("new",), (None,)], "event_id STRING").persist()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = silver.unseen(batch, stored, "event_id", broadcast_bytes=limit)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert [r.event_id for r in fresh.collect()] == ["new"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan and "LeftSemi" in plan) is not scan_is_shuffled


def test_rejects_are_kept_on_request(spark, lake, log):
    log([event("e1"), event("e2", "hack"), b"junk"]).write.parquet(lake.log)
    drain(spark, lake, rejects_path=lake.rejects)
    reasons = sorted(r.reject_reason for r in spark.read.parquet(lake.rejects).collect())
    assert reasons == ["missing_event_id", "unknown_event_type"]


STAGED = "order_date STRING, product_category STRING, orders BIGINT, units BIGINT, revenue STRING"


def staged_rows(spark, *revenues):
    rows = [("2026-09-01", "books", 1, 2, revenue) for revenue in revenues]
    return spark.createDataFrame(rows, STAGED).coalesce(1)


def start_ingest(spark, root, **options):
    return ingest.start_ingest(
        spark, f"{root}/stage", STAGED, RAW_DAILY_SALES, f"{root}/raw", f"{root}/cp", **options
    )


def test_each_file_is_loaded_once(spark, tmp_path):
    stage = f"{tmp_path}/stage"
    staged_rows(spark, "1.5", "2.25").write.parquet(stage)
    start_ingest(spark, tmp_path).awaitTermination()
    start_ingest(spark, tmp_path).awaitTermination()
    staged_rows(spark, "3").write.mode("append").parquet(stage)
    start_ingest(spark, tmp_path).awaitTermination()
    loaded = spark.read.parquet(f"{tmp_path}/raw")
    assert sorted(str(r.revenue) for r in loaded.collect()) == ["1.50", "2.25", "3.00"]
    history = ingest.load_history(loaded).collect()
    assert sorted(r.rows_loaded for r in history) == [1, 2]
    tomorrow = dt.datetime.now() + dt.timedelta(days=2)
    assert ingest.load_history(loaded, hours=24, now=tomorrow).count() == 0
    assert ingest.load_history(loaded, hours=None).count() == 2


def test_a_bad_value_aborts_the_load(spark, tmp_path):
    staged_rows(spark, "1.5", "oops").write.parquet(f"{tmp_path}/stage")
    with pytest.raises(Exception, match="revenue: not a decimal"):
        start_ingest(spark, tmp_path).awaitTermination()
    assert spark.read.schema(RAW_DAILY_SALES).parquet(f"{tmp_path}/raw").count() == 0


def test_files_are_picked_up_on_arrival(spark, tmp_path):
    stage = f"{tmp_path}/stage"
    staged_rows(spark, "1").write.parquet(stage)
    query = start_ingest(spark, tmp_path, trigger=every("200 milliseconds"))
    try:
        query.processAllAvailable()
        staged_rows(spark, "2").write.mode("append").parquet(stage)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 2


def test_routing(spark, log):
    from tidemart.contracts import EVENT_PAYLOAD
    from tidemart.operators.silver import parse_events

    payloads = [event("e1"), event("e2", "purchase", user_id="u2", order=order("o1"))]
    events = spark.createDataFrame(payloads, EVENT_PAYLOAD)
    rows = route_events(events).collect()
    assert [(r.topic, bytes(r.key)) for r in rows] == [("clickstream", b"ada"), ("orders", b"u2")]
    back = parse_events(log([bytes(r.value) for r in rows])).orderBy("offset").collect()
    assert back[1].order.order_id == "o1" and back[0].order is None


def test_kafka_options():
    plain = kafka_options("broker:9092")
    assert plain["subscribe"] == "clickstream,orders"
    assert plain["startingOffsets"] == "earliest" and plain["failOnDataLoss"] == "false"
    secure = kafka_options("broker:9093", "user", "secret", min_partitions=64)
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert secure["kafka.sasl.mechanism"] == "PLAIN" and secure["minPartitions"] == "64"
    assert 'username="user" password="secret"' in secure["kafka.sasl.jaas.config"]


STAGED = "order_date DATE, product_category STRING, orders STRING, units BIGINT, revenue DOUBLE"


def test_tracked_ingest_gives_every_file_a_status(spark, tmp_path):
    root = str(tmp_path)
    day = dt.date(2025, 3, 14)

    def stage(name, orders):
        rows = [(day, "books", n, 1, 2.5) for n in orders]
        spark.createDataFrame(rows, STAGED).coalesce(1).write.parquet(f"{root}/stage/{name}")

    def run():
        ingest.start_tracked_ingest(
            spark, f"{root}/stage/*", STAGED, RAW_DAILY_SALES, f"{root}/raw", f"{root}/history", f"{root}/cp"
        ).awaitTermination()

    stage("good one+a", ["1", "2"])
    stage("bad", ["3", "x", "y"])
    stage("empty", [])
    run()
    stage("later", ["4"])
    run()
    run()
    history = {
        re.search("stage/([^/]+)/", r.source_file)[1]: (r.status, r.rows_loaded, r.bad_rows, r.error)
        for r in ingest.file_history(spark.read.parquet(f"{root}/history")).collect()
    }
    assert history == {
        "good one+a": ("loaded", 2, 0, None),
        "bad": ("failed", 0, 2, "orders: not a bigint: x"),
        "empty": ("empty", 0, 0, None),
        "later": ("loaded", 1, 0, None),
    }
    assert sorted(r.orders for r in spark.read.parquet(f"{root}/raw").collect()) == [1, 2, 4]


def test_refresh_rewrites_touched_days_only(spark, lake, log):
    from tidemart.plans.refresh import refresh_gold

    root = f"{lake.root}/by_day"

    def run(batch, *days_and_names):
        payloads = [
            event(n, "purchase", order=order(f"o-{n}"), event_ts=f"2025-03-{day:02d}T08:30:00+00:00") for day, n in days_and_names
        ]
        clean = silver.clean_events(silver.parse_events(log(payloads))).persist()
        silver.insert_new(clean, lake.events, "s1", batch)
        silver.insert_new(silver.split_orders(clean), lake.orders, "s1", batch)
        clean.unpersist()
        return refresh_gold(spark, lake.events, lake.orders, root)

    def files():
        frame = spark.read.parquet(f"{root}/daily_sales")
        return {(r.order_date, r.orders, r.f) for r in frame.select("order_date", "orders", F.input_file_name().alias("f")).collect()}

    assert run(0, (1, "a"), (2, "b"), (2, "c"))["daily_sales"] == [dt.date(2025, 3, 1), dt.date(2025, 3, 2)]
    first = files()
    assert run(1, (2, "d"), (3, "e"), (1, "a"))["daily_sales"] == [dt.date(2025, 3, 2), dt.date(2025, 3, 3)]
    second = files()
    assert {f for f in first if f[0].day == 1} == {f for f in second if f[0].day == 1}
    assert sorted((d.day, n) for d, n, _ in second) == [(1, 1), (2, 3), (3, 1)]
    assert refresh_gold(spark, lake.events, lake.orders, root) == {"daily_sales": [], "funnel_daily": []}
