import datetime as dt

from library_rows import event, order
from pyspark.sql import functions as F

from tidemart.operators.silver import clean_events, parse_events, reject_events, split_orders


def test_parse_types_the_payload(log):
    row = parse_events(log([event()])).first()
    assert (row.event_id, row.event_type) == ("view-17", "page_view")
    assert row.event_date == dt.date(2025, 3, 14)
    assert row.event_ts == dt.datetime(2025, 3, 14, 8, 30)


def test_unreadable_payloads_become_nulls_not_errors(log):
    payloads = [
        b"not json",
        None,
        b"\xff\xfe{",
        event("e4", event_ts="garbage"),
        event("e5", "purchase", order=order(quantity="two")),
        event("e6", surprise="field"),
    ]
    rows = parse_events(log(payloads)).orderBy("offset").collect()
    assert [r.event_id for r in rows] == [None, None, None, "e4", "e5", "e6"]
    assert rows[3].event_ts is None and rows[3].event_date is None
    assert rows[4].order.quantity is None and rows[4].order.order_id == "basket-5"
    kept = clean_events(parse_events(log(payloads))).orderBy("offset").collect()
    assert [r.event_id for r in kept] == ["e5", "e6"]


def test_clean_keeps_one_valid_row_per_event(log):
    refused = [event(f"bad-{field}", **{field: None}) for field in ("user_id", "session_id", "event_ts")]
    twice = [event("ok-a"), event("ok-b", "checkout"), event("ok-a"), event("ok-b", "checkout")]
    rows = clean_events(parse_events(log([*refused, event("bad-type", "refund"), *twice]))).collect()
    assert sorted((r.event_id, r.offset) for r in rows) == [("ok-a", 4), ("ok-b", 5)]


def test_the_earliest_copy_survives_whatever_the_partitioning(log):
    records = log([event("e1", device=f"d{i}") for i in range(200)]).repartition(7)
    assert clean_events(parse_events(records)).first().device == "d0"


def test_rejects_complement_clean_rows(log):
    payloads = [
        event("e1"),
        event("e2", "hack"),
        event("e3", user_id=None),
        event("e4", event_ts=None),
        event("e5", event_type=None),
        b"junk",
    ]
    parsed = parse_events(log(payloads))
    reasons = {r.offset: r.reject_reason for r in reject_events(parsed).collect()}
    assert reasons == {
        1: "unknown_event_type",
        2: "missing_user_id",
        3: "missing_event_ts",
        4: "unknown_event_type",
        5: "missing_event_id",
    }


def test_payload_is_decoded_once_per_record(log):
    plan = clean_events(parse_events(log([event()])))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_json") == 1


def test_split_orders_keeps_positive_purchases_once(log):
    payloads = [
        event("e1", "purchase", order=order("o1")),
        event("e2", "purchase", order=order("o2", 0.0)),
        event("e3", "purchase", order=order("o3", -1.0)),
        event("e4", "purchase", order=order("o4", None)),
        event("e9", "purchase", order=order("o9", float("nan"))),
        event("e5", "purchase"),
        event("e6", "page_view", order=order("o6")),
        event("e7", "purchase", order=order("o1", 10.0)),
        event("e8"),
    ]
    orders = split_orders(clean_events(parse_events(log(payloads))))
    row = orders.collect()
    assert [(r.order_id, r.order_total, r.quantity) for r in row] == [("o1", 37.5, 3)]
    assert len(orders.columns) == 13


def test_copies_are_reduced_before_the_shuffle(log):
    plan = clean_events(parse_events(log([event()])))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_one_hot_key_leaves_its_map_tasks_as_single_rows(spark, log):
    records = log([event("hot") for _ in range(3000)] + [event("cold")]).repartition(6)
    assert clean_events(parse_events(records)).agg(F.count("*")).first()[0] == 2
