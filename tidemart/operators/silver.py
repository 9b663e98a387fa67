"""Bronze records to typed, validated, de-duplicated events and orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.contracts import EVENT_PAYLOAD, EVENT_TYPES, SILVER_ORDERS
from tidemart.operators.keyed import lowest_per_key

# Position of a record in the log: the tie-break between copies of one key.
LOG_ORDER = ["topic", "partition", "offset"]


def _rules() -> dict[str, Column]:
    """Reject reason -> condition a row must meet; the first broken one is reported."""
    required = ("event_id", "event_ts", "user_id", "session_id")
    rules = {f"missing_{name}": F.col(name).isNotNull() for name in required}
    known = F.col("event_type").isin(EVENT_TYPES)
    return rules | {"unknown_event_type": F.coalesce(known, F.lit(False))}


def parse_events(bronze: DataFrame) -> DataFrame:
    """Decode the JSON payload; unreadable fields become NULL, never an error.

    The decoded struct is unpacked with ``inline`` rather than selected field by
    field: filters on its fields then stay above the decoding step. Otherwise
    the optimizer moves each of them below it, where every rule decodes the
    payload again.
    """
    payload = F.from_json(F.col("value").cast("string"), EVENT_PAYLOAD)
    decoded = bronze.select(
        *LOG_ORDER, F.col("timestamp").alias("kafka_ts"), F.inline(F.array(payload))
    )
    typed = decoded.withColumn("event_ts", F.try_to_timestamp("event_ts"))
    return typed.withColumn("event_date", F.to_date("event_ts"))


def clean_events(parsed: DataFrame) -> DataFrame:
    """Rows that pass every rule, one per ``event_id`` (earliest in the log)."""
    valid = reduce(lambda kept, rule: kept & rule, _rules().values())
    return lowest_per_key(parsed.filter(valid), ["event_id"], LOG_ORDER)


def reject_events(parsed: DataFrame) -> DataFrame:
    """The rows ``clean_events`` refuses, with the first rule each one breaks."""
    broken = [F.when(~passes, F.lit(name)) for name, passes in _rules().items()]
    flagged = parsed.withColumn("reject_reason", F.coalesce(*broken))
    return flagged.filter(F.col("reject_reason").isNotNull())


def split_orders(events: DataFrame) -> DataFrame:
    """Purchases with a positive total, flattened to one row per ``order_id``.

    NaN compares above every number but is no total: such orders are left out.
    """
    total = F.col("order.order_total")
    purchases = events.filter(
        (F.col("event_type") == "purchase") & (total > 0) & ~F.isnan(total)
    )
    orders = StructType.fromDDL(SILVER_ORDERS).names
    flat = purchases.select("*", "order.*").select(*orders, *LOG_ORDER)
    return lowest_per_key(flat, ["order_id"], LOG_ORDER).drop(*LOG_ORDER)
