"""The given star-schema tables, mapped onto the shapes the pipeline reads.

The only module that knows the column names of the test tables. The mapping
rules are deterministic expressions over whole tables, so that the same
mapping can be written in SQL for comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.contracts import CATEGORIES, DEVICES, KAFKA_RECORD, REVIEW_SOURCE
from tidemart.operators.silver import clean_events, parse_events, split_orders
from tidemart.sources.tables import read_table, shuffle_tasks, spread
from tidemart.streaming.routing import route_events

# --- fixed values: the word list that scores the invented prose of `documents`,
# which holds no real opinion words. Arbitrary, but common in the text.
PROSE_POSITIVE = ["and", "are", "das", "est", "for", "la", "les", "por", "und", "was", "with"]
PROSE_NEGATIVE = ["by", "de", "die", "from", "le", "not", "on", "que", "that", "this", "von"]


# --- fixed values: columns of the given tables that are read here
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "orders": "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    "part": "p_partkey BIGINT, p_type STRING",
    "documents": "doc_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table under its declared schema, so no job runs to infer one."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def _pick(values: list[str], number: Column) -> Column:
    """The list entry at ``number`` modulo the list's length."""
    return F.element_at(F.lit(values), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as contract events, plus the log columns ``number`` and ``ts``.

    Encoding and decoding the payloads is spread over the cores as the topic
    partitions would spread it, in case the file has too few splits.
    """
    cores = spark.sparkContext.defaultParallelism
    events = spread(table(spark, sf_dir, "events"), cores)
    number, purchase = F.col("event_id"), F.col("event_type") == "purchase"
    kind = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "click", "product_view")
        .when(F.col("event_type") == "signup", "add_to_cart")
        .when((F.col("event_type") == "error") & (number % 2 == 0), "checkout")
        .otherwise(F.col("event_type"))
    )
    user = F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    day = F.to_date("ts").cast("string")
    category = _pick(CATEGORIES, number)
    product = F.lpad((number % 400 + 1).cast("string"), 4, "0")
    quantity = (number % 3 + 1).cast("int")
    price = F.col("value").cast("decimal(18,2)")
    order = F.struct(
        F.concat(F.lit("ord-"), number.cast("string")).alias("order_id"),
        quantity.alias("quantity"),
        F.col("value").alias("unit_price"),
        (price * quantity).cast("double").alias("order_total"),
        F.lit("USD").alias("currency"),
        F.lit("card").alias("payment_method"),
    )
    return events.select(
        F.concat(F.lit("e"), number.cast("string")).alias("event_id"),
        kind.alias("event_type"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias(
            "event_ts"
        ),
        user.alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
        _pick(DEVICES, number).alias("device"),
        F.concat(F.upper(F.substring(category, 1, 4)), F.lit("-"), product).alias("product_id"),
        category.alias("product_category"),
        F.when(purchase, order).alias("order"),
        number.alias("number"),
        F.col("user_id").alias("user_number"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as log records; every 50th one is delivered twice."""
    copies = F.when(F.col("number") % 50 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    delivered = event_payloads(spark, sf_dir).withColumn("copy", F.explode(copies))
    routed = route_events(delivered, "number", "user_number", "timestamp", "copy")
    return routed.select(
        "key",
        "value",
        "topic",
        F.pmod("user_number", F.lit(4)).cast("int").alias("partition"),
        (F.col("number") * 2 + F.col("copy")).alias("offset"),
        "timestamp",
    ).to(StructType.fromDDL(KAFKA_RECORD))


def odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with broken rows by rule, on the event number.

    Of every 40: 1 has no event id, 2 no user, 3 an empty session (kept), 4 an
    unreadable time, 5 a payload that is no JSON, 6 no payload. Purchases numbered 3 modulo 7
    share an order id in pairs, and those 2 modulo 11 have NaN as total.
    """
    payloads = event_payloads(spark, sf_dir)
    turn = F.col("number") % 40
    missing = F.lit(None).cast("string")
    order = F.col("order")
    paired = F.col("number") % 7 == 3
    shared = F.concat(F.lit("pair-"), F.floor(F.col("number") / 14).cast("string"))
    total = F.when(F.col("number") % 11 == 2, F.lit(float("nan"))).otherwise(order["order_total"])
    changed = payloads.withColumns(
        {
            "event_id": F.when(turn == 1, missing).otherwise(F.col("event_id")),
            "user_id": F.when(turn == 2, missing).otherwise(F.col("user_id")),
            "session_id": F.when(turn == 3, "").otherwise(F.col("session_id")),
            "event_ts": F.when(turn == 4, "yesterday").otherwise(F.col("event_ts")),
            "order": F.when(
                order.isNotNull(),
                order.withField("order_id", F.when(paired, shared).otherwise(order["order_id"])).withField(
                    "order_total", total
                ),
            ),
        }
    )
    routed = route_events(changed, "number", "user_number", "timestamp")
    value = F.when(turn == 5, F.lit("{broken").cast("binary")).when(turn != 6, F.col("value"))
    return routed.select(
        "key",
        value.alias("value"),
        "topic",
        F.pmod("user_number", F.lit(4)).cast("int").alias("partition"),
        F.col("number").alias("offset"),
        "timestamp",
    ).to(StructType.fromDDL(KAFKA_RECORD))


def odd_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review records: of every 9, text 1 is blank, 2 missing, rating 3 is 0.9, 4 is 6, 5 missing."""
    turn = F.col("seq") % 9
    text = F.when(turn == 1, " \n\t ").when(turn != 2, F.col("text"))
    rating = F.when(turn == 3, 0.9).when(turn == 4, 6.0).when(turn != 5, F.col("rating"))
    return review_records(spark, sf_dir).withColumns({"text": text, "rating": rating})


def odd_raw(sales, funnel, sentiment, propensity, spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables with rows the staging filters must drop and letters they must fold."""
    day = F.dayofmonth("order_date")
    odd_sales = sales(spark, sf_dir).withColumns(
        {
            "product_category": F.initcap("product_category"),
            "revenue": F.when(day % 5 == 1, -F.col("revenue")).otherwise(F.col("revenue")),
            "order_date": F.when(day % 5 != 2, F.col("order_date")),
        }
    )
    odd_funnel = funnel(spark, sf_dir).withColumn(
        "event_date", F.when(F.dayofmonth("event_date") % 5 != 1, F.col("event_date"))
    )
    number = F.substring_index("review_id", "-", -1).cast("bigint")
    odd_sentiment = sentiment(spark, sf_dir).withColumns(
        {
            "sentiment_label": F.lower("sentiment_label"),
            "star_rating": F.when(number % 5 == 1, 6).when(number % 5 == 2, 0).otherwise(F.col("star_rating")),
            "review_id": F.when(number % 5 != 3, F.col("review_id")),
        }
    )
    events = F.col("events_30d")
    odd_propensity = propensity(spark, sf_dir).withColumns(
        {
            "score_band": F.lower("score_band"),
            "propensity_score": F.when(events % 5 == 1, F.col("propensity_score") + 1.5)
            .when(events % 5 == 2, F.lit(None))
            .otherwise(F.col("propensity_score")),
            "user_id": F.when(events % 5 != 3, F.col("user_id")),
        }
    )
    return {
        "raw_daily_sales": odd_sales,
        "raw_funnel_daily": odd_funnel,
        "raw_review_sentiment": odd_sentiment,
        "raw_user_propensity": odd_propensity,
    }


def odd_marts(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts with a missing key per rule, repeated keys, and days whose shares do not add up."""
    revenue, funnel = marts["fct_daily_revenue"], marts["fct_funnel_conversion"]
    sentiment, users = marts["fct_category_sentiment"], marts["dim_user_segments"]
    day = F.dayofmonth("order_date")
    books = F.col("product_category") == "books"
    first = F.dayofmonth("event_date") == 1
    few = F.col("events_30d") % 7 == 1
    return {
        "fct_daily_revenue": revenue.withColumns(
            {
                "category_revenue_share": F.when(books & (day % 3 == 1), 2.0).otherwise(
                    F.col("category_revenue_share")
                ),
                "revenue": F.when(books & (day % 4 == 1), F.lit(None)).otherwise(F.col("revenue")),
            }
        ).withColumn("product_category", F.when(~books | (day % 5 != 1), F.col("product_category"))),
        "fct_funnel_conversion": funnel.unionByName(funnel.filter(first)).unionByName(
            funnel.filter(F.dayofmonth("event_date") == 2).withColumn("event_date", F.lit(None).cast("date"))
        ),
        "fct_category_sentiment": sentiment.unionByName(sentiment.filter(books)).unionByName(
            sentiment.filter(books).withColumn("product_category", F.lit(None).cast("string"))
        ),
        "dim_user_segments": users.unionByName(users.filter(few)).withColumn(
            "user_id", F.when(F.col("events_30d") % 7 != 2, F.col("user_id"))
        ),
    }


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(kafka_records(spark, sf_dir))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(parsed_events(spark, sf_dir))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(silver_events(spark, sf_dir))


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` with its order date and part type, in the silver order shape.

    Order keys repeat across lines and categories here, so counts must be
    distinct ones. Tables too large for the session's shuffle partitions are shuffled into as
    many as their rows need, and joined by hashing the parts and orders of a partition, so a task's
    memory does not depend on the tables.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    tasks = shuffle_tasks(lines, orders, parts)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        parts = parts.repartition(tasks, "p_partkey").hint("shuffle_hash")
        orders = orders.repartition(tasks, "o_orderkey").hint("shuffle_hash")
        typed = lines.repartition(tasks, "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
        lines = typed.repartition(tasks, "l_orderkey")
        return _line_orders(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return _line_orders(joined)


def _line_orders(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("event_date"),
        F.lower("p_type").alias("product_category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("order_total"),
    )


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` with the stars their labels imply, as raw review records."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    number = F.col("doc_id")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    stars = (
        F.when(good & toxic, F.lit(3).cast("bigint"))
        .when(good, number % 2 + 4)
        .when(toxic, F.lit(1).cast("bigint"))
        .when(F.col("quality").isNotNull(), F.lit(2).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    shaped = documents.join(labels, "doc_id", "left").select(
        number.alias("seq"),
        stars.cast("double").alias("rating"),
        F.col("text").alias("title"),
        "text",
        (F.lit(1704067200000) + number * 3600000).alias("timestamp"),
    )
    category = _pick(CATEGORIES, F.col("seq"))
    return shaped.to(StructType.fromDDL(REVIEW_SOURCE)).withColumn("product_category", category)


def write_review_slices(spark: SparkSession, sf_dir: str, path: str) -> dict[str, str]:
    """Land the review records as one folder per category; category -> folder."""
    review_records(spark, sf_dir).write.partitionBy("product_category").parquet(path)
    return {category: f"{path}/product_category={category}" for category in CATEGORIES}


# A task that writes review records gets about this many bytes of text.
BYTES_PER_TASK = 128 * 1024 * 1024


def write_unnumbered_slices(spark: SparkSession, sf_dir: str, path: str, files: int = 5) -> dict[str, str]:
    """The review records in their order, without it: several files per category; category -> folder.

    More than ``files`` where the texts, each in a record twice, would be too many for one task.
    """
    text_bytes = table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(files, -(-2 * text_bytes // BYTES_PER_TASK))
    ordered = review_records(spark, sf_dir).repartitionByRange(files, "seq").sortWithinPartitions("product_category", "seq")
    ordered.drop("seq").write.partitionBy("product_category").parquet(path)
    return {category: f"{path}/product_category={category}" for category in CATEGORIES}


def thinned_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The log with stretches removed by rule, and what each of its partitions should hold.

    Offsets 13 to 19 of every 97 are gone, and the first 300 of all.
    """
    log = kafka_records(spark, sf_dir)
    expected = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 4).alias("next_offset")
    )
    place = F.col("offset") % 97
    return log.where(~place.between(13, 19) & (F.col("offset") >= 300)), expected
