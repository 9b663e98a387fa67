"""Schemas and enumerations shared by every layer.

Everything in this file is a fixed value: column names, types and allowed
values are the data contract, so they are stated once and plainly.
"""

# --- fixed values: enumerations ------------------------------------------------

EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]
CATEGORIES = ["electronics", "apparel", "home_kitchen", "beauty", "sports", "books"]
DEVICES = ["mobile", "desktop", "tablet"]
PAYMENT_METHODS = ["card", "paypal", "apple_pay"]
SENTIMENT_STATUSES = ["HEALTHY", "WATCH", "AT RISK"]
SEGMENTS = ["LOYAL", "CUSTOMER", "HOT_PROSPECT", "CART_ABANDONER", "BROWSER"]
SCORE_BANDS = ["LOW", "MEDIUM", "HIGH"]
TOPIC_CLICKSTREAM = "clickstream"
TOPIC_ORDERS = "orders"

# Funnel step (event type) -> column of the daily funnel table, in step order.
FUNNEL_COLUMNS = {
    "page_view": "page_views",
    "product_view": "product_views",
    "add_to_cart": "add_to_carts",
    "checkout": "checkouts",
    "purchase": "purchases",
}

# --- fixed values: schemas (Spark DDL) -----------------------------------------

ORDER_FIELDS = (
    "order_id: STRING, quantity: INT, unit_price: DOUBLE, "
    "order_total: DOUBLE, currency: STRING, payment_method: STRING"
)

EVENT_PAYLOAD = f"""
    event_id STRING, event_type STRING, event_ts STRING,
    user_id STRING, session_id STRING, device STRING,
    product_id STRING, product_category STRING,
    `order` STRUCT<{ORDER_FIELDS}>
"""

KAFKA_RECORD = """
    key BINARY, value BINARY, topic STRING,
    `partition` INT, `offset` BIGINT, timestamp TIMESTAMP
"""

BRONZE = """
    topic STRING, `partition` INT, `offset` BIGINT, timestamp TIMESTAMP,
    key STRING, value BINARY, ingested_at TIMESTAMP
"""

SILVER_EVENTS = f"""
    topic STRING, `partition` INT, `offset` BIGINT, kafka_ts TIMESTAMP,
    event_id STRING, event_type STRING, event_ts TIMESTAMP,
    user_id STRING, session_id STRING, device STRING,
    product_id STRING, product_category STRING,
    `order` STRUCT<{ORDER_FIELDS}>, event_date DATE
"""

SILVER_ORDERS = """
    order_id STRING, event_ts TIMESTAMP, event_date DATE,
    user_id STRING, session_id STRING, device STRING,
    product_id STRING, product_category STRING,
    quantity INT, unit_price DOUBLE, order_total DOUBLE,
    currency STRING, payment_method STRING
"""

# A review record as it is downloaded, and with its position in its slice.
REVIEW_FIELDS = "rating DOUBLE, title STRING, text STRING, timestamp BIGINT"
REVIEW_SOURCE = f"seq BIGINT, {REVIEW_FIELDS}"

REVIEWS = """
    review_id STRING, product_category STRING, star_rating INT,
    review_title STRING, review_text STRING, review_date DATE
"""

RAW_DAILY_SALES = """
    order_date DATE, product_category STRING, orders BIGINT, units BIGINT,
    revenue DECIMAL(18,2)
"""

RAW_FUNNEL_DAILY = """
    event_date DATE, page_views BIGINT, product_views BIGINT,
    add_to_carts BIGINT, checkouts BIGINT, purchases BIGINT
"""

RAW_REVIEW_SENTIMENT = """
    review_id STRING, product_category STRING, star_rating BIGINT,
    review_text STRING, sentiment_label STRING, sentiment_score DOUBLE,
    review_date DATE
"""

RAW_USER_PROPENSITY = """
    user_id STRING, sessions_30d BIGINT, events_30d BIGINT,
    cart_adds_30d BIGINT, purchases_prior BIGINT, propensity_score DOUBLE,
    score_band STRING, model_version STRING, scored_at TIMESTAMP
"""

# Gold directory name -> (warehouse table, schema); the warehouse side of every
# table also carries a loaded_at column stamped by the sink.
WAREHOUSE_TABLES = {
    "daily_sales": ("raw_daily_sales", RAW_DAILY_SALES),
    "funnel_daily": ("raw_funnel_daily", RAW_FUNNEL_DAILY),
    "review_sentiment": ("raw_review_sentiment", RAW_REVIEW_SENTIMENT),
    "user_propensity": ("raw_user_propensity", RAW_USER_PROPENSITY),
}

# --- fixed values: limits and thresholds ---------------------------------------

LOYAL_PURCHASES = 3
HEALTHY_SENTIMENT = 0.5
WATCH_SENTIMENT = 0.0
BAND_EDGES = {"LOW": 0.33, "MEDIUM": 0.66, "HIGH": 1.0}
BAND_FLOOR = -0.01
FRESHNESS_WARN_HOURS = 36
FRESHNESS_ERROR_HOURS = 72
