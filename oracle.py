"""The registered queries in SQL, over the given tables.

Written as named fragments; ``statement`` prefixes a query with the fragments
it needs. Rounding is done in integers, half away from zero, so that the result
does not depend on how an engine rounds doubles.
"""

from __future__ import annotations

import re

from tidemart.sources.testdata import PROSE_NEGATIVE, PROSE_POSITIVE


def half_up(num: str, den: str, places: int) -> str:
    scale = 10**places
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE (sign({num})::HUGEINT * "
        f"((2 * abs(({num})::HUGEINT) * {scale} + ({den})) // (2 * ({den}))))::DOUBLE / {scale} END)"
    )


def words(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def hits(values: list[str]) -> str:
    return (
        "len(list_filter(regexp_extract_all(lower(review_text), '[a-z]+'), "
        f"lambda w: w IN ({words(values)})))"
    )


PICK_CATEGORY = (
    "list_extract(['electronics','apparel','home_kitchen','beauty','sports','books'], "
    "({n} % 6 + 1)::INTEGER)"
)

FRAGMENTS = {
    "payloads": f"""
        SELECT event_id AS number, user_id AS user_number, ts,
            'e' || event_id AS event_id,
            CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
                WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN
                    CASE WHEN event_id % 2 = 0 THEN 'checkout' ELSE 'error' END
                ELSE event_type END AS event_type,
            ts AS event_ts, ts::DATE AS event_date,
            'u' || lpad(user_id::VARCHAR, 6, '0') AS user_id,
            user_id || '-' || ts::DATE AS session_id,
            list_extract(['mobile','desktop','tablet'], (event_id % 3 + 1)::INTEGER) AS device,
            upper(substr({PICK_CATEGORY.format(n='event_id')}, 1, 4)) || '-'
                || lpad((event_id % 400 + 1)::VARCHAR, 4, '0') AS product_id,
            {PICK_CATEGORY.format(n='event_id')} AS product_category,
            CASE WHEN event_type = 'purchase' THEN 'ord-' || event_id END AS order_id,
            CASE WHEN event_type = 'purchase' THEN (event_id % 3 + 1)::INTEGER END AS quantity,
            CASE WHEN event_type = 'purchase' THEN value END AS unit_price,
            CASE WHEN event_type = 'purchase'
                THEN (value::DECIMAL(18,2) * (event_id % 3 + 1))::DOUBLE END AS order_total,
            CASE WHEN event_type = 'purchase' THEN 'USD' END AS currency,
            CASE WHEN event_type = 'purchase' THEN 'card' END AS payment_method
        FROM events""",
    "records": """
        SELECT CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'clickstream' END AS topic,
            (user_number % 4)::INTEGER AS "partition", number * 2 + copy AS "offset",
            ts AS kafka_ts, p.* EXCLUDE (number, user_number, ts)
        FROM payloads p JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR number % 50 = 0""",
    "silver": """
        SELECT * FROM records
        WHERE event_type IN ('page_view','product_view','add_to_cart','checkout','purchase')
        QUALIFY row_number() OVER (
            PARTITION BY event_id ORDER BY topic, "partition", "offset") = 1""",
    "silver_orders": """
        SELECT order_id, event_ts, event_date, user_id, session_id, device, product_id,
            product_category, quantity, unit_price, order_total, currency, payment_method
        FROM silver WHERE event_type = 'purchase' AND order_total > 0""",
    "sales": """
        SELECT event_date AS order_date, product_category, count(*) AS orders,
            sum(quantity)::BIGINT AS units,
            sum(order_total::DECIMAL(18,2))::DECIMAL(18,2) AS revenue
        FROM silver_orders GROUP BY 1, 2""",
    "line_sales": """
        SELECT o_orderdate::DATE AS order_date, lower(p_type) AS product_category,
            count(DISTINCT l_orderkey) AS orders, sum(l_quantity::INTEGER)::BIGINT AS units,
            sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(18,2) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2""",
    "funnel": """
        SELECT event_date,
            count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
            count(*) FILTER (WHERE event_type = 'product_view') AS product_views,
            count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_carts,
            count(*) FILTER (WHERE event_type = 'checkout') AS checkouts,
            count(*) FILTER (WHERE event_type = 'purchase') AS purchases
        FROM silver GROUP BY 1""",
    "behavior": """
        SELECT user_id, count(DISTINCT session_id) AS sessions_30d, count(*) AS events_30d,
            count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds_30d
        FROM silver GROUP BY 1""",
    "purchases": """
        SELECT user_id, count(DISTINCT order_id) AS purchases_prior
        FROM silver_orders GROUP BY 1""",
    "features": """
        SELECT b.*, coalesce(purchases_prior, 0) AS purchases_prior,
            (purchases_prior IS NOT NULL)::INTEGER AS did_purchase
        FROM behavior b LEFT JOIN purchases USING (user_id)""",
    "labelled": """
        SELECT b.user_id, (count(o.order_id) > 0)::INTEGER AS did_purchase
        FROM (SELECT DISTINCT user_id FROM silver WHERE event_date < DATE '2024-01-30') b
        LEFT JOIN (SELECT * FROM silver_orders WHERE event_date >= DATE '2024-01-30') o
            USING (user_id)
        GROUP BY 1""",
    "visits": """
        SELECT session_id AS user_id, 1::BIGINT AS sessions_30d, count(*) AS events_30d,
            count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds_30d,
            count(*) FILTER (WHERE order_total > 0) AS purchases_prior
        FROM silver GROUP BY 1""",
    "scored_visits": """
        SELECT *, cart_adds_30d::DOUBLE / events_30d AS propensity_score,
            CASE WHEN cart_adds_30d::DOUBLE / events_30d <= 0.33::DOUBLE THEN 'LOW'
                WHEN cart_adds_30d::DOUBLE / events_30d <= 0.66::DOUBLE THEN 'MEDIUM'
                ELSE 'HIGH' END AS score_band,
            'rule' AS model_version, TIMESTAMP '2024-01-30' AS scored_at
        FROM visits""",
    "segments": """
        SELECT user_id, sessions_30d, events_30d, cart_adds_30d, purchases_prior,
            propensity_score, score_band,
            CASE WHEN purchases_prior >= 3 THEN 'LOYAL' WHEN purchases_prior > 0 THEN 'CUSTOMER'
                WHEN score_band = 'HIGH' THEN 'HOT_PROSPECT'
                WHEN cart_adds_30d > 0 THEN 'CART_ABANDONER' ELSE 'BROWSER' END AS segment,
            model_version, scored_at
        FROM scored_visits""",
    "revenue": f"""
        SELECT order_date, product_category, orders, units, revenue::DOUBLE AS revenue,
            revenue::DOUBLE / nullif(sum(revenue) OVER day, 0)::DOUBLE AS category_revenue_share,
            {half_up('(sum(revenue) OVER week * 100)', '(count(*) OVER week * 100)', 2)}
                AS revenue_7d_avg
        FROM sales
        WINDOW day AS (PARTITION BY order_date),
            week AS (PARTITION BY product_category ORDER BY order_date
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "line_revenue": f"""
        SELECT order_date, product_category, orders, units, revenue::DOUBLE AS revenue,
            revenue::DOUBLE / nullif(sum(revenue) OVER day, 0)::DOUBLE AS category_revenue_share,
            {half_up('(sum(revenue) OVER week * 100)', '(count(*) OVER week * 100)', 2)}
                AS revenue_7d_avg
        FROM line_sales
        WINDOW day AS (PARTITION BY order_date),
            week AS (PARTITION BY product_category ORDER BY order_date
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "conversion": f"""
        SELECT *,
            {half_up('product_views', 'page_views', 4)} AS view_rate,
            {half_up('add_to_carts', 'product_views', 4)} AS cart_rate,
            {half_up('checkouts', 'add_to_carts', 4)} AS checkout_rate,
            {half_up('purchases', 'checkouts', 4)} AS purchase_rate,
            {half_up('purchases', 'page_views', 4)} AS end_to_end_conversion
        FROM funnel""",
    "corpus": f"""
        SELECT d.doc_id AS seq, {PICK_CATEGORY.format(n='d.doc_id')} AS product_category,
            CASE WHEN quality IS NULL THEN 0 WHEN quality = 1 AND toxic = 1 THEN 3
                WHEN quality = 1 THEN 4 + d.doc_id % 2 WHEN toxic = 1 THEN 1 ELSE 2
                END::INTEGER AS star_rating,
            text AS review_title,
            trim(regexp_replace(text, '\\s+', ' ', 'g')) AS review_text,
            epoch_ms(1704067200000 + d.doc_id * 3600000)::DATE AS review_date
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "reviews": """
        SELECT product_category || '-' || seq AS review_id, * EXCLUDE (seq)
        FROM corpus WHERE star_rating BETWEEN 1 AND 5 AND review_text <> ''""",
    "counted": f"""
        SELECT *, {hits(PROSE_POSITIVE)} AS p, {hits(PROSE_NEGATIVE)} AS n FROM reviews""",
    "sentiment": f"""
        SELECT review_id, product_category, star_rating, review_text,
            CASE WHEN p >= n THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment_label,
            coalesce({half_up('(p - n)', '(p + n)', 4)}, 0) AS sentiment_score, review_date
        FROM counted""",
    "category_totals": """
        SELECT product_category, count(*) AS reviews, sum(star_rating)::BIGINT AS stars,
            sum(sentiment_score::DECIMAL(10,4)) AS score,
            count(*) FILTER (WHERE sentiment_label = 'POSITIVE') AS positive
        FROM sentiment GROUP BY 1""",
    "category_sentiment": f"""
        SELECT t.product_category, reviews, {half_up('stars', 'reviews', 2)} AS avg_stars,
            {half_up('(score * 10000)', '(reviews * 10000)', 3)} AS avg_sentiment,
            {half_up('positive', 'reviews', 3)} AS pct_positive,
            r.total_revenue::DOUBLE AS total_revenue,
            CASE WHEN 2 * score >= reviews THEN 'HEALTHY' WHEN score >= 0 THEN 'WATCH'
                ELSE 'AT RISK' END AS sentiment_status
        FROM category_totals t LEFT JOIN (
            SELECT product_category, sum(revenue) AS total_revenue FROM sales GROUP BY 1) r
            ON t.product_category = r.product_category""",
    "odd_payloads": """
        SELECT * REPLACE (
            CASE WHEN number % 40 <> 1 THEN event_id END AS event_id,
            CASE WHEN number % 40 <> 2 THEN user_id END AS user_id,
            CASE WHEN number % 40 = 3 THEN '' ELSE session_id END AS session_id,
            CASE WHEN number % 40 <> 4 THEN event_ts END AS event_ts,
            CASE WHEN number % 40 <> 4 THEN event_date END AS event_date,
            CASE WHEN order_id IS NOT NULL AND number % 7 = 3
                THEN 'pair-' || number // 14 ELSE order_id END AS order_id,
            CASE WHEN order_id IS NOT NULL AND number % 11 = 2
                THEN 'NaN'::DOUBLE ELSE order_total END AS order_total)
        FROM payloads WHERE number % 40 NOT IN (5, 6)""",
    "odd_silver": """
        SELECT CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'clickstream' END AS topic,
            (user_number % 4)::INTEGER AS "partition", number AS "offset",
            ts AS kafka_ts, p.* EXCLUDE (number, user_number, ts)
        FROM odd_payloads p
        WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_ts IS NOT NULL
            AND event_type IN ('page_view','product_view','add_to_cart','checkout','purchase')""",
    "odd_revenue": """
        SELECT * REPLACE (
            CASE WHEN product_category = 'books' AND day(order_date) % 3 = 1 THEN 2.0
                ELSE category_revenue_share END AS category_revenue_share,
            CASE WHEN product_category <> 'books' OR day(order_date) % 4 <> 1 THEN revenue END
                AS revenue,
            CASE WHEN product_category <> 'books' OR day(order_date) % 5 <> 1
                THEN product_category END AS product_category)
        FROM revenue""",
    "odd_conversion": """
        SELECT * FROM conversion
        UNION ALL SELECT * FROM conversion WHERE day(event_date) = 1
        UNION ALL SELECT * REPLACE (NULL::DATE AS event_date) FROM conversion
            WHERE day(event_date) = 2""",
    "odd_category_sentiment": """
        SELECT * FROM category_sentiment
        UNION ALL SELECT * FROM category_sentiment WHERE product_category = 'books'
        UNION ALL SELECT * REPLACE (NULL::VARCHAR AS product_category) FROM category_sentiment
            WHERE product_category = 'books'""",
    "odd_segments": """
        SELECT * REPLACE (CASE WHEN events_30d % 7 <> 2 THEN user_id END AS user_id) FROM (
            SELECT * FROM segments UNION ALL SELECT * FROM segments WHERE events_30d % 7 = 1)""",
    "steps": """
        SELECT event_date, s.step_no, s.step, s.events, s.previous
        FROM (SELECT event_date, unnest([
            {step_no: 1, step: 'page_views', events: page_views, previous: NULL::BIGINT},
            {step_no: 2, step: 'product_views', events: product_views, previous: page_views},
            {step_no: 3, step: 'add_to_carts', events: add_to_carts, previous: product_views},
            {step_no: 4, step: 'checkouts', events: checkouts, previous: add_to_carts},
            {step_no: 5, step: 'purchases', events: purchases, previous: checkouts}
            ]) AS s FROM funnel)""",
}


def statement(body: str) -> str:
    """The query with the fragments it names, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in FRAGMENTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(FRAGMENTS[name])

    visit(body)
    parts = [f"{name} AS ({FRAGMENTS[name]})" for name in FRAGMENTS if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _all(fragment: str, extra: str = "") -> str:
    return f"SELECT *{extra} FROM {fragment}"


def _check(name: str, fragment: str, broken: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS failures FROM {fragment} WHERE {broken}"


def _unique(name: str, fragment: str, key: str) -> str:
    grouped = f"SELECT {key} FROM {fragment} GROUP BY {key} HAVING count({key}) > 1"
    return f"SELECT '{name}' AS check_name, count(*) AS failures FROM ({grouped})"


NOT_NULL = [
    _check("fct_daily_revenue.not_null_order_date", "revenue", "order_date IS NULL"),
    _check("fct_daily_revenue.not_null_product_category", "revenue", "product_category IS NULL"),
    _check("fct_daily_revenue.not_null_revenue", "revenue", "revenue IS NULL"),
    _check("fct_funnel_conversion.not_null_event_date", "conversion", "event_date IS NULL"),
    _check(
        "fct_category_sentiment.not_null_product_category",
        "category_sentiment",
        "product_category IS NULL",
    ),
    _check("dim_user_segments.not_null_user_id", "segments", "user_id IS NULL"),
]
UNIQUE = [
    _unique("fct_funnel_conversion.unique_event_date", "conversion", "event_date"),
    _unique("fct_category_sentiment.unique_product_category", "category_sentiment", "product_category"),
    _unique("dim_user_segments.unique_user_id", "segments", "user_id"),
]
ACCEPTED = [
    _check(
        "fct_daily_revenue.accepted_values_product_category",
        "revenue",
        "product_category NOT IN "
        "('electronics','apparel','home_kitchen','beauty','sports','books')",
    ),
    _check(
        "fct_category_sentiment.accepted_values_sentiment_status",
        "category_sentiment",
        "sentiment_status NOT IN ('HEALTHY','WATCH','AT RISK')",
    ),
    _check(
        "dim_user_segments.accepted_values_segment",
        "segments",
        "segment NOT IN ('LOYAL','CUSTOMER','HOT_PROSPECT','CART_ABANDONER','BROWSER')",
    ),
]
RANGES = [
    _check("fct_daily_revenue.accepted_range_revenue", "revenue", "revenue < 0"),
    _check(
        "fct_funnel_conversion.accepted_range_end_to_end_conversion",
        "conversion",
        "end_to_end_conversion NOT BETWEEN 0 AND 1",
    ),
    _check(
        "fct_category_sentiment.accepted_range_pct_positive",
        "category_sentiment",
        "pct_positive NOT BETWEEN 0 AND 1",
    ),
    _check(
        "dim_user_segments.accepted_range_propensity_score",
        "segments",
        "propensity_score NOT BETWEEN 0 AND 1",
    ),
]
UNEVEN_DAYS = (
    "(SELECT order_date, sum(category_revenue_share) AS total FROM {} GROUP BY 1)"
    " WHERE abs(total - 1) > 0.001"
)
SUITE = [
    *NOT_NULL,
    *UNIQUE,
    *ACCEPTED,
    *RANGES,
    "SELECT 'fct_daily_revenue.share_sum' AS check_name, count(*) AS failures FROM "
    + UNEVEN_DAYS.format("revenue"),
]
# The suite over the same marts with the broken rows.
ODD_SUITE = [
    re.sub(r"\bFROM (revenue|conversion|category_sentiment|segments)\b", r"FROM odd_\1", check)
    for check in SUITE
]
PERCENT = half_up("(events * 100)", "previous", 2)
SCORES = """
    SELECT review_id, product_category, star_rating, sentiment_label, sentiment_score,
        review_date FROM sentiment"""

UNNUMBERED = """
        SELECT product_category || '-' || place AS review_id, product_category, star_rating, review_date
        FROM (SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY seq) - 1 AS place
              FROM corpus)
        WHERE {} AND star_rating BETWEEN 1 AND 5 AND review_text <> ''"""

QUERIES = {
    "parse_events": _all("records"),
    "clean_events": _all("silver"),
    "quarantine_counts": """
        SELECT 'unknown_event_type' AS reject_reason, event_type, count(*) AS records
        FROM records WHERE event_type = 'error' GROUP BY ALL""",
    "split_orders": _all("silver_orders"),
    "route_events_to_topics": """
        SELECT CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'clickstream' END AS topic,
            user_id AS key, event_id, event_type, order_id FROM payloads""",
    "daily_sales": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM sales",
    "daily_sales_tpch": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM line_sales",
    "refreshed_days": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM sales",
    "funnel_daily": _all("funnel"),
    "user_behavior": _all("behavior"),
    "user_purchases": _all("purchases"),
    "user_features": _all("features"),
    "user_features_as_of": """
        SELECT b.user_id, count(DISTINCT session_id) AS sessions_30d, count(*) AS events_30d,
            count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds_30d,
            count(*) FILTER (WHERE order_total > 0) AS purchases_prior,
            (count(*) FILTER (WHERE order_total > 0) > 0)::INTEGER AS did_purchase
        FROM silver b
        WHERE event_date >= DATE '2023-12-21' AND event_date < DATE '2024-01-20' GROUP BY 1""",
    "stg_daily_sales": """
        SELECT * REPLACE (revenue::DOUBLE AS revenue),
            order_date + INTERVAL 24 HOUR AS loaded_at FROM sales""",
    "stg_funnel_daily": _all("funnel", ", event_date + INTERVAL 48 HOUR AS loaded_at"),
    "stg_review_sentiment": """
        SELECT * REPLACE (star_rating AS star_rating),
            review_date + INTERVAL 24 HOUR AS loaded_at FROM sentiment""",
    "stg_user_propensity": _all("scored_visits", ", scored_at AS loaded_at"),
    "fct_daily_revenue": _all("revenue"),
    "fct_daily_revenue_tpch": _all("line_revenue"),
    "fct_funnel_conversion": _all("conversion"),
    "fct_category_sentiment": _all("category_sentiment"),
    "dim_user_segments": _all("segments"),
    "load_review_slices": """
        SELECT product_category || '-' || seq AS review_id, product_category, star_rating,
            review_title, review_text, review_date
        FROM corpus WHERE star_rating BETWEEN 1 AND 5 AND review_text <> ''""",
    "load_first_reviews": """
        SELECT product_category || '-' || seq AS review_id, product_category, star_rating,
            review_date
        FROM (SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY seq) AS place
              FROM corpus)
        WHERE place <= 25 AND star_rating BETWEEN 1 AND 5 AND review_text <> ''""",
    "load_unnumbered_reviews": UNNUMBERED.format("true"),
    "load_first_unnumbered_reviews": UNNUMBERED.format("place < 25"),
    "score_sentiment": SCORES,
    "score_sentiment_model": SCORES,
    "score_sentiment_by_length": SCORES,
    "sentiment_agreement": """
        SELECT count(*) AS reviews,
            count(*) FILTER (WHERE (star_rating > 3) = (sentiment_label = 'POSITIVE'))::DOUBLE
                / count(*) AS agreement
        FROM sentiment WHERE star_rating <> 3""",
    "score_bands": "SELECT user_id, propensity_score, score_band FROM scored_visits",
    "stratified_split_counts": """
        SELECT CASE WHEN ('0x' || substr(md5(user_id || '42'), 1, 8))::UBIGINT % 100 < 75
            THEN 'train' ELSE 'validation' END AS side, did_purchase, count(*) AS users
        FROM labelled GROUP BY ALL""",
    "ranking_metrics": """
        SELECT sum(pos + neg)::BIGINT AS users,
            round(sum(pos)::DOUBLE / sum(pos + neg), 9) AS positive_rate,
            round(1 - sum(pos * (fp - neg) + pos * neg / 2.0)::DOUBLE
                / (sum(pos) * sum(neg))::DOUBLE, 9) AS roc_auc,
            round(sum(pos * (tp::DOUBLE / (tp + fp))) / sum(pos)::DOUBLE, 9) AS avg_precision,
            0::BIGINT AS unranked
        FROM (
            SELECT pos, neg,
                sum(pos) OVER (ORDER BY propensity_score DESC) AS tp,
                sum(neg) OVER (ORDER BY propensity_score DESC) AS fp
            FROM (SELECT propensity_score, count(*) FILTER (WHERE purchases_prior > 0) AS pos,
                    count(*) FILTER (WHERE purchases_prior = 0) AS neg
                  FROM scored_visits GROUP BY 1))""",
    "propensity_stump": """
        SELECT * FROM (WITH base AS (
            SELECT user_id, least(sessions_30d, 31) AS f1, least(events_30d, 31) AS f2,
                least(cart_adds_30d, 31) AS f3, (purchases_prior > 0)::INTEGER AS y FROM visits),
        sizes AS (SELECT count(*) AS n, sum(y) AS n1 FROM base),
        weighted AS (
            SELECT b.*, (2 * y - 1)::DOUBLE AS t,
                n::DOUBLE / (2 * CASE WHEN y = 1 THEN n1 ELSE n - n1 END)::DOUBLE AS w
            FROM base b, sizes),
        listed AS (
            SELECT user_id, 1 AS feature, f1 AS v, t, w FROM weighted
            UNION ALL SELECT user_id, 2, f2, t, w FROM weighted
            UNION ALL SELECT user_id, 3, f3, t, w FROM weighted),
        by_value AS (
            SELECT feature, v, sum(w) AS w, sum(w * t) AS s FROM listed GROUP BY ALL),
        cuts AS (
            SELECT feature, v, sum(w) OVER below AS wl, sum(s) OVER below AS sl,
                sum(w) OVER every AS wt, sum(s) OVER every AS st
            FROM by_value
            WINDOW below AS (PARTITION BY feature ORDER BY v), every AS (PARTITION BY feature)),
        best AS (
            SELECT *, sl / wl AS low, (st - sl) / (wt - wl) AS high FROM cuts
            WHERE v < (SELECT max(v) FROM by_value b WHERE b.feature = cuts.feature)
            ORDER BY round(sl * sl / wl + (st - sl) * (st - sl) / (wt - wl), 9) DESC, feature, v
            LIMIT 1)
        SELECT l.user_id,
            round(1 / (1 + exp(-2 * CASE WHEN l.v <= b.v THEN low ELSE high END)), 9)
                AS propensity_score
        FROM listed l JOIN best b ON l.feature = b.feature)""",
    "propensity_scores": """
        SELECT count(*) AS users, count(*) AS distinct_users, count(*) AS in_range,
            count(*) AS in_band, '1' AS model_version FROM labelled""",
    "propensity_metrics": """
        SELECT count(*) AS users, 0::BIGINT AS unranked,
            round(sum(did_purchase)::DOUBLE / count(*), 9) AS positive_rate, 1 AS in_range
        FROM labelled
        WHERE ('0x' || substr(md5(user_id || '42'), 1, 8))::UBIGINT % 100 >= 75""",
    "registry_roundtrip": """
        SELECT version::INTEGER AS version, 2::INTEGER AS trees, 5::INTEGER AS depth,
            least(3, (SELECT count(*) FROM labelled
                WHERE ('0x' || substr(md5(user_id || '42'), 1, 8))::UBIGINT % 100 < 75))::INTEGER
                AS example_rows
        FROM range(1, 3) v(version)""",
    "publish_warehouse": """
        SELECT table_name, n AS staged_rows, n AS stamped, n AS written, n AS published FROM (
            SELECT 'raw_daily_sales' AS table_name, count(*) AS n FROM sales
            UNION ALL SELECT 'raw_funnel_daily', count(*) FROM funnel
            UNION ALL SELECT 'raw_review_sentiment', count(*) FROM sentiment
            UNION ALL SELECT 'raw_user_propensity', count(*) FROM scored_visits)""",
    "publish_all_or_none": """
        SELECT *, true AS first_run FROM (
            SELECT 'raw_daily_sales' AS table_name, count(*) AS rows FROM sales
            UNION ALL SELECT 'raw_funnel_daily', count(*) FROM funnel
            UNION ALL SELECT 'raw_review_sentiment', count(*) FROM sentiment
            UNION ALL SELECT 'raw_user_propensity', count(*) FROM scored_visits)""",
    "schema_differences": """
        SELECT 'nation' AS table_name, 'n_comment' AS column_name, 'missing' AS difference, 'string' AS declared,
            NULL AS found, count(*) AS rows_affected FROM nation
        UNION ALL SELECT 'nation', 'n_nationkey', 'narrowed', 'bigint', 'int', 0
        UNION ALL SELECT 'nation', 'n_regionkey', 'changed', 'string', 'int', 0
        UNION ALL SELECT 'lineitem', unnest(['l_partkey','l_suppkey','l_linenumber','l_extendedprice','l_discount',
                'l_returnflag','l_linestatus']), 'extra', NULL,
            unnest(['bigint','bigint','int','double','double','string','string']),
            unnest([count(l_partkey), count(l_suppkey), count(l_linenumber), count(l_extendedprice), count(l_discount),
                count(l_returnflag), count(l_linestatus)]) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_shipdate', 'widened', 'date', 'timestamp_ntz',
            count(*) FILTER (WHERE l_shipdate::DATE::TIMESTAMP <> l_shipdate) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_tax', 'widened', 'float', 'double',
            count(*) FILTER (WHERE l_tax::FLOAT::DOUBLE <> l_tax) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_weight', 'missing', 'double', NULL, count(*) FROM lineitem
        UNION ALL SELECT 'labels', 'doc_id', 'widened', 'int', 'bigint',
            count(*) FILTER (WHERE doc_id > 2147483647) FROM labels""",
    "repeated_keys": """
        SELECT event_id, count(*) AS copies FROM records GROUP BY 1 HAVING count(*) > 1""",
    "odd_events": _all("odd_silver"),
    "odd_rejects": """
        SELECT CASE WHEN n % 40 IN (1, 5, 6) THEN 'missing_event_id'
                WHEN n % 40 = 4 THEN 'missing_event_ts' WHEN n % 40 = 2 THEN 'missing_user_id'
                ELSE 'unknown_event_type' END AS reject_reason, count(*) AS records
        FROM (SELECT number AS n, event_type FROM payloads)
        WHERE n % 40 IN (1, 2, 4, 5, 6) OR event_type = 'error' GROUP BY 1""",
    "odd_orders": """
        SELECT order_id, event_ts, event_date, user_id, session_id, device, product_id,
            product_category, quantity, unit_price, order_total, currency, payment_method
        FROM odd_silver
        WHERE event_type = 'purchase' AND order_total > 0 AND NOT isnan(order_total)
        QUALIFY row_number() OVER (
            PARTITION BY order_id ORDER BY topic, "partition", "offset") = 1""",
    "odd_reviews": """
        SELECT product_category || '-' || seq AS review_id, star_rating,
            length(review_text)::INTEGER AS chars
        FROM corpus
        WHERE seq % 9 NOT IN (1, 2, 3, 4, 5) AND star_rating BETWEEN 1 AND 5 AND review_text <> ''""",
    "odd_staging": """
        SELECT 'daily_sales' AS model, count(*) AS rows_kept, sum(orders)::BIGINT AS total,
            count(DISTINCT product_category) AS distinct_values
        FROM sales WHERE day(order_date) % 5 <> 2 AND NOT (day(order_date) % 5 = 1 AND revenue > 0)
        UNION ALL SELECT 'funnel_daily', count(*), sum(page_views)::BIGINT,
            count(DISTINCT event_date) FROM funnel WHERE day(event_date) % 5 <> 1
        UNION ALL SELECT 'review_sentiment', count(*), sum(star_rating)::BIGINT,
            count(DISTINCT sentiment_label)
        FROM sentiment WHERE split_part(review_id, '-', 2)::BIGINT % 5 NOT IN (1, 2, 3)
        UNION ALL SELECT 'user_propensity', count(*), sum(events_30d)::BIGINT,
            count(DISTINCT score_band) FROM scored_visits WHERE events_30d % 5 NOT IN (1, 2, 3)""",
    "odd_checks": " UNION ALL ".join(ODD_SUITE),
    "stream_bronze": """
        SELECT topic, "partition", count(*) AS records, count(DISTINCT user_id) AS keys,
            min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS stamped
        FROM records GROUP BY ALL""",
    "lost_ranges": """
        SELECT topic, "partition", "offset" + 1 AS first_lost, next - 1 AS last_lost,
            next - "offset" - 1 AS lost
        FROM (SELECT *, lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS next
              FROM (
                SELECT topic, "partition", "offset" FROM records
                WHERE "offset" % 97 NOT BETWEEN 13 AND 19 AND "offset" >= 300
                UNION ALL SELECT topic, "partition", min("offset") - 1 FROM records GROUP BY ALL
                UNION ALL SELECT topic, "partition", max("offset") + 4 FROM records GROUP BY ALL))
        WHERE next > "offset" + 1""",
    "upsert_events": _all("silver"),
    "upsert_orders": _all("silver_orders"),
    "ingest_files": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM line_sales",
    "load_history": """
        SELECT CASE WHEN order_date < DATE '1997-01-01' THEN 1 ELSE 2 END::INTEGER AS delivery,
            count(*) AS rows_loaded FROM line_sales GROUP BY 1""",
    "load_history_files": """
        SELECT delivery, status, CASE WHEN status = 'loaded' THEN rows ELSE 0 END AS rows_loaded,
            bad_rows, CASE WHEN status = 'failed' THEN 'orders: not a bigint: many' END AS error
        FROM (
            SELECT 'early' AS delivery, 'loaded' AS status, count(*) AS rows, 0::BIGINT AS bad_rows
            FROM line_sales WHERE order_date < DATE '1997-01-01'
            UNION ALL SELECT 'late', 'loaded', count(*), 0 FROM line_sales
            WHERE order_date >= DATE '1997-01-01'
            UNION ALL SELECT 'empty', 'empty', 0, 0
            UNION ALL SELECT 'failed', 'failed', 0, count(*) FROM line_sales
            WHERE order_date < DATE '1997-01-01' AND product_category = 'promo')""",
    "auto_ingest_files": "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM line_sales",
    "export_roundtrip": """
        SELECT sink, rows_read, orders, units, revenue, days, categories FROM (
            SELECT count(*) AS rows_read, sum(orders)::BIGINT AS orders,
                sum(units)::BIGINT AS units, sum(revenue)::DOUBLE AS revenue,
                count(DISTINCT order_date) AS days,
                count(DISTINCT product_category) AS categories FROM line_sales) totals
        JOIN (VALUES ('lake'), ('single_file'), ('partitioned'), ('warehouse'), ('csv')) s(sink)
            ON true""",
    "dq_not_null": " UNION ALL ".join(NOT_NULL),
    "dq_unique": " UNION ALL ".join(UNIQUE),
    "dq_accepted_values": " UNION ALL ".join(
        [
            *ACCEPTED,
            "SELECT 'part_types.accepted_values_product_category' AS check_name, "
            "count(*) FILTER (WHERE product_category NOT IN "
            "('economy','large','medium','promo','small','standard')) AS failures "
            "FROM line_revenue",
            _check(
                "contract_categories",
                "line_revenue",
                "product_category NOT IN "
                "('electronics','apparel','home_kitchen','beauty','sports','books')",
            ),
        ]
    ),
    "dq_accepted_range": "SELECT * FROM conversion WHERE end_to_end_conversion NOT BETWEEN 0 AND 1",
    "dq_share_sum": "SELECT count(DISTINCT order_date) AS days, (SELECT count(*) FROM "
    + UNEVEN_DAYS.format("line_revenue")
    + ") AS failing_days FROM line_revenue",
    "dq_freshness": """
        SELECT table_name, last_loaded_at,
            CASE WHEN age <= INTERVAL 36 HOUR THEN 'pass' WHEN age <= INTERVAL 72 HOUR THEN 'warn'
                ELSE 'error' END AS status
        FROM (
            SELECT *, TIMESTAMP '2024-02-02 00:30:00' - last_loaded_at AS age FROM (
                SELECT 'raw_daily_sales' AS table_name,
                    max(order_date) + INTERVAL 24 HOUR AS last_loaded_at FROM sales
                UNION ALL SELECT 'raw_funnel_daily', max(event_date) + INTERVAL 48 HOUR FROM funnel
                UNION ALL SELECT 'raw_review_sentiment', max(review_date) + INTERVAL 24 HOUR
                    FROM sentiment
                UNION ALL SELECT 'raw_user_propensity', max(scored_at) FROM scored_visits))""",
    "dq_suite": " UNION ALL ".join(SUITE),
    "bi_revenue_trend": """
        SELECT order_date, product_category, revenue, revenue_7d_avg FROM line_revenue
        WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
            AND product_category IN ('economy','promo','standard')""",
    "bi_funnel_steps": f"""
        SELECT event_date, step_no, step, events, {PERCENT} AS pct_of_previous FROM steps""",
    "bi_funnel_order": """
        SELECT step, row_number() OVER (ORDER BY events DESC, step_no) - 1 AS place FROM (
            SELECT step_no, step, sum(events)::BIGINT AS events FROM steps GROUP BY ALL)""",
    "bi_funnel_total": f"""
        SELECT step_no, step, events, {PERCENT} AS pct_of_previous FROM (
            SELECT step_no, step, sum(events)::BIGINT AS events,
                sum(previous)::BIGINT AS previous FROM steps GROUP BY ALL)""",
    "bi_sentiment_quadrant": """
        SELECT *,
            CASE WHEN total_revenue >= (SELECT avg(total_revenue) FROM category_sentiment)
                THEN 'high' ELSE 'low' END || ' revenue, ' ||
            CASE WHEN avg_sentiment >= (SELECT avg(avg_sentiment) FROM category_sentiment)
                THEN 'high' ELSE 'low' END || ' sentiment' AS quadrant
        FROM category_sentiment""",
    "bi_segments": """
        SELECT segment, score_band, count(*) AS users,
            round(avg(propensity_score), 4) AS avg_propensity
        FROM segments GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in QUERIES.items()}
