import datetime as dt
from decimal import Decimal

import pytest

from tidemart.contracts import RAW_DAILY_SALES, RAW_FUNNEL_DAILY, RAW_REVIEW_SENTIMENT
from tidemart.contracts import RAW_USER_PROPENSITY
from tidemart.plans import dashboards, marts, staging

LOADED = ", loaded_at TIMESTAMP"
NOON = dt.datetime(2026, 9, 1, 12)


def day(number):
    return dt.date(2026, 9, number)


@pytest.fixture
def sales(spark):
    def build(rows):
        padded = [(d, c, 1, 1, None if r is None else Decimal(r), NOON) for d, c, r in rows]
        return spark.createDataFrame(padded, RAW_DAILY_SALES + LOADED)

    return build


def test_stg_daily_sales(sales):
    raw = sales([(day(1), "Books", "1"), (None, "books", "1"), (day(1), "x", "-1"), (day(1), "y", None)])
    assert [r.product_category for r in staging.stg_daily_sales(raw).collect()] == ["books"]


def test_stg_user_propensity(spark):
    rows = [
        (user, 1, 1, 1, 0, score, "high", "1", NOON, NOON)
        for user, score in [("u1", 0.0), ("u2", 1.0), ("u3", 1.1), ("u4", None), (None, 0.5)]
    ]
    kept = staging.stg_user_propensity(spark.createDataFrame(rows, RAW_USER_PROPENSITY + LOADED))
    assert [(r.user_id, r.score_band) for r in kept.collect()] == [("u1", "HIGH"), ("u2", "HIGH")]


def test_stg_review_sentiment(spark):
    rows = [
        (i, "Books", stars, "t", "positive", 0.5, day(1), NOON)
        for i, stars in [("r1", 1), ("r2", 5), ("r3", 0), ("r4", None), (None, 3)]
    ]
    kept = staging.stg_review_sentiment(spark.createDataFrame(rows, RAW_REVIEW_SENTIMENT + LOADED))
    assert [(r.review_id, r.product_category, r.sentiment_label) for r in kept.collect()] == [
        ("r1", "books", "POSITIVE"),
        ("r2", "books", "POSITIVE"),
    ]


def test_share_is_null_on_a_day_without_revenue(sales):
    mart = marts.fct_daily_revenue(sales([(day(1), "a", "0"), (day(1), "b", "0"), (day(2), "a", "5")]))
    shares = {(r.order_date.day, r.product_category): r.category_revenue_share for r in mart.collect()}
    assert shares == {(1, "a"): None, (1, "b"): None, (2, "a"): 1.0}


def test_average_counts_rows_not_days(sales):
    days = [1, 2, 3, 5, 8, 13, 21, 29]
    mart = marts.fct_daily_revenue(sales([(day(d), "a", str(d)) for d in days]))
    averages = [float(r.revenue_7d_avg) for r in mart.orderBy("order_date").collect()]
    expected = []
    for i in range(len(days)):
        window = days[max(0, i - 6) : i + 1]
        expected.append(round(sum(window) / len(window) + 1e-9, 2))
    assert averages == expected


def test_funnel_rates_are_null_behind_an_empty_step(spark):
    funnel = spark.createDataFrame([(day(1), 0, 3, 2, 0, 1, NOON)], RAW_FUNNEL_DAILY + LOADED)
    row = marts.fct_funnel_conversion(staging.stg_funnel_daily(funnel)).first()
    assert (row.view_rate, row.cart_rate, row.checkout_rate) == (None, 0.6667, 0.0)
    assert (row.purchase_rate, row.end_to_end_conversion) == (None, None)
    assert "loaded_at" not in row.__fields__


def test_category_sentiment_keeps_reviewed_categories_only(spark, sales):
    rows = [
        (f"r{i}", category, 4, "t", "POSITIVE" if score >= 0 else "NEGATIVE", score, day(1), NOON)
        for i, (category, score) in enumerate(
            [("a", 0.5), ("b", 0.4999), ("c", -0.0001), ("c", -0.1), ("d", 0.0)]
        )
    ]
    reviews = spark.createDataFrame(rows, RAW_REVIEW_SENTIMENT + LOADED)
    mart = marts.fct_category_sentiment(reviews, sales([(day(1), "a", "7"), (day(1), "z", "9")]))
    result = {r.product_category: r for r in mart.collect()}
    assert {c: r.sentiment_status for c, r in result.items()} == {
        "a": "HEALTHY",
        "b": "WATCH",
        "c": "AT RISK",
        "d": "WATCH",
    }
    assert {c: r.total_revenue for c, r in result.items()} == {
        "a": Decimal("7.00"),
        "b": None,
        "c": None,
        "d": None,
    }
    assert result["b"].avg_sentiment == 0.5 and result["c"].pct_positive == 0.0


def test_segments_take_the_first_rule(spark):
    cases = [
        ("u1", 5, 3, "HIGH", "LOYAL"),
        ("u2", 5, 1, "HIGH", "CUSTOMER"),
        ("u3", 5, 0, "HIGH", "HOT_PROSPECT"),
        ("u4", 5, 0, "LOW", "CART_ABANDONER"),
        ("u5", 0, 0, "LOW", "BROWSER"),
        ("u6", 0, 0, None, "BROWSER"),
    ]
    rows = [(u, 1, 9, carts, bought, 0.5, band, "1", NOON) for u, carts, bought, band, _ in cases]
    segments = marts.dim_user_segments(spark.createDataFrame(rows, RAW_USER_PROPENSITY))
    assert [r.segment for r in segments.orderBy("user_id").collect()] == [c[-1] for c in cases]


def test_revenue_trend_filters(sales):
    mart = marts.fct_daily_revenue(sales([(day(d), c, "2") for d in (1, 2, 3) for c in "ab"]))
    shown = dashboards.revenue_trend(mart, first=day(2), last=day(2), categories=["a"]).collect()
    assert [(r.order_date, r.product_category) for r in shown] == [(day(2), "a")]


def test_funnel_steps_compare_with_the_step_before(spark):
    rows = [(day(1), 8, 4, 0, 1, 1), (day(2), 2, 2, 2, 2, 2)]
    funnel = spark.createDataFrame(rows, RAW_FUNNEL_DAILY)
    total = dashboards.funnel_steps(funnel, by=()).collect()
    assert [(r.step, r.events) for r in total] == [
        ("page_views", 10),
        ("product_views", 6),
        ("checkouts", 3),
        ("purchases", 3),
        ("add_to_carts", 2),
    ]
    by_day = {(r.event_date.day, r.step): r.pct_of_previous for r in dashboards.funnel_steps(funnel).collect()}
    assert by_day[1, "page_views"] is None and by_day[1, "product_views"] == 50.0
    assert by_day[1, "add_to_carts"] == 0.0 and by_day[1, "checkouts"] is None


def test_quadrants(spark):
    rows = [("a", Decimal(10), 0.9), ("b", Decimal(2), 0.8), ("c", Decimal(12), -0.5), ("d", None, 0.0)]
    mart = spark.createDataFrame(
        rows, "product_category STRING, total_revenue DECIMAL(18,2), avg_sentiment DOUBLE"
    )
    placed = {r.product_category: r.quadrant for r in dashboards.sentiment_quadrant(mart).collect()}
    assert placed == {
        "a": "high revenue, high sentiment",
        "b": "low revenue, high sentiment",
        "c": "high revenue, low sentiment",
        "d": "low revenue, low sentiment",
    }


def test_segment_sizes(spark):
    rows = [("LOYAL", "HIGH", 0.9), ("LOYAL", "HIGH", 0.7), ("BROWSER", "LOW", 0.1)]
    df = spark.createDataFrame(rows, "segment STRING, score_band STRING, propensity_score DOUBLE")
    sizes = {(r.segment, r.score_band): (r.users, float(r.avg_propensity)) for r in dashboards.segment_sizes(df).collect()}
    assert sizes == {("LOYAL", "HIGH"): (2, 0.8), ("BROWSER", "LOW"): (1, 0.1)}
