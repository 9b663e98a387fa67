"""Sample rows the library tests share."""

import datetime as dt

SF_TINY = "/root/testdata/sf0.001"
ARRIVED = dt.datetime(2025, 3, 14, 8, 30, 7)


def event(event_id="view-17", event_type="page_view", user_id="ada", order=None, **changes):
    payload = {
        "event_id": event_id,
        "event_type": event_type,
        "event_ts": "2025-03-14T08:30:00+00:00",
        "user_id": user_id,
        "session_id": "ada-morning",
        "device": "tablet",
        "product_id": "BOOK-0420",
        "product_category": "books",
        "order": order,
    }
    return payload | changes


def order(order_id="basket-5", order_total=37.5, **changes):
    filled = {
        "order_id": order_id,
        "quantity": 3,
        "unit_price": 12.5,
        "order_total": order_total,
        "currency": "EUR",
        "payment_method": "paypal",
    }
    return filled | changes
