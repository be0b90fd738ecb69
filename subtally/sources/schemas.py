"""Declared schemas (DDL text) of the billing tables in both layouts."""

from __future__ import annotations

from typing import Literal

Layout = Literal["normalized", "json"]

LINE_HASH = "_airbyte_invoice_line_items_hashid"
SUBSCRIPTION_HASH = "_airbyte_subscriptions_hashid"

_SHARED = {
    "invoices": (
        "id STRING, customer STRING, customer_email STRING, subscription STRING, "
        "status STRING, paid BOOLEAN, charge STRING, billing_reason STRING, "
        "payment_intent STRING, period_start BIGINT, period_end BIGINT, total BIGINT, "
        "subtotal BIGINT, total_excluding_tax BIGINT, attempt_count INT"
    ),
    "products": "id STRING, name STRING",
    "prices": "product STRING, unit_amount BIGINT",
    "payment_intents": "invoice STRING, status STRING",
    "refunds": "charge STRING",
}

_SUBSCRIPTION = (
    "id STRING, customer STRING, status STRING, latest_invoice STRING, "
    "current_period_start BIGINT, current_period_end BIGINT, cancel_at BIGINT, "
    "canceled_at BIGINT, cancel_at_period_end BOOLEAN"
)

_NORMALIZED = {
    "invoice_line_items": (
        f"{LINE_HASH} STRING, id STRING, invoice_id STRING, invoice STRING, "
        "type STRING, amount BIGINT"
    ),
    "invoice_line_items_period": f"{LINE_HASH} STRING, `start` BIGINT, `end` BIGINT",
    "invoice_line_items_price": f"{LINE_HASH} STRING, product STRING",
    "invoice_line_items_plan": f"{LINE_HASH} STRING, `interval` STRING, product STRING",
    "invoice_line_items_discount_amounts": f"{LINE_HASH} STRING, amount BIGINT",
    "subscriptions": f"{_SUBSCRIPTION}, {SUBSCRIPTION_HASH} STRING",
    "subscriptions_plan": (
        f"{SUBSCRIPTION_HASH} STRING, `interval` STRING, nickname STRING, amount BIGINT"
    ),
    "subscriptions_cancellation_details": f"{SUBSCRIPTION_HASH} STRING, reason STRING",
}

_JSON = {
    "invoice_line_items": (
        "id STRING, invoice_id STRING, type STRING, amount BIGINT, period STRING, "
        "price STRING, plan STRING, discount_amounts STRING"
    ),
    "subscriptions": f"{_SUBSCRIPTION}, cancellation_details STRING",
}

SCHEMAS: dict[str, dict[str, str]] = {
    "normalized": {**_SHARED, **_NORMALIZED},
    "json": {**_SHARED, **_JSON},
}

# The key each table is bucketed by when stored, None for the others. A bucket is one task, and a
# scan of buckets has no exchange that adaptive execution could split. So only keys whose
# rows are few on both sides of their joins count: a line and its parts, a subscription and
# its parts. What joins on invoices, charges or customers is shuffled, or salted.
BUCKET_KEYS: dict[str, dict[str, str | None]] = {
    "normalized": {
        **dict.fromkeys(_SHARED),
        "invoice_line_items": LINE_HASH,
        "invoice_line_items_period": LINE_HASH,
        "invoice_line_items_price": LINE_HASH,
        "invoice_line_items_plan": LINE_HASH,
        "invoice_line_items_discount_amounts": LINE_HASH,
        "subscriptions": SUBSCRIPTION_HASH,
        "subscriptions_plan": SUBSCRIPTION_HASH,
        "subscriptions_cancellation_details": SUBSCRIPTION_HASH,
    },
    "json": dict.fromkeys({**_SHARED, **_JSON}),
}

# Tables bucketed by a key that may be hot and by a salt, which cuts the rows of hot keys.
SALTED_KEYS: dict[str, dict[str, str]] = {
    "normalized": {},
    "json": {"invoice_line_items": "invoice_id"},
}
SALT = "salt"
# The hot keys of stored lines and into how many parts their rows are cut.
HOT_INVOICES = "hot_invoices"
