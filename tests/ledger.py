"""Hand-made billing tables in both layouts, from plain Python rows."""

import datetime as dt
import json

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from subtally.sources.schemas import SCHEMAS
from subtally.sources.tables import BillingTables


def epoch(day, hour=0):
    """Seconds of a UTC day given as text; None stays None."""
    if day is None:
        return None
    moment = dt.datetime.fromisoformat(day).replace(hour=hour, tzinfo=dt.timezone.utc)
    return int(moment.timestamp())


def invoice(id, customer="c1", **over):
    row = dict(
        id=id, customer=customer, customer_email=f"{customer}@example.com",
        subscription=f"s_{customer}", status="paid", paid=True, charge=f"ch_{id}",
        billing_reason="subscription_cycle", payment_intent=f"pi_{id}",
        period_start=epoch("2023-01-01"), period_end=epoch("2023-02-01"),
        total=1200, subtotal=1200, total_excluding_tax=1200, attempt_count=1,
    )
    return {**row, **over}


def line(invoice_id, start, end, product="p1", interval="month", n=1, **over):
    row = dict(
        id=f"il_{invoice_id}_{n}", invoice_id=invoice_id, type="subscription", amount=1000,
        start=epoch(start), end=epoch(end), product=product, interval=interval, discounts=[],
    )
    return {**row, **over}


def subscription(customer="c1", **over):
    row = dict(
        id=f"s_{customer}", customer=customer, status="active", latest_invoice=None,
        current_period_start=epoch("2023-01-01"), current_period_end=epoch("2023-02-01"),
        cancel_at=None, canceled_at=None, cancel_at_period_end=False, reason=None,
    )
    return {**row, **over}


def _table(rows, ddl):
    """Rows as an in-memory relation; the Arrow path needs no Python worker."""
    schema = StructType.fromDDL(ddl)
    picked = [{name: row[name] for name in schema.names} for row in rows]
    table = pa.Table.from_pylist(picked, schema=to_arrow_schema(schema))
    return SparkSession.active().createDataFrame(table, schema)


def ledger(spark, layout, invoices, lines, subscriptions=(), prices=None, refunds=(), intents=None):
    """BillingTables of one layout; `prices` is product -> list of cents."""
    prices = prices or {"p1": [1000]}
    rows = {
        "invoices": invoices,
        "products": [dict(id=p, name=f"plan {p}") for p in prices],
        "prices": [dict(product=p, unit_amount=c) for p, cs in prices.items() for c in cs],
        "payment_intents": [
            dict(invoice=i["id"], status=(intents or {}).get(i["id"], "succeeded")) for i in invoices
        ],
        "refunds": [dict(charge=c) for c in refunds],
    }
    hashed = [{**r, "_airbyte_invoice_line_items_hashid": f"h_{r['id']}"} for r in lines]
    subs = [{**s, "_airbyte_subscriptions_hashid": f"h_{s['id']}"} for s in subscriptions]
    if layout == "normalized":
        rows |= {
            "invoice_line_items": [{**r, "invoice": r["invoice_id"]} for r in hashed],
            "invoice_line_items_period": hashed,
            "invoice_line_items_price": hashed,
            "invoice_line_items_plan": [r for r in hashed if r["interval"]],
            "invoice_line_items_discount_amounts": [
                {**r, "amount": d} for r in hashed for d in r["discounts"]
            ],
            "subscriptions": subs,
            "subscriptions_plan": [
                {**s, "interval": "month", "nickname": "plan", "amount": 1000} for s in subs
            ],
            "subscriptions_cancellation_details": [s for s in subs if s["reason"]],
        }
    else:
        rows |= {
            "invoice_line_items": [
                {
                    **r,
                    "period": json.dumps({"start": r["start"], "end": r["end"]}),
                    "price": json.dumps({"product": r["product"]}),
                    "plan": json.dumps({"interval": r["interval"]}),
                    "discount_amounts": json.dumps([{"amount": d} for d in r["discounts"]]),
                }
                for r in lines
            ],
            "subscriptions": [
                {**s, "cancellation_details": json.dumps({"reason": s["reason"]})} for s in subs
            ],
        }
    frames = {name: _table(rows[name], ddl) for name, ddl in SCHEMAS[layout].items()}
    return BillingTables(layout, frames)


def rows(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
