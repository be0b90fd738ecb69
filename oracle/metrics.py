"""One DuckDB statement per metric Q01-Q34."""

from __future__ import annotations

from oracle.base import CATALOG, INTENTS, INVOICES, LINES, REFUNDS, STAR, SUBSCRIPTIONS, statement
from oracle.timeline import (
    Flavour,
    arrivals,
    churn,
    coded,
    delinquent,
    lost,
    move,
    neighbours,
    timeline,
)

REVENUE = """
unrefunded AS (
  SELECT i.*, l.span, l.line_start, l.line_end, p.product_name, r.cents
  FROM invoices i JOIN own_lines l USING (invoice_id)
  JOIN products p USING (product) JOIN prices r USING (product)
  WHERE i.charge NOT IN (SELECT refunded FROM refunds)
),
yearly_revenue AS (
  SELECT invoice_id AS id, customer, email AS customer_email, sub_id AS subscription, paid, status,
         product_name AS name,
         (cents::DOUBLE / 100) / 12 AS unit_amount, (untaxed::DOUBLE / 100) / 12 AS amount,
         make_timestamp(from_s * 1000000) AS usage_start,
         make_timestamp(to_s * 1000000) AS usage_end,
         unnest(generate_series(CAST(line_start AS DATE),
                                CAST(line_start AS DATE) + INTERVAL 11 MONTH,
                                INTERVAL 1 MONTH)) AS subscription_start,
         line_end AS subscription_end
  FROM unrefunded WHERE span = 'year'
),
other_revenue AS (
  SELECT invoice_id AS id, customer, email AS customer_email, sub_id AS subscription, paid, status,
         product_name AS name,
         (cents // 100)::DOUBLE AS unit_amount, (untaxed // 100)::DOUBLE AS amount,
         make_timestamp(from_s * 1000000) AS usage_start,
         make_timestamp(to_s * 1000000) AS usage_end,
         line_start AS subscription_start, line_end AS subscription_end
  FROM unrefunded WHERE span <> 'year'
),
revenue AS (SELECT * FROM yearly_revenue UNION SELECT * FROM other_revenue)"""

ARPU_MONTHS = """
SELECT rpad(monthname(subscription_start), 9, ' ') AS month_name,
       CAST(year(subscription_start) AS INTEGER) AS year,
       sum(amount) AS total_revenue, count(DISTINCT customer) AS total_customers
FROM revenue GROUP BY ALL"""


def arpu_monthly() -> str:
    return statement(
        [*STAR, REFUNDS, REVENUE, f"months AS ({ARPU_MONTHS})"],
        "SELECT month_name, year, round(total_revenue / total_customers, 6) AS arpu_monthly "
        "FROM months",
    )


def revenue_monthly() -> str:
    return statement([*STAR, REFUNDS, REVENUE], "SELECT * FROM revenue")


HISTORY = """
history AS (
  SELECT i.customer, i.sub_id, i.invoice_id, l.line_key, l.line_start, r.cents
  FROM invoices i JOIN own_lines l USING (invoice_id)
  JOIN products USING (product) JOIN prices r USING (product)
  LEFT JOIN (SELECT latest_invoice FROM subs
             WHERE status IN ('active', 'past_due', 'incomplete') AND from_s <> to_s) s
    ON s.latest_invoice = i.invoice_id
  WHERE i.paid
),
changes AS (
  SELECT *, lead(cents) OVER w AS next_cents, lead(line_start) OVER w AS next_start,
         lag(sub_id) OVER w AS previous_sub
  FROM history
  WINDOW w AS (PARTITION BY customer ORDER BY line_start, invoice_id, line_key, cents)
)"""

ENDED = """
ended AS (
  SELECT i.invoice_id, i.customer, s.sub_id, i.status AS invoice_status,
         s.status AS subscription_status, product_name, s.reason, l.line_start, l.line_end,
         i.billing_reason, s.cancel_at_period_end, i.attempt_count, i.paid AS invoice_paid
  FROM subs s JOIN invoices i ON i.invoice_id = s.latest_invoice
  LEFT JOIN lines l ON l.invoice_id = i.invoice_id
  LEFT JOIN products p ON p.product = l.product
  WHERE s.status NOT IN ('incomplete_expired', 'active', 'past_due', 'incomplete')
),
churned AS (
  SELECT * FROM ended
  WHERE reason IN ('cancellation_requested', 'payment_failed')
    AND customer NOT IN (SELECT customer FROM subs
                         WHERE status IN ('active', 'past_due', 'incomplete'))
)"""

ANALYTICS_MONTHS = """
months AS (
  SELECT year, month, new_customer,
         CAST(sum(new_customer) OVER (ORDER BY year, month) AS BIGINT) AS so_far
  FROM (SELECT CAST(year(line_start) AS INTEGER) AS year, CAST(month(line_start) AS INTEGER) AS month,
               count(*) FILTER (previous_sub IS NULL) AS new_customer
        FROM changes GROUP BY ALL)
),
moves AS (
  SELECT CAST(year(next_start) AS INTEGER) AS year, CAST(month(next_start) AS INTEGER) AS month,
         count(*) FILTER (next_cents > cents) AS upgrades,
         count(*) FILTER (next_cents < cents) AS downgrades
  FROM changes WHERE next_start IS NOT NULL GROUP BY ALL
),
losses AS (
  SELECT CAST(year(line_start) AS INTEGER) AS year, CAST(month(line_start) AS INTEGER) AS month,
         count(*) FILTER (reason = 'cancellation_requested') AS voluntary,
         count(*) FILTER (reason = 'payment_failed') AS involuntary
  FROM churned GROUP BY ALL
)"""


def customer_analytics() -> str:
    return statement(
        [*STAR, HISTORY, ENDED, ANALYTICS_MONTHS],
        """
SELECT n.year, n.month, n.new_customer, upgrades, downgrades,
       so_far - coalesce(voluntary, 0) - coalesce(involuntary, 0) AS existing_customers,
       coalesce(voluntary, 0) AS voluntary_churned_customer,
       coalesce(involuntary, 0) AS involuntary_churned_customer
FROM months n
LEFT JOIN moves m ON m.year = n.year AND m.month = n.month
LEFT JOIN losses l ON l.year = n.year AND l.month = n.month""",
    )


LATEST = """
latest AS (
  SELECT row_number() OVER (
           PARTITION BY customer
           ORDER BY CAST(make_timestamp(from_s * 1000000) AS DATE) DESC NULLS FIRST,
                    invoice_id, line_key, product_name, pi_status) AS latest_entry,
         customer, total, status AS i_status, pi_status, billing_reason, product_name AS name,
         CAST(make_timestamp(from_s * 1000000) AS DATE) AS usage_start,
         CAST(make_timestamp(to_s * 1000000) AS DATE) AS usage_end,
         invoice_id, payment_intent
  FROM invoices JOIN own_lines USING (invoice_id) JOIN products USING (product)
  JOIN intents USING (invoice_id)
)"""


def pending_payments() -> str:
    return statement(
        [INVOICES, LINES, CATALOG, INTENTS, LATEST],
        """
SELECT * FROM latest
WHERE latest_entry = 1 AND i_status <> 'paid' AND pi_status <> 'succeeded'
  AND billing_reason <> 'subscription_create'""",
    )


def cancelled_subscriptions() -> str:
    return statement(
        [SUBSCRIPTIONS],
        """
SELECT sub_id AS id, status, reason, customer, latest_invoice,
       CAST(make_timestamp((cancel_s + 259200) * 1000000) AS DATE) AS cancel_at,
       CAST(make_timestamp(cancel_s * 1000000) AS DATE) AS cancelled_at
FROM subs WHERE reason IS NOT NULL AND cancel_s IS NOT NULL""",
    )


FIRST_INVOICES = """
first_invoices AS (
  SELECT customer, invoice_id, line_key, subtotal, product_name,
         CAST(line_start AS DATE) AS subscription_start, CAST(line_end AS DATE) AS subscription_end,
         CAST(year(line_start) AS INTEGER) AS year, CAST(month(line_start) AS INTEGER) AS month
  FROM invoices JOIN own_lines USING (invoice_id) JOIN products USING (product)
  WHERE status = 'paid' AND subtotal > 0
  QUALIFY row_number() OVER (
    PARTITION BY customer ORDER BY CAST(line_start AS DATE), invoice_id, line_key) = 1
)"""


def new_customer_count() -> str:
    return statement(
        [INVOICES, LINES, CATALOG, FIRST_INVOICES],
        "SELECT month, year, count(customer) AS new_customer_count "
        "FROM first_invoices GROUP BY ALL",
    )


def movement(f: Flavour, name: str) -> str:
    alias = '"sum"' if f.net else '"count"'
    return statement([*STAR, *timeline(f), neighbours(f)], move(f, name, alias))


def voluntary_churn(f: Flavour, alias: str, ended_only: bool = True) -> str:
    return statement(
        [*STAR, *timeline(f), neighbours(f), coded(f, ended_only)], churn(f, alias)
    )


def first_mrr(f: Flavour) -> str:
    return statement([*STAR, *timeline(f)], arrivals(f, "new_customer_mrr"))


def delinquency(f: Flavour, alias: str) -> str:
    return statement([*STAR, delinquent(f)], lost(f, alias))


def _movement_ctes(f: Flavour) -> list[str]:
    parts = {
        "arrived": arrivals(f, "n"),
        "churned": churn(f, "n"),
        "failing": lost(f, "n"),
        "upgraded": move(f, "upgrade", "n"),
        "downgraded": move(f, "downgrade", "n"),
        "reactivated": move(f, "reactivation", "n"),
    }
    tables = [f"{name} AS ({sql})" for name, sql in parts.items()]
    return [*STAR, *timeline(f), neighbours(f), coded(f), delinquent(f), *tables]


_JOINED = """
FROM arrived a
LEFT JOIN churned c ON (c.start_year, c.start_month) = (a.year, a.month)
LEFT JOIN upgraded u ON (u.start_year, u.start_month) = (a.year, a.month)
LEFT JOIN downgraded d ON (d.start_year, d.start_month) = (a.year, a.month)
LEFT JOIN reactivated r ON (r.start_year, r.start_month) = (a.year, a.month)
LEFT JOIN failing f ON (f.year, f.month) = (a.year, a.month)"""


def existing_customers(f: Flavour) -> str:
    return statement(
        _movement_ctes(f),
        f"""
SELECT a.month, a.year, a.n AS new_customers, coalesce(c.n, 0) AS voluntary_churn,
       coalesce(u.n, 0) AS upgrades, coalesce(d.n, 0) AS downgrades,
       coalesce(r.n, 0) AS reactivations, coalesce(f.n, 0) AS delinquent_churn,
       CAST(sum(a.n - coalesce(c.n, 0) + coalesce(r.n, 0) - coalesce(f.n, 0))
            OVER (ORDER BY a.year, a.month) AS BIGINT) AS existing_customers
{_JOINED}""",
    )


def existing_mrr(f: Flavour) -> str:
    return statement(
        _movement_ctes(f),
        f"""
SELECT a.year, a.month, a.n AS new_customer_mrr, coalesce(c.n, 0) AS voluntary_churn_mrr,
       coalesce(u.n, 0) AS upgrade_mrr, coalesce(d.n, 0) AS downgrade_mrr,
       coalesce(r.n, 0) AS reactivated_mrr, coalesce(f.n, 0) AS delinquent_mrr,
       sum(a.n + coalesce(c.n, 0) + coalesce(u.n, 0) + coalesce(d.n, 0) + coalesce(r.n, 0)
           + coalesce(f.n, 0)) OVER (ORDER BY a.year, a.month) AS existing_mrr
{_JOINED}""",
    )


def metric_statements() -> dict[str, str]:
    """Q01-Q34 by id."""
    sql = {
        "Q01": arpu_monthly(),
        "Q02": revenue_monthly(),
        "Q03": voluntary_churn(
            Flavour(cancel=True, outer=True), "voluntary_churn", ended_only=False
        ),
        "Q04": customer_analytics(),
        "Q05": pending_payments(),
        "Q06": cancelled_subscriptions(),
    }
    for json, first in ((False, 7), (True, 21)):
        full = {"json": json, "cancel": True}
        count, money = Flavour(json=json), Flavour(json=json, net=True)
        sheet = [
            new_customer_count(),
            movement(count, "upgrade"),
            movement(count, "downgrade"),
            movement(count, "reactivation"),
            voluntary_churn(Flavour(**full, drop_failed=True), "voluntary_churn"),
            delinquency(count, '"count"'),
            existing_customers(Flavour(**full, reason=True)),
            first_mrr(money),
            movement(money, "upgrade"),
            movement(money, "downgrade"),
            movement(money, "reactivation"),
            voluntary_churn(Flavour(**full, net=True, drop_failed=True), "voluntary_churn_mrr"),
            delinquency(money, "delinquent_mrr"),
            existing_mrr(Flavour(**full, net=True, reason=True)),
        ]
        sql |= {f"Q{first + i:02d}": text for i, text in enumerate(sheet)}
    return sql
