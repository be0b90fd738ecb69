"""One DuckDB statement per pipeline step."""

from __future__ import annotations

from oracle.base import CATALOG, INTENTS, INVOICES, LINES, REFUNDS, STAR, SUBSCRIPTIONS, statement
from oracle.metrics import (
    ANALYTICS_MONTHS,
    ARPU_MONTHS,
    ENDED,
    FIRST_INVOICES,
    HISTORY,
    LATEST,
    REVENUE,
    _movement_ctes,
    existing_customers,
    existing_mrr,
    metric_statements,
)
from oracle.timeline import (
    MOVES,
    Flavour,
    arrivals,
    candidates,
    churn,
    coded,
    delinquent,
    kept,
    lost,
    move,
    neighbours,
    timeline,
)

FULL = Flavour(cancel=True, reason=True)
FULL_NET = Flavour(cancel=True, reason=True, net=True)
OUTER = Flavour(cancel=True, outer=True)


def _kept(f: Flavour) -> str:
    extras = {"canceled": "canceled AS canceled_date", "reason": "reason", "total": "total"}
    tail = "".join(
        f", {extras[name]}" for name in extras if f", {name}" in f.extras(*extras)
    )
    return statement(
        [*STAR, candidates(f), kept(f)],
        f"""
SELECT invoice_id, customer, email AS customer_email, status,
       CAST(year(line_start) AS INTEGER) AS year, CAST(month(line_start) AS INTEGER) AS month,
       line_start AS kept_start, line_end AS kept_end{tail}
FROM kept""",
    )


def _period_columns(f: Flavour) -> str:
    return (
        "customer, email AS customer_email, status, product_name, unit AS unit_amount, "
        + "canceled AS canceled_date, " * f.cancel
        + "reason, " * f.reason
        + "total, " * f.net
        + "starts AS subscription_start, ends AS subscription_end"
    )


def _periods(f: Flavour, table: str) -> str:
    return statement([*STAR, *timeline(f)], f"SELECT {_period_columns(f)} FROM {table}")


_MONTH_KEYS = """CAST(year(starts) AS INTEGER) AS start_year,
       CAST(month(starts) AS INTEGER) AS start_month,
       CAST(year(ends) AS INTEGER) AS end_year, CAST(month(ends) AS INTEGER) AS end_month"""


def _neighbour_columns(f: Flavour) -> str:
    return (
        "customer, unit AS unit_amount, ends AS subscription_end, start_year, start_month, "
        "end_year, end_month, unit_before AS previous_subtotal, unit_after AS next_subtotal"
        + ", reason" * f.reason
        + ", total, total_before AS previous_total, total_after AS next_total" * f.net
    )


def _flagged(name: str) -> str:
    condition, _ = MOVES[name]
    return statement(
        [*STAR, *timeline(FULL_NET), neighbours(FULL_NET)],
        f"""
SELECT {_neighbour_columns(FULL_NET)}, CASE WHEN {condition} THEN 1 ELSE 0 END AS {name},
       total - total_before AS change
FROM neighbours""",
    )


def _moved(name: str) -> str:
    return statement([*STAR, *timeline(FULL), neighbours(FULL)], move(FULL, name, "customers"))


def _coded(f: Flavour, ended_only: bool = True, where: str = "TRUE", keep_failed: bool = True) -> str:
    codes = coded(f, ended_only)
    if keep_failed:
        codes = codes.replace("WHERE reason <> 'payment_failed'", "")
    return statement(
        [*STAR, *timeline(f), neighbours(f), codes],
        f"SELECT {_neighbour_columns(f)}, code AS churn FROM coded WHERE {where}",
    )


def _codes(code: int, side: str) -> str:
    return statement(
        [*STAR, *timeline(FULL), neighbours(FULL), coded(FULL)],
        f"""
SELECT {side}_month AS month, {side}_year AS year, count(customer) AS voluntary_churn
FROM coded WHERE code = {code} GROUP BY ALL""",
    )


_NUMBER = "CAST(replace(sub_id, 'sub_', '') AS BIGINT) % 20"
_SUBSCRIPTION = [
    *"sub_id, customer, status, latest_invoice, from_s, to_s".split(", "),
    *"cancel_s + 259200, cancel_s, cancel_at_period_end".split(", "),
]

# Source and columns of every table, in the order of its schema.
_SHARED_TABLES = {
    "invoices": (
        "invoices",
        "invoice_id, customer, email, sub_id, status, paid, charge, billing_reason, payment_intent, "
        "from_s, to_s, total, subtotal, untaxed, attempt_count".split(", "),
    ),
    "products": ("products", ["product", "product_name"]),
    "prices": ("prices", ["product", "cents"]),
    "payment_intents": ("intents", ["invoice_id", "pi_status"]),
    "refunds": ("refunds", ["refunded"]),
}
_NORMALIZED_TABLES = {
    "invoice_line_items": (
        "own_lines", ["line_key", "line_key", "invoice_id", "invoice_id", "type", "amount"]
    ),
    "invoice_line_items_period": ("own_lines", ["line_key", "start_s", "end_s"]),
    "invoice_line_items_price": ("lines", ["line_key", "product"]),
    "invoice_line_items_plan": ("own_lines", ["line_key", "span", "product"]),
    "invoice_line_items_discount_amounts": (
        "(SELECT line_key, unnest(discounts) AS off FROM own_lines)", ["line_key", "off"]
    ),
    "subscriptions": ("subs", [*_SUBSCRIPTION, "sub_id"]),
    "subscriptions_plan": ("subs", ["sub_id", "'month'", f"'plan ' || {_NUMBER}", f"{_NUMBER} * 1000"]),
    "subscriptions_cancellation_details": ("(FROM subs WHERE reason IS NOT NULL)", ["sub_id", "reason"]),
}
_JSON_TABLES = {
    "invoice_line_items": (
        "(SELECT *, CASE WHEN quoted THEN '\"' ELSE '' END AS q FROM own_lines)",
        [
            *"json_id, invoice_id, type, amount".split(", "),
            """'{"start":' || q || start_s || q || ',"end":' || q || end_s || q || '}'""",
            """'{"product":"' || product || '"}'""",
            """'{"interval":"' || span || '"}'""",
            """'[' || array_to_string(list_transform(discounts, lambda d: '{"amount":' || d || '}'), ',') || ']'""",
        ],
    ),
    "subscriptions": (
        "subs",
        [*_SUBSCRIPTION, """'{"reason":' || coalesce('"' || reason || '"', 'null') || '}'"""],
    ),
}


def _table_contents(json: bool) -> str:
    tables = {**_SHARED_TABLES, **(_JSON_TABLES if json else _NORMALIZED_TABLES)}
    sums = [
        f"""
SELECT '{name}' AS table_name, count(*) AS row_count,
       CAST(coalesce(sum(CAST('0x' || substr(md5(array_to_string(list_transform(
         [{", ".join(f"CAST({column} AS VARCHAR)" for column in columns)}], lambda v: coalesce(v, '~')), '|')), 1, 8)
         AS BIGINT)), 0) AS BIGINT) AS content
FROM {source}"""
        for name, (source, columns) in tables.items()
    ]
    return statement([*STAR, REFUNDS, INTENTS], "\nUNION ALL\n".join(sums))


def _not_in(variant: str, listed: str) -> str:
    return (
        f"SELECT '{variant}' AS variant, invoice_id AS id, charge FROM invoices "
        f"WHERE charge NOT IN ({listed})"
    )


_INVOICED = """
SELECT i.invoice_id, l.line_key, i.customer, i.email AS customer_email, i.sub_id AS subscription,
       i.paid, i.status AS invoice_status, p.product_name, r.cents AS subscription_price,
       make_timestamp(i.from_s * 1000000) AS usage_start,
       make_timestamp(i.to_s * 1000000) AS usage_end,
       l.line_start AS subscription_start, l.line_end AS subscription_end
FROM invoices i JOIN own_lines l USING (invoice_id)
JOIN products p USING (product) JOIN prices r USING (product)"""

_LIVE = """
live AS (
  SELECT sub_id AS subscription_id, customer AS subscription_customer,
         latest_invoice AS invoice_id, status AS subscription_status,
         make_timestamp(from_s * 1000000) AS subscription_period_start,
         make_timestamp(to_s * 1000000) AS subscription_period_end,
         'month' AS plan_interval,
         'plan ' || CAST(replace(sub_id, 'sub_', '') AS BIGINT) % 20 AS plan_nickname,
         CAST(replace(sub_id, 'sub_', '') AS BIGINT) % 20 * 1000 AS plan_amount
  FROM subs WHERE status IN ('active', 'past_due', 'incomplete') AND from_s <> to_s
)"""

_SUMMED = (
    "a.n + coalesce(c.n, 0) + coalesce(u.n, 0) + coalesce(d.n, 0) + coalesce(r.n, 0)"
    " + coalesce(f.n, 0)"
)


def _analytics(final: str) -> str:
    return statement([*STAR, HISTORY, ENDED, ANALYTICS_MONTHS], final)


def _churned(reason: str) -> str:
    return _analytics(f"""
SELECT invoice_id, customer, invoice_status, subscription_status, product_name, reason,
       line_start AS subscription_start
FROM churned WHERE reason = '{reason}'""")


def _narrowed(sql: str, columns: str) -> str:
    return f"SELECT {columns} FROM ({sql})"


def step_statements() -> dict[str, str]:
    """Steps by id."""
    revenue = [*STAR, REFUNDS, REVENUE]
    net = Flavour(net=True)
    json_full = Flavour(json=True, cancel=True, reason=True, net=True)
    return {
        "X01": _table_contents(False),
        "X01j": _table_contents(True),
        "X14": statement(
            [INVOICES, REFUNDS],
            "\nUNION ALL\n".join([
                _not_in("refunds", "SELECT refunded FROM refunds"),
                _not_in("unknown", "SELECT charge FROM invoices WHERE attempt_count = 0"),
                _not_in("nothing", "SELECT refunded FROM refunds WHERE FALSE"),
            ]),
        ),
        "X26": statement(
            [INVOICES],
            """
SELECT *, CAST(sum(invoices) OVER (ORDER BY year, month) AS BIGINT) AS so_far,
       CAST(sum(invoices) OVER (ORDER BY year) AS BIGINT) AS so_far_by_year
FROM (SELECT CAST(year(make_timestamp(from_s * 1000000)) AS INTEGER) AS year,
             CAST(month(make_timestamp(from_s * 1000000)) AS INTEGER) AS month, count(*) AS invoices
      FROM invoices GROUP BY ALL)""",
        ),
        "X31": statement(
            [LINES],
            """
SELECT product, amount::DOUBLE / 100 AS amount FROM lines WHERE span = 'year'
UNION
SELECT product, amount // 100 FROM lines WHERE span <> 'year'""",
        ),
        "X32": statement(
            [LINES],
            """
SELECT line_key, CAST(day AS TIMESTAMP) AS subscription_start,
       CAST(CAST(day + INTERVAL 1 MONTH AS DATE) AS TIMESTAMP) AS subscription_end
FROM (SELECT line_key, CAST(unnest(generate_series(CAST(line_start AS DATE),
        CAST(line_start AS DATE) + INTERVAL 11 MONTH, INTERVAL 1 MONTH)) AS DATE) AS day
      FROM own_lines WHERE span = 'year')""",
        ),
        "X44": statement(
            [LINES],
            """
SELECT rpad(monthname(line_start), 9, ' ') AS month_name, count(*) AS lines, 9 AS width
FROM own_lines GROUP BY ALL""",
        ),
        "X49": statement(
            [LINES],
            """
SELECT line_key, total, round_even(total / 12, 0) AS share
FROM (SELECT line_key, round_even((amount::DOUBLE - coalesce(off, 0)::DOUBLE) / 100, 0) AS total
      FROM own_lines LEFT JOIN (SELECT line_key, unnest(discounts) AS off FROM own_lines) USING (line_key))""",
        ),
        "X51": statement(
            [LINES],
            "SELECT line_key AS id, amount - 3000000 AS cents, (amount - 3000000) // 100 AS units FROM own_lines",
        ),
        "X53": statement([LINES], 'SELECT json_id AS id, start_s AS "start", end_s AS "end" FROM own_lines'),
        "P1": _kept(FULL),
        "P1a": _kept(Flavour()),
        "P1b": _kept(Flavour(cancel=True, reason=True, drop_failed=True)),
        "P1c": _kept(OUTER),
        "P1n": _kept(net),
        "P1j": _kept(Flavour(json=True, net=True)),
        "P2": _periods(FULL_NET, "yearly"),
        "P2a": _periods(json_full, "yearly"),
        "P2b": statement(revenue, "SELECT * FROM yearly_revenue"),
        "P2c": _periods(OUTER, "yearly"),
        "P3": _periods(FULL_NET, "others"),
        "P3a": _periods(json_full, "others"),
        "P3b": statement(revenue, "SELECT * FROM other_revenue"),
        "P3c": _periods(OUTER, "others"),
        "P4": _periods(net, "periods"),
        "P5": _periods(FULL_NET, "final_periods"),
        "P6": statement(
            [*STAR, *timeline(FULL)],
            f"""
SELECT {_period_columns(FULL)}, {_MONTH_KEYS}
FROM final_periods WHERE starts <> ends AND status = 'paid'""",
        ),
        "P7": statement(
            [*STAR, *timeline(FULL_NET), neighbours(FULL_NET)],
            f"SELECT {_neighbour_columns(FULL_NET)} FROM neighbours",
        ),
        "P8": _coded(FULL),
        "P8a": _coded(OUTER, ended_only=False),
        "P8b": _coded(FULL, keep_failed=False),
        "P9": _codes(1, "start"),
        "P10": _codes(2, "end"),
        "P11": statement(
            [*STAR, *timeline(FULL_NET), neighbours(FULL_NET), coded(FULL_NET)],
            churn(FULL_NET, "voluntary_churn_mrr"),
        ),
        "P12": _flagged("upgrade"),
        "P13": _moved("upgrade"),
        "P14": _flagged("downgrade"),
        "P15": _moved("downgrade"),
        "P16": _flagged("reactivation"),
        "P17": _moved("reactivation"),
        "P18": statement(
            [*STAR, delinquent(net)],
            """
SELECT sub_id AS id, customer, status, type, reason, invoice_id, product_name, price_cents,
       make_timestamp((cancel_s + 259200) * 1000000) AS cancel_at,
       make_timestamp(cancel_s * 1000000) AS cancelled_at,
       line_start, line_end, month, year, total
FROM failed""",
        ),
        "P19": statement(
            [*STAR, delinquent(net)],
            """
SELECT DISTINCT i.customer, CAST(year(line_start) AS INTEGER) AS year,
       CAST(month(line_start) AS INTEGER) AS month
FROM invoices i JOIN own_lines USING (invoice_id)
WHERE i.sub_id IN (SELECT sub_id FROM subs) AND i.customer IN (SELECT customer FROM failed)""",
        ),
        "P20": statement(
            [*STAR, delinquent(net)],
            """
SELECT i.customer, count(DISTINCT date_trunc('month', line_start)) AS customer_count
FROM invoices i JOIN own_lines USING (invoice_id)
WHERE i.sub_id IN (SELECT sub_id FROM subs) AND i.customer IN (SELECT customer FROM failed)
GROUP BY i.customer""",
        ),
        "P21": statement([*STAR, delinquent(Flavour())], lost(Flavour(), "customers")),
        "P22": statement(
            [*STAR, *timeline(FULL_NET)],
            """
SELECT customer, starts AS subscription_start, ends AS subscription_end, unit AS unit_amount,
       total, CAST(year(starts) AS INTEGER) AS year, CAST(month(starts) AS INTEGER) AS month
FROM final_periods WHERE status = 'paid' AND unit > 0
QUALIFY row_number() OVER (
  PARTITION BY customer ORDER BY starts, ends, unit, total NULLS LAST) = 1""",
        ),
        "P23": statement([*STAR, *timeline(FULL_NET)], arrivals(FULL_NET, "new_customer_mrr")),
        "P24": statement(
            _movement_ctes(FULL_NET),
            f"""
SELECT a.year, a.month, a.n AS new_customer_mrr, coalesce(c.n, 0) AS voluntary_churn_mrr,
       coalesce(u.n, 0) AS upgrade_mrr, coalesce(d.n, 0) AS downgrade_mrr,
       coalesce(r.n, 0) AS reactivated_mrr, coalesce(f.n, 0) AS delinquent_mrr,
       {_SUMMED} AS summed_metrics
FROM arrived a
LEFT JOIN churned c ON c.start_year = a.year AND c.start_month = a.month
LEFT JOIN upgraded u ON u.start_year = a.year AND u.start_month = a.month
LEFT JOIN downgraded d ON d.start_year = a.year AND d.start_month = a.month
LEFT JOIN reactivated r ON r.start_year = a.year AND r.start_month = a.month
LEFT JOIN failing f ON f.year = a.year AND f.month = a.month""",
        ),
        "P25": statement(
            [INVOICES, LINES, CATALOG, FIRST_INVOICES],
            "SELECT * EXCLUDE (line_key) FROM first_invoices",
        ),
        "P26": _narrowed(existing_customers(FULL), "year, month, existing_customers"),
        "P27": _narrowed(existing_mrr(FULL_NET), "year, month, existing_mrr"),
        "C1": statement(STAR, _INVOICED),
        "C2": statement([SUBSCRIPTIONS, _LIVE], "SELECT * FROM live"),
        "C3": statement(
            [*STAR, _LIVE],
            f"SELECT * REPLACE (CAST(plan_amount AS VARCHAR) AS plan_amount) FROM ({_INVOICED}) LEFT JOIN live USING (invoice_id) WHERE paid",
        ),
        "C4": _analytics("""
SELECT customer, sub_id AS subscription, line_start AS subscription_start, invoice_id, line_key,
       cents AS subscription_price, previous_sub AS prev_subscription,
       CAST(next_cents AS VARCHAR) AS next_subscription_price, next_start AS next_subscription_date
FROM changes"""),
        "C5": _analytics("SELECT year, month, new_customer FROM months"),
        "C6": _analytics("SELECT year, month, so_far AS cumulative_new_customers FROM months"),
        "C7": _analytics("""
SELECT invoice_id, customer, sub_id AS subscription_id, invoice_status, subscription_status,
       product_name, reason, billing_reason, cancel_at_period_end, attempt_count, invoice_paid,
       line_start AS subscription_start, line_end AS subscription_end
FROM ended"""),
        "C8": _churned("cancellation_requested"),
        "C9": _churned("payment_failed"),
        "C10": statement(
            [*revenue, f"months AS ({ARPU_MONTHS})"],
            "SELECT * REPLACE (round(total_revenue, 4) AS total_revenue) FROM months",
        ),
        "C11": statement(
            [INVOICES, LINES, CATALOG, INTENTS, LATEST], "SELECT * FROM latest WHERE latest_entry = 1"
        ),
        "C12": _analytics(
            "SELECT n.year, n.month, upgrades, downgrades FROM months n "
            "LEFT JOIN moves m ON m.year = n.year AND m.month = n.month"
        ),
        "C13": _analytics(
            "SELECT CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, "
            "voluntary, involuntary FROM losses"
        ),
        "C14": _analytics("""
SELECT n.year, n.month,
       so_far - coalesce(voluntary, 0) - coalesce(involuntary, 0) AS existing_customers
FROM months n LEFT JOIN losses l ON l.year = n.year AND l.month = n.month"""),
    }


_BOTH_DAYS = ("subscription_start", "subscription_end")
_LAST_DAY = ("subscription_end",)

# Results that hold dates: shown as midnight timestamps, as by the Spark queries.
_DAYS = {
    "Q05": ("usage_start", "usage_end"),
    "Q06": ("cancel_at", "cancelled_at"),
    "C11": ("usage_start", "usage_end"),
    **dict.fromkeys(
        ("P2", "P2a", "P2c", "P3", "P3a", "P3c", "P4", "P5", "P6", "P22", "P25"), _BOTH_DAYS
    ),
    **dict.fromkeys(("P7", "P8", "P8a", "P8b", "P12", "P14", "P16"), _LAST_DAY),
}


def all_statements() -> dict[str, str]:
    """Every metric and step by id."""
    sql = {**metric_statements(), **step_statements()}
    for key, days in _DAYS.items():
        casts = ", ".join(f"CAST({day} AS TIMESTAMP) AS {day}" for day in days)
        sql[key] = f"SELECT * REPLACE ({casts}) FROM ({sql[key]})"
    return sql
