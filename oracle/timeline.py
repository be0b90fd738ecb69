"""Checks of the customer timeline: kept invoices, periods, neighbours, movements."""

from __future__ import annotations

from dataclasses import dataclass

from oracle.base import AS_OF


@dataclass(frozen=True)
class Flavour:
    """What a metric's timeline is made of."""

    json: bool = False
    net: bool = False
    cancel: bool = False
    reason: bool = False
    drop_failed: bool = False
    outer: bool = False

    def extras(self, *names: str) -> str:
        """The optional columns in use, as a select list tail."""
        used = {"canceled": self.cancel, "reason": self.reason, "total": self.net}
        return "".join(f", {name}" for name in names if used[name])


#: The discount of a line id: of its rows, the smallest first element of a list.
FIRST_DISCOUNT = "SELECT json_id, min(discounts[1]) AS off FROM own_lines GROUP BY json_id"


def candidates(f: Flavour) -> str:
    """Paid subscription lines that compete for a customer's month."""
    discount = "0"
    joins = ""
    if f.net and f.json:
        discount = "off"
        joins = f"\n  LEFT JOIN ({FIRST_DISCOUNT}) d USING (json_id)"
    elif f.net:
        discount = "off"
        joins = """
  LEFT JOIN (SELECT line_key, unnest(discounts) AS off FROM own_lines) d USING (line_key)"""
    if f.cancel or f.reason or f.drop_failed:
        side = "LEFT" if f.outer else "INNER"
        joins += f"\n  {side} JOIN subs s ON s.sub_id = i.sub_id"
        subscription = """,
         make_timestamp(s.cancel_s * 1000000) AS canceled,
         coalesce(s.reason, 'not_cancelled') AS reason"""
    else:
        subscription = ", NULL AS canceled, NULL AS reason"
    return f"""
candidates AS (
  SELECT i.invoice_id, i.customer, i.email, i.status, {"l.json_id" if f.json else "l.line_key"} AS line_key,
         l.line_start, l.line_end, l.amount,
         {discount} AS discount,
         round_even((coalesce(l.amount, 0)::DOUBLE - coalesce({discount}, 0)::DOUBLE) / 100, 0)
           AS total{subscription}
  FROM invoices i JOIN own_lines l ON l.invoice_id = i.invoice_id{joins}
  WHERE i.status = 'paid' AND l.type = 'subscription'
)"""


KEPT = """
winners AS (
  SELECT * FROM candidates
  QUALIFY row_number() OVER (
    PARTITION BY customer, date_trunc('month', line_start)
    ORDER BY line_start DESC NULLS FIRST, invoice_id, line_key, line_end NULLS LAST,
             amount NULLS LAST, discount NULLS LAST, canceled NULLS LAST, reason NULLS LAST) = 1
)"""


def kept(f: Flavour) -> str:
    keep = "reason <> 'payment_failed'" if f.drop_failed else "TRUE"
    return f"{KEPT},\nkept AS (SELECT * FROM winners WHERE {keep})"


def periods(f: Flavour) -> str:
    """Monthly periods: yearly lines step by a month twelve times, others stay."""
    span = "w" if f.json else "l"
    shared = "w.customer, w.email, w.status, c.product_name, c.unit"
    extras = f.extras("canceled", "reason")
    total = ", total" if f.net else ""
    year_total = ", round_even(total / 12, 0) AS total" if f.net else ""
    side = "LEFT" if f.outer else "INNER"
    lines = "lines" if f.outer else "own_lines"
    return f"""
priced AS (
  SELECT product, product_name, cents // 100 AS unit FROM products {side} JOIN prices USING (product)
),
yearly AS (
  SELECT customer, email, status, product_name, unit{extras}{year_total},
         day AS starts, CAST(day + INTERVAL 1 MONTH AS DATE) AS ends
  FROM (
    SELECT {shared}{extras}{total},
           CAST(unnest(generate_series(CAST({span}.line_start AS DATE),
                                       CAST({span}.line_start AS DATE) + INTERVAL 11 MONTH,
                                       INTERVAL 1 MONTH)) AS DATE) AS day
    FROM kept w JOIN {lines} l USING (invoice_id) {side} JOIN priced c USING (product)
    WHERE l.type = 'subscription' AND l.span = 'year'
  )
),
others AS (
  SELECT {shared}{extras}{total},
         CAST({span}.line_start AS DATE) AS starts, CAST({span}.line_end AS DATE) AS ends
  FROM kept w JOIN {lines} l USING (invoice_id) {side} JOIN priced c USING (product)
  WHERE l.type = 'subscription' AND l.span <> 'year'
),
periods AS (SELECT * FROM yearly UNION SELECT * FROM others),
final_periods AS (
  SELECT * FROM periods
  {"WHERE canceled IS NULL OR CAST(ends AS TIMESTAMP) <= canceled" if f.cancel else ""}
)"""


def neighbours(f: Flavour) -> str:
    """Each billable period beside the one before and the one after."""
    total = ", total" if f.net else ""
    totals = (
        """,
         coalesce(lag(total) OVER timeline, -111) AS total_before,
         coalesce(lead(total) OVER timeline, -222) AS total_after"""
        if f.net
        else ""
    )
    extras = ", total NULLS LAST" * f.net + ", reason NULLS LAST" * f.reason
    reason = ", reason" if f.reason else ""
    return f"""
neighbours AS (
  SELECT customer, unit, starts, ends{reason}{total},
         CAST(year(starts) AS INTEGER) AS start_year, CAST(month(starts) AS INTEGER) AS start_month,
         CAST(year(ends) AS INTEGER) AS end_year, CAST(month(ends) AS INTEGER) AS end_month,
         coalesce(lag(unit) OVER timeline, -111) AS unit_before,
         coalesce(lead(unit) OVER timeline, -222) AS unit_after{totals}
  FROM final_periods
  WHERE starts <> ends AND status = 'paid'
  WINDOW timeline AS (
    PARTITION BY customer
    ORDER BY year(starts), month(starts), ends, unit NULLS LAST{extras})
)"""


def coded(f: Flavour, ended_only: bool = True) -> str:
    """Churn codes: 1 moved to free, 2 lapsed, 0 neither."""
    ended = f"AND {AS_OF} > CAST(ends AS TIMESTAMP)" if ended_only else ""
    failed = "WHERE reason <> 'payment_failed'" if f.reason else ""
    return f"""
coded AS (
  SELECT *,
         CASE WHEN unit_before > 0 AND unit = 0 THEN 1
              WHEN unit > 0 AND unit_after < 0
                   AND date_trunc('month', starts) <> date_trunc('month', {AS_OF}) {ended} THEN 2
              ELSE 0 END AS code
  FROM neighbours {failed}
)"""


MOVES = {
    "upgrade": ("unit > unit_before AND unit_before NOT IN (-111, 0)", "total - total_before"),
    "downgrade": ("unit < unit_before AND unit <> 0", "total - total_before"),
    "reactivation": ("unit > 0 AND unit_before = 0", "total"),
}


def move(f: Flavour, name: str, alias: str) -> str:
    """One movement by start month."""
    condition, money = MOVES[name]
    measure = f"sum({money})" if f.net else "count(*)"
    return (
        f"SELECT start_month, start_year, {measure} AS {alias}\n"
        f"FROM neighbours WHERE {condition} GROUP BY start_month, start_year"
    )


def churn(f: Flavour, alias: str) -> str:
    """Code 1 by start month plus code 2 of the same end month."""
    first = "sum(total_before)" if f.net else "count(customer)"
    second = "sum(total)" if f.net else "count(customer)"
    sign = "-1 * " if f.net else ""
    return f"""
SELECT start_month, start_year, {sign}(a.n + coalesce(b.n, 0)) AS {alias}
FROM (SELECT start_month, start_year, {first} AS n FROM coded WHERE code = 1 GROUP BY ALL) a
LEFT JOIN (SELECT end_month, end_year, {second} AS n FROM coded WHERE code = 2 GROUP BY ALL) b
  ON start_month = end_month AND start_year = end_year"""


def arrivals(f: Flavour, alias: str) -> str:
    """First paid period of each customer, by month."""
    measure = "sum(total)" if f.net else "count(customer)"
    total = ", total NULLS LAST" if f.net else ""
    return f"""
SELECT CAST(month(starts) AS INTEGER) AS month, CAST(year(starts) AS INTEGER) AS year,
       {measure} AS {alias}
FROM (
  SELECT * FROM final_periods WHERE status = 'paid' AND unit > 0
  QUALIFY row_number() OVER (PARTITION BY customer ORDER BY starts, ends, unit{total}) = 1
)
GROUP BY ALL"""


def delinquent(f: Flavour) -> str:
    """Lines of failed subscriptions' latest invoices, of customers with several months."""
    if f.net and not f.json:
        joins = """
  LEFT JOIN (SELECT line_key, unnest(discounts) AS off FROM own_lines) d USING (line_key)"""
        off = "off"
    else:
        joins, off = f"\n  LEFT JOIN ({FIRST_DISCOUNT}) d USING (json_id)", "off"
    return f"""
failed AS (
  SELECT s.sub_id, s.customer, s.status, s.reason, s.cancel_s, i.invoice_id, l.line_key, l.type,
         l.line_start, l.line_end,
         product_name, cents AS price_cents,
         CAST(month(l.line_start) AS INTEGER) AS month,
         CAST(year(l.line_start) AS INTEGER) AS year,
         round_even((coalesce(l.amount, 0)::DOUBLE - coalesce({off}, 0)::DOUBLE) / 100, 0) AS total
  FROM subs s
  JOIN invoices i ON i.invoice_id = s.latest_invoice
  JOIN own_lines l ON l.invoice_id = i.invoice_id{joins}
  JOIN products USING (product) JOIN prices USING (product)
  WHERE s.reason = 'payment_failed' AND s.cancel_s IS NOT NULL
),
repeated AS (
  SELECT i.customer
  FROM invoices i JOIN own_lines l USING (invoice_id)
  WHERE i.sub_id IN (SELECT sub_id FROM subs)
    AND i.customer IN (SELECT customer FROM failed)
  GROUP BY i.customer
  HAVING count(DISTINCT date_trunc('month', l.line_start)) > 1
)"""


def lost(f: Flavour, alias: str) -> str:
    """Delinquent customers, or their money, by month."""
    measure = "sum(total)" if f.net else "count(DISTINCT customer)"
    return (
        f"SELECT month, year, {measure} AS {alias} FROM failed\n"
        "WHERE customer IN (SELECT customer FROM repeated) GROUP BY month, year"
    )


def timeline(f: Flavour) -> list[str]:
    """Everything up to the final periods."""
    return [candidates(f), kept(f), periods(f)]
