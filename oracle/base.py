"""Derivation of billing rows from the star tables, in DuckDB SQL.

Same rules as FIXTURES.md, written apart from the Spark code. Lines and subscriptions
stay wide here: a child table of one row per line adds nothing to a check.
"""

AS_OF = "TIMESTAMP '2001-06-15 00:00:00'"

INVOICES = """
invoices AS (
  SELECT o_orderkey AS k,
         'in_' || o_orderkey AS invoice_id,
         'cus_' || o_custkey AS customer,
         'u' || o_custkey || '@example.com' AS email,
         'sub_' || o_custkey AS sub_id,
         CASE o_orderstatus WHEN 'P' THEN 'open' ELSE 'paid' END AS status,
         o_orderstatus <> 'P' AS paid,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'ch_' || o_orderkey END AS charge,
         CASE WHEN o_orderkey % 4 = 0 THEN 'subscription_create'
              ELSE 'subscription_cycle' END AS billing_reason,
         'pi_' || o_orderkey AS payment_intent,
         CAST(o_orderkey % 4 AS INTEGER) AS attempt_count,
         CAST(epoch(o_orderdate) AS BIGINT) AS from_s,
         CAST(epoch(o_orderdate) AS BIGINT) + 2592000 AS to_s,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total,
         CAST(round(o_totalprice * 100) AS BIGINT) - o_orderkey % 13 AS untaxed,
         CASE WHEN o_orderkey % 11 = 0 THEN 0
              ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS subtotal
  FROM orders
)"""

# `own_lines` has a row for every line, `lines` one for every price row of a line: some lines name
# a second product, which has no row in products, or none in prices.
LINES = """
own_lines AS (
  SELECT *, make_timestamp(start_s * 1000000) AS line_start,
         make_timestamp(end_s * 1000000) AS line_end
  FROM (SELECT *, start_s + CASE span WHEN 'year' THEN 31536000 ELSE 2592000 END AS end_s FROM (
    SELECT 'il_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey
             || '_' || CAST(round(l_extendedprice * 100) AS BIGINT) AS line_key,
           CASE WHEN l_linenumber % 3 = 0 THEN 'il_' || l_orderkey || '_' || l_linenumber
                ELSE 'il_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey
                       || '_' || CAST(round(l_extendedprice * 100) AS BIGINT) END AS json_id,
           'in_' || l_orderkey AS invoice_id,
           CASE l_returnflag WHEN 'R' THEN 'invoiceitem' ELSE 'subscription' END AS type,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
           CASE WHEN l_discount = 0 THEN CAST([] AS BIGINT[])
                ELSE [CAST(floor(l_extendedprice * l_discount * 100) AS BIGINT)] END
             || CASE WHEN l_linenumber = 7 THEN [CAST(100 AS BIGINT)]
                     ELSE CAST([] AS BIGINT[]) END AS discounts,
           CAST(epoch(o_orderdate) AS BIGINT) + (l_linenumber % 3) * 1728000 AS start_s,
           CASE WHEN l_partkey % 8 = 0 THEN 'year' ELSE 'month' END AS span,
           'prod_' || (l_partkey % 20) AS product,
           CASE l_partkey % 25 WHEN 16 THEN 'prod_20' WHEN 12 THEN 'prod_21' END AS other_product,
           l_linenumber = 5 AS quoted
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  ))
),
lines AS (
  SELECT * FROM own_lines
  UNION ALL
  SELECT * REPLACE (other_product AS product) FROM own_lines WHERE other_product IS NOT NULL
)"""

SUBSCRIPTIONS = """
subs AS (
  SELECT 'sub_' || c_custkey AS sub_id,
         'cus_' || c_custkey AS customer,
         ['active', 'past_due', 'incomplete', 'canceled', 'canceled',
          'incomplete_expired'][CAST(c_custkey % 6 AS INTEGER) + 1] AS status,
         'in_' || last_order AS latest_invoice,
         last_seen AS from_s,
         last_seen + 2592000 AS to_s,
         CASE WHEN c_custkey % 6 IN (3, 4) THEN last_seen + 3456000 END AS cancel_s,
         c_custkey % 2 = 0 AS cancel_at_period_end,
         CASE c_custkey % 6 WHEN 3 THEN 'cancellation_requested'
                            WHEN 4 THEN 'payment_failed' END AS reason
  FROM customer
  LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last_order,
                    max(CAST(epoch(o_orderdate) AS BIGINT)) AS last_seen
             FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
)"""

CATALOG = """
product_numbers AS (SELECT DISTINCT p_partkey % 20 AS n FROM part),
products AS (
  SELECT 'prod_' || n AS product, 'plan ' || n AS product_name FROM product_numbers
  UNION ALL
  SELECT 'prod_21', 'unpriced' FROM product_numbers WHERE n = 0
),
prices AS (
  SELECT 'prod_' || n AS product,
         CAST(CASE WHEN n % 5 = 0 THEN 0 ELSE n * 1000 + 990 END AS BIGINT) AS cents
  FROM product_numbers
  UNION ALL
  SELECT 'prod_3', CAST(7777 AS BIGINT) FROM product_numbers WHERE n = 3
)"""

REFUNDS = """
refunds AS (SELECT 'ch_' || k AS refunded FROM invoices WHERE k % 20 = 0 AND k % 97 <> 0)"""

INTENTS = """
intents AS (
  SELECT invoice_id,
         CASE WHEN paid THEN 'succeeded' WHEN k % 3 = 0 THEN 'requires_payment_method'
              ELSE 'processing' END AS pi_status
  FROM invoices
)"""

STAR = [INVOICES, LINES, SUBSCRIPTIONS, CATALOG]


def statement(ctes: list[str], final: str) -> str:
    """One SQL text from named table expressions and a final select."""
    return "WITH " + ",".join(cte.strip("\n") + "\n" for cte in ctes) + final.strip()
