"""Billing tables derived from an order / line-item star schema (rules in FIXTURES.md).

The star schema has no billing data of its own; orders become invoices, their lines
invoice lines, and customers subscriptions. Everything is derived by Spark from the
whole tables, so the derived tables grow with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.sources.schemas import LINE_HASH, SUBSCRIPTION_HASH, Layout
from subtally.sources.tables import BillingTables

DAY = 86400
PRODUCTS = 20
# Named by some lines beside their own product: one has no row in products, the other none in prices.
UNKNOWN_PRODUCT = "prod_20"
UNPRICED_PRODUCT = "prod_21"


def _tag(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


#: What the other columns of a line are made of.
ITEM_COLUMNS = ("l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag")


def _is_yearly() -> Column:
    return F.col("l_partkey") % 8 == 0


def _seconds() -> Column:
    """Length of a line's period."""
    return F.when(_is_yearly(), 365 * DAY).otherwise(30 * DAY)


def _whole(frame: DataFrame, known: str, *keys: str) -> DataFrame:
    """The same rows, of which every reader takes all columns from below, so that readers share shuffles.

    The optimizer cuts columns and rows of one reader from every step below, which makes its
    shuffles differ from those of the next reader; it does not look into what a generator makes
    as long as two fields of it are read. `known`, which is never NULL, is always one of them.
    Keys stay beside it, so that rows dealt by them are known to be; a filter on them is not taken
    below a number that depends on the task.
    """
    frame = frame.withColumn("task", F.spark_partition_id())
    rest = [F.col(name) for name in frame.columns if name not in keys]
    rows = frame.select(*keys, F.explode(F.array(F.struct(*rest))).alias("row"))
    return rows.filter(F.col(f"row.{known}").isNotNull()).select(*keys, "row.*")


def _order_part() -> Column:
    return F.concat(F.lit("il_"), F.substring("invoice_id", len("in_") + 1, 20))


def _line_columns(items: DataFrame) -> DataFrame:
    number = F.col("l_linenumber")
    off = F.floor(F.col("l_extendedprice") * F.col("l_discount") * 100)
    none = F.array().cast("array<bigint>")
    first = F.when(F.col("l_discount") != 0, F.array(off)).otherwise(none)
    second = F.when(number == 7, F.array(F.lit(100).cast("long"))).otherwise(none)
    return items.select(
        "id",
        F.when(number % 3 == 0, F.concat(_order_part(), _tag("_", number))).alias("shared_id"),
        "invoice_id",
        F.when(F.col("l_returnflag") == "R", "invoiceitem").otherwise("subscription").alias("type"),
        _cents(F.col("l_extendedprice")).alias("amount"),
        F.concat(first, second).alias("discounts"),
        (F.col("to_epoch") - _seconds()).alias("start"),
        F.col("to_epoch").alias("end"),
        F.when(_is_yearly(), "year").otherwise("month").alias("interval"),
        _tag("prod_", F.col("l_partkey") % PRODUCTS).alias("product"),
        F.when(F.col("l_partkey") % 25 == 16, UNKNOWN_PRODUCT)
        .when(F.col("l_partkey") % 25 == 12, UNPRICED_PRODUCT)
        .alias("other_product"),
        (number == 5).alias("quoted"),
    )


class _Star:
    """The star tables and the wide rows the billing tables are cut from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def invoices(self) -> DataFrame:
        key = F.col("o_orderkey")
        ordered = F.unix_timestamp("o_orderdate")
        status = F.when(F.col("o_orderstatus") == "P", "open").otherwise("paid")
        total = _cents(F.col("o_totalprice"))
        return self._read("orders").select(
            key.alias("order_key"),
            _tag("in_", key).alias("id"),
            _tag("cus_", F.col("o_custkey")).alias("customer"),
            F.concat(_tag("u", F.col("o_custkey")), F.lit("@example.com")).alias("customer_email"),
            _tag("sub_", F.col("o_custkey")).alias("subscription"),
            status.alias("status"),
            (status == "paid").alias("paid"),
            F.when(key % 97 != 0, _tag("ch_", key)).alias("charge"),
            F.when(key % 4 == 0, "subscription_create")
            .otherwise("subscription_cycle")
            .alias("billing_reason"),
            _tag("pi_", key).alias("payment_intent"),
            ordered.alias("period_start"),
            (ordered + 30 * DAY).alias("period_end"),
            total.alias("total"),
            F.when(key % 11 == 0, F.lit(0)).otherwise(total).cast("long").alias("subtotal"),
            (total - key % 13).alias("total_excluding_tax"),
            (key % 4).cast("int").alias("attempt_count"),
        )

    def _items(self) -> DataFrame:
        """Line items with the time of their order, and the columns that need both sides or a key.

        Line numbers repeat within an order, so the id also names part, supplier and price.
        """
        orders = self._read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.unix_timestamp("o_orderdate").alias("ordered"),
        )
        start = F.col("ordered") + (F.col("l_linenumber") % 3) * (20 * DAY)
        return self._read("lineitem").join(orders, "l_orderkey").select(
            F.concat(
                _tag("il_", F.col("l_orderkey")), _tag("_", F.col("l_linenumber")),
                _tag("_", F.col("l_partkey")), _tag("_", F.col("l_suppkey")),
                _tag("_", _cents(F.col("l_extendedprice"))),
            ).alias("id"),
            _tag("in_", F.col("l_orderkey")).alias("invoice_id"),
            (start + _seconds()).alias("to_epoch"),
            *ITEM_COLUMNS,
        )

    def lines(self) -> DataFrame:
        """Every line item with all that its child tables hold.

        The tables cut from it join the orders and, dealt by their id, move only once for all of them.
        """
        return _line_columns(_whole(self._items().hint("rebalance", "id"), "invoice_id", "id"))

    def plain_lines(self) -> DataFrame:
        """The same rows as they come from their orders, for a table that is joined on the invoice."""
        return _line_columns(_whole(self._items(), "invoice_id"))

    def subscriptions(self) -> DataFrame:
        last = (
            self._read("orders")
            .groupBy("o_custkey")
            .agg(
                F.max("o_orderkey").alias("last_order"),
                F.max(F.unix_timestamp("o_orderdate")).alias("last_seen"),
            )
        )
        key = F.col("c_custkey")
        group = key % 6
        gone = F.when(group.isin(3, 4), F.col("last_seen") + 40 * DAY)
        status = (
            F.when(group == 0, "active")
            .when(group == 1, "past_due")
            .when(group == 2, "incomplete")
            .when(group.isin(3, 4), "canceled")
            .otherwise("incomplete_expired")
        )
        reason = F.when(group == 3, "cancellation_requested").when(group == 4, "payment_failed")
        customers = self._read("customer")
        return customers.join(last, customers.c_custkey == last.o_custkey, "left").select(
            _tag("sub_", key).alias("id"),
            _tag("cus_", key).alias("customer"),
            status.alias("status"),
            _tag("in_", F.col("last_order")).alias("latest_invoice"),
            F.col("last_seen").alias("current_period_start"),
            (F.col("last_seen") + 30 * DAY).alias("current_period_end"),
            (gone + 3 * DAY).alias("cancel_at"),
            gone.alias("canceled_at"),
            (key % 2 == 0).alias("cancel_at_period_end"),
            reason.alias("reason"),
            F.lit("month").alias("plan_interval"),
            _tag("plan ", key % PRODUCTS).alias("plan_nickname"),
            (key % PRODUCTS * 1000).alias("plan_amount"),
        )

    def product_numbers(self) -> DataFrame:
        return self._read("part").select((F.col("p_partkey") % PRODUCTS).alias("n")).distinct()

    def products(self) -> DataFrame:
        """A row per number, and one of the product without a price."""
        n = F.col("n")
        row = F.struct(_tag("prod_", n).alias("id"), _tag("plan ", n).alias("name"))
        extra = F.struct(F.lit(UNPRICED_PRODUCT).alias("id"), F.lit("unpriced").alias("name"))
        rows = F.when(n == 0, F.array(row, extra)).otherwise(F.array(row))
        return self.product_numbers().select(F.explode(rows).alias("row")).select("row.*")

    def prices(self) -> DataFrame:
        """One price per product, and a second one of product 3."""
        n = F.col("n")
        listed = F.when(n % 5 == 0, F.lit(0)).otherwise(n * 1000 + 990).cast("long")
        amounts = F.when(n == 3, F.array(listed, F.lit(7777).cast("long"))).otherwise(
            F.array(listed)
        )
        return self.product_numbers().select(
            _tag("prod_", n).alias("product"), F.explode(amounts).alias("unit_amount")
        )


def _payment_intents(invoices: DataFrame) -> DataFrame:
    unpaid = F.when(F.col("order_key") % 3 == 0, "requires_payment_method").otherwise("processing")
    return invoices.select(
        F.col("id").alias("invoice"), F.when(F.col("paid"), "succeeded").otherwise(unpaid).alias("status")
    )


def _refunds(invoices: DataFrame) -> DataFrame:
    return invoices.filter("order_key % 20 = 0 AND order_key % 97 <> 0").select("charge")


def _hashed_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn(LINE_HASH, F.col("id"))


def _hashed_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.withColumn(SUBSCRIPTION_HASH, F.col("id"))


def _priced_products() -> Column:
    """The product of a line and the other one it names, if any."""
    other = F.col("other_product")
    return F.when(other.isNull(), F.array("product")).otherwise(F.array("product", other))


_NORMALIZED_CUTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "invoice_line_items": (
        "lines",
        lambda w: w.select(
            LINE_HASH, "id", "invoice_id", F.col("invoice_id").alias("invoice"), "type", "amount"
        ),
    ),
    "invoice_line_items_period": ("lines", lambda w: w.select(LINE_HASH, "start", "end")),
    "invoice_line_items_price": (
        "lines",
        lambda w: w.select(LINE_HASH, F.explode(_priced_products()).alias("product")),
    ),
    "invoice_line_items_plan": ("lines", lambda w: w.select(LINE_HASH, "interval", "product")),
    "invoice_line_items_discount_amounts": (
        "lines",
        lambda w: w.select(LINE_HASH, F.explode("discounts").alias("amount")),
    ),
    "subscriptions": (
        "subscriptions",
        lambda w: w.drop("reason", "plan_interval", "plan_nickname", "plan_amount"),
    ),
    "subscriptions_plan": (
        "subscriptions",
        lambda w: w.select(
            SUBSCRIPTION_HASH,
            F.col("plan_interval").alias("interval"),
            F.col("plan_nickname").alias("nickname"),
            F.col("plan_amount").alias("amount"),
        ),
    ),
    "subscriptions_cancellation_details": (
        "subscriptions",
        lambda w: w.filter("reason IS NOT NULL").select(SUBSCRIPTION_HASH, "reason"),
    ),
}


def _normalized(wide: Callable[[str], DataFrame], name: str) -> DataFrame:
    base, cut = _NORMALIZED_CUTS[name]
    hashed = _hashed_lines if base == "lines" else _hashed_subscriptions
    return cut(hashed(wide(base)))


def _with_json_columns(lines: DataFrame) -> DataFrame:
    """Lines of the JSON layout; every third line number of an invoice shares one line id.

    The epochs of some lines are quoted.
    """
    discounts = F.transform("discounts", lambda cents: F.struct(cents.alias("amount")))
    return lines.select(
        F.coalesce("shared_id", "id").alias("id"),
        "invoice_id",
        "type",
        "amount",
        F.when(F.col("quoted"), F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("start", "end")])))
        .otherwise(F.to_json(F.struct("start", "end")))
        .alias("period"),
        F.to_json(F.struct("product")).alias("price"),
        F.to_json(F.struct("interval")).alias("plan"),
        F.to_json(discounts).alias("discount_amounts"),
    )


def _with_json_reason(subscriptions: DataFrame) -> DataFrame:
    details = F.to_json(F.struct("reason"), {"ignoreNullFields": "false"})
    return subscriptions.drop("plan_interval", "plan_nickname", "plan_amount").select(
        "*", details.alias("cancellation_details")
    ).drop("reason")


class _OnDemand(Mapping):
    """Tables by name, each built when first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class _Store:
    """The wide tables: lazy, or written to a folder of the caller's and read back."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str | None):
        self.star = _Star(spark, sf_dir)
        self._spark = spark
        self._folder = folder
        self._ready: dict[str, DataFrame] = {}

    def tables(self, layout: Layout) -> BillingTables:
        return BillingTables(layout, _OnDemand(self._builders(layout)))

    def _builders(self, layout: Layout) -> dict[str, Callable[[], DataFrame]]:
        wide = self.wide
        shared = {
            "invoices": lambda: wide("invoices").drop("order_key"),
            "products": lambda: wide("products"),
            "prices": lambda: wide("prices"),
            "payment_intents": lambda: _payment_intents(wide("invoices")),
            "refunds": lambda: _refunds(wide("invoices")),
        }
        if layout == "json":
            return {
                **shared,
                "invoice_line_items": lambda: wide("lines_json"),
                "subscriptions": lambda: wide("subscriptions_json"),
            }
        return {**shared, **{name: partial(_normalized, wide, name) for name in _NORMALIZED_CUTS}}

    def wide(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self._written(name, self._derive(name))
        return self._ready[name]

    def _derive(self, name: str) -> DataFrame:
        if name == "lines_json":
            return _with_json_columns(self.wide("plain_lines"))
        if name == "subscriptions_json":
            return _with_json_reason(self.wide("subscriptions"))
        return getattr(self.star, name)()

    def _written(self, name: str, frame: DataFrame) -> DataFrame:
        if self._folder is None:
            return frame
        target = f"{self._folder}/{name}"
        frame.write.parquet(target)
        return self._spark.read.schema(frame.schema).parquet(target)


def billing_tables(
    spark: SparkSession, sf_dir: str, layout: Layout = "normalized", folder: str | None = None
) -> BillingTables:
    """Billing tables derived from the star tables in `sf_dir`.

    They are lazy. With a `folder`, which must be new and which all executors must reach,
    each wide table is written there when first asked for, and read from there.
    """
    return _Store(spark, sf_dir, folder).tables(layout)
