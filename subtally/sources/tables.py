"""The billing tables a metric reads, and ways to open them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.session import require_utc
from subtally.sources.schemas import BUCKET_KEYS, HOT_INVOICES, SALT, SALTED_KEYS, SCHEMAS, Layout


@dataclass(frozen=True)
class BillingTables:
    """One DataFrame per table, reached as an attribute, in a known layout."""

    layout: Layout
    frames: Mapping[str, DataFrame]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.frames[name]
        except KeyError:
            raise AttributeError(f"no table {name!r} in the {self.layout} layout") from None

    @property
    def is_json(self) -> bool:
        return self.layout == "json"


def read_tables(
    spark: SparkSession, path: str, layout: Layout = "normalized", source: str = "parquet"
) -> BillingTables:
    """Open `path/<table>` for every table of the layout with its declared schema."""
    require_utc(spark)
    frames = {
        name: spark.read.format(source).schema(schema).load(f"{path}/{name}")
        for name, schema in SCHEMAS[layout].items()
    }
    return BillingTables(layout, frames)


def catalog_tables(
    spark: SparkSession, database: str = "public", layout: Layout = "normalized"
) -> BillingTables:
    """Open the tables of the layout from a database of the session catalog."""
    require_utc(spark)
    names = list(SCHEMAS[layout])
    if spark.catalog.tableExists(f"{database}.{HOT_INVOICES}"):
        names.append(HOT_INVOICES)
    return BillingTables(layout, {name: spark.table(f"{database}.{name}") for name in names})


def store_tables(t: BillingTables, database: str, buckets: int) -> None:
    """Save the tables in a catalog database, bucketed by the keys they are joined on.

    Joins of a normalized line with its child tables, the widest of every metric, then read
    co-located buckets and shuffle nothing. JSON lines are bucketed by invoice and salt: the
    rows of an invoice that would fill more than a bucket are dealt over several, and joins
    replicate such an invoice instead of moving the lines (`operators.lines.with_lines`).
    Open the result with `catalog_tables`.
    """
    for name, key in BUCKET_KEYS[t.layout].items():
        table = getattr(t, name)
        if name in SALTED_KEYS[t.layout]:
            salted = SALTED_KEYS[t.layout][name]
            _store_buckets(_with_salt(table, salted, database, buckets), f"{database}.{name}", buckets, salted, SALT)
        elif key:
            _store_buckets(table, f"{database}.{name}", buckets, key)
        else:
            table.write.format("parquet").saveAsTable(f"{database}.{name}")


def _store_buckets(table: DataFrame, name: str, buckets: int, *keys: str) -> None:
    # One task writes a bucket, so there is one file for each.
    dealt = table.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def _with_salt(table: DataFrame, key: str, database: str, buckets: int) -> DataFrame:
    """Add the salt: 0, or for keys of more rows than a bucket's share a part by row hash.

    Fewer keys than buckets can be so large, which bounds the table of hot keys.
    """
    spark = table.sparkSession
    size = F.lit(table.count()) / buckets
    counted = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    hot = counted.filter(F.col("rows") > size)
    parts = F.ceil(F.col("rows") / size).cast("int").alias("parts")
    hot.select(key, parts).write.format("parquet").saveAsTable(f"{database}.{HOT_INVOICES}")
    listed = spark.table(f"{database}.{HOT_INVOICES}")
    # Rows without a key meet nothing, so they may lie anywhere.
    parts = F.when(F.col(key).isNull(), buckets).otherwise(F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64(*table.columns), parts).cast("int")
    return table.join(listed, key, "left").select(*table.columns, part.alias(SALT))
