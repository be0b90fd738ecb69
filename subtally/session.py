"""Session settings the jobs in this package are tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ZONE = "spark.sql.session.timeZone"

SETTINGS = {
    # Epoch seconds turn into calendar days in the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot invoices, subscriptions and products are split at join time, even where the
    # split costs the partitioning a later step would have used.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sides are broadcast from measured size only: no join here carries a hint.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a running session; all of them can change at runtime."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    """Plans made inside use days and months of UTC; the caller's zone is put back after.

    Spark fixes the zone of an expression when a DataFrame is made, not when it runs.
    """
    before = spark.conf.get(ZONE)
    spark.conf.set(ZONE, "UTC")
    try:
        yield
    finally:
        spark.conf.set(ZONE, before)


def require_utc(spark: SparkSession) -> None:
    """Fail early: in another zone the metrics would fall into other days and months."""
    if spark.conf.get(ZONE) not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set {ZONE} to UTC, or make the metrics inside subtally.session.utc(spark)")


def build_session(master: str | None = None, app_name: str = "subtally", **extra: str) -> SparkSession:
    """Create or get a session with `SETTINGS`; on a cluster leave `master` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # Call sites for error messages cost several driver calls per column expression.
    driver = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**SETTINGS, **driver, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
