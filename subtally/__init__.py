"""Subscription revenue metrics as Spark DataFrame functions."""

from subtally.sources.tables import BillingTables, catalog_tables, read_tables

__all__ = ["BillingTables", "catalog_tables", "read_tables"]
