"""Reads of the supplier and route tables: list, look up, snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_rows(dimension: DataFrame) -> DataFrame:
    return dimension


def lookup(dimension: DataFrame, key: str, value: int) -> DataFrame:
    """The row with that key, or none. The equality is pushed to the scan."""
    return dimension.filter(F.col(key) == F.lit(value))


def supplier_snapshot(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("id", "name", "type")


def capacity_snapshot(routes: DataFrame) -> DataFrame:
    """Every capacity, duplicates kept; only that column is read."""
    return routes.select("capacity")
