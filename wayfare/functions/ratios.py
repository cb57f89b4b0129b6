"""Occupancy and other quotients with explicit rules for a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def occupancy(trips: Column, capacity: Column) -> Column:
    """Trips over seats as a fraction; a route without seats is infinitely full."""
    return F.when(capacity == 0, F.lit(float("inf"))).otherwise(trips.cast("double") / capacity)


def occupancy_percent(trips: Column, seats: Column) -> Column:
    """Trips over seats in percent; no seats gives 0."""
    return F.when(seats == 0, F.lit(0.0)).otherwise(trips.cast("double") / seats * 100)


def mean(total: Column, n: Column) -> Column:
    """``total / n`` as a double, 0 for an empty group."""
    return F.when(n == 0, F.lit(0.0)).otherwise(total.cast("double") / n)
