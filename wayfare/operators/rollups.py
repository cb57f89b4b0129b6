"""Grouped totals: the first, and only large, pass of most queries.

Each is one partial and one final hash aggregate, so a hot key reaches the shuffle as
one row per task. Buffers hold numbers only: a string or struct in a buffer would turn
the hash aggregate into a sort of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ratios import mean
from wayfare.operators.joins import join_by_key
from wayfare.operators.tables import versions_only
from wayfare.session import written

ARRIVAL = ("event_id",)


def at(order: Sequence[str] = ARRIVAL) -> Column:
    """A row's place in the log. One numeric column is far cheaper than several."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def trip_counts(trips: DataFrame, key: str, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Trips per key with the places of the first and the last one; a null key belongs to no group."""
    return (
        trips.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("trips"), F.min(at(order)).alias("first_at"), F.max(at(order)).alias("last_at"))
    )


def leading_counts(trips: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Trips per ``keys``, none null, with the place of the last one, at least for the groups with most trips.

    A place of several columns would make the aggregate a sort of the log. Groups are then counted by
    hash first, and the places are looked for only where several groups have the greatest number.
    """
    known = trips.dropna(subset=list(keys))
    if len(order) == 1:
        return known.groupBy(*keys).agg(F.count("*").alias("trips"), F.max(at(order)).alias("last_at"))
    counts = written(known.groupBy(*keys).agg(F.count("*").alias("trips")), "counts")
    most = counts.agg(F.max("trips")).first()[0]
    leaders = counts.filter(F.col("trips") == F.lit(most))
    if leaders.count() <= 1:
        return leaders.withColumn("last_at", F.lit(None).cast("int"))
    tied = join_by_key(known, leaders.select(*keys), list(keys), "left_semi", order)
    return tied.groupBy(*keys).agg(F.count("*").alias("trips"), F.max(at(order)).alias("last_at"))


def regrouped(totals: DataFrame, key: str) -> DataFrame:
    """Totals of :func:`trip_counts`, made for finer groups, per ``key``."""
    return totals.groupBy(key).agg(
        F.sum("trips").alias("trips"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )


def seats_per_route(routes: DataFrame) -> DataFrame:
    """Seats summed over every version of a route."""
    return versions_only(routes).groupBy("route_id").agg(F.coalesce(F.sum("capacity"), F.lit(0)).cast("bigint").alias("seats"))


def total_trips(trips: DataFrame) -> DataFrame:
    """One row, or none for an empty log."""
    return trips.agg(F.count("*").alias("total_passengers")).filter("total_passengers > 0")


def total_seats(routes: DataFrame) -> DataFrame:
    """One row, or none for an empty log."""
    total = versions_only(routes).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("capacity"), F.lit(0)).cast("bigint").alias("total_seats")
    )
    return total.filter("n > 0").drop("n")


def avg_per_group(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Average of a measure per key from its sum and count."""
    total = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(measure).alias("total"), F.count(measure).alias("n")
    )
    return total.withColumn("average", mean(F.col("total"), F.col("n")))
