"""Tumbling windows of one hour over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.functions.ratios import occupancy
from wayfare.functions.text import known_type
from wayfare.operators.ordered import ROWS_PER_TASK, running, running_max
from wayfare.operators.rollups import ARRIVAL, at

HOUR = "1 hour"
# Occupancies are summed as decimals, so that a total does not depend on the order of its terms.
EXACT = "decimal(38,15)"
# Digits that totals are compared on; the rest of EXACT absorbs the rounding of single terms.
COMPARED_DIGITS = 12


def window_start(ts: str = "ts", size: str = HOUR) -> Column:
    """Start of the epoch-aligned window [start, start + size) of a row."""
    return F.window(ts, size)["start"]


def hourly_type_counts(trips: DataFrame, order: Sequence[str] = ARRIVAL, size: str = HOUR) -> DataFrame:
    """Trips per window and transport type, with the places of the first and last one."""
    return (
        trips.filter(F.col("transport_type").isNotNull())
        .groupBy(window_start(size=size).alias("window_start"), "transport_type")
        .agg(F.count("*").alias("trips"), F.min(at(order)).alias("first_at"), F.max(at(order)).alias("last_at"))
    )


def hourly_route_counts(trips: DataFrame, order: Sequence[str] = ARRIVAL, size: str = HOUR) -> DataFrame:
    """Trips per route and window, with the places of the first and last one.

    The one pass over the log that the occupancy windows need.
    """
    return (
        trips.filter(F.col("route_id").isNotNull())
        .groupBy("route_id", window_start(size=size).alias("window_start"))
        .agg(F.count("*").alias("trips"), F.min(at(order)).alias("first_at"), F.max(at(order)).alias("last_at"))
    )


def with_trips_before(route_hours: DataFrame) -> DataFrame:
    """Adds the trips of the route before the window. A route has one row per window here, however many trips."""
    earlier = W.partitionBy("route_id").orderBy("window_start").rowsBetween(W.unboundedPreceding, -1)
    return route_hours.withColumn("before", F.coalesce(F.sum("trips").over(earlier), F.lit(0).cast("bigint")))


def hourly_type_occupancy(route_hours: DataFrame, route_table: DataFrame) -> DataFrame:
    """Per window and route type: all running occupancies of the window added up, and its first one.

    A route that enters a window with b trips and makes m in it contributes (b+1 + ... + b+m)
    / capacity, a closed form, so no row per trip is needed. Capacities must not be negative.
    """
    hours = with_trips_before(route_hours).join(route_table.select("route_id", "type", "capacity"), "route_id")
    made = F.col("trips").cast("double")
    counts = made * F.col("before") + made * (made + 1) / 2
    seated = F.col("capacity") != 0
    added = F.when(seated, (counts / F.col("capacity")).cast(EXACT))
    first = occupancy(F.col("before") + 1, F.col("capacity"))
    return (
        hours.groupBy("window_start", known_type(F.col("type")).alias("type"))
        .agg(
            F.sum(added).cast(EXACT).alias("seated_occupancy"),
            F.max(~seated).alias("has_unseated"),
            F.sum("trips").alias("updates"),
            F.min_by(first, "first_at").alias("first_occupancy"),
            F.min_by("route_id", "first_at").alias("first_route"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
        .select(
            "window_start",
            "type",
            # an infinite total ranks last of all and is reported as infinity
            F.when(~F.col("has_unseated"), F.round("seated_occupancy", COMPARED_DIGITS)).alias("compared"),
            F.when(F.col("has_unseated"), F.lit(float("inf")))
            .otherwise(F.col("seated_occupancy").cast("double")).alias("occupancy"),
            "updates",
            "first_occupancy",
            "first_route",
            "first_at",
            "last_at",
        )
    )


def with_update_time(
    trips: DataFrame, key: str = "route_id", order: Sequence[str] = ARRIVAL, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Adds ``update_ts``, the latest time of the key so far.

    A running total carries this time on. It differs from ``ts`` only where the log is out of
    time order; with it in place of ``ts`` the hourly answers count an update in the hour
    that its key has reached.
    """
    keyed = trips.filter(F.col(key).isNotNull())
    return running(keyed, [key], order, {"update_ts": running_max(F.col("ts"))}, rows_per_task)


def by_source_partition(trips: DataFrame, source_partition: Column) -> DataFrame:
    """Adds the log partition of a trip, and (_none, _partition) as its key; trips without one are a log of their own."""
    return trips.withColumn("source_partition", source_partition).withColumns({
        "_none": F.col("source_partition").isNull(), "_partition": F.coalesce("source_partition", F.lit(0)),
    })


def is_late(size: str = HOUR) -> Column:
    """Whether a trip's window had closed by the stream time of its log partition."""
    return F.window("ts", size)["end"] <= F.col("stream_time")


def late_events(
    trips: DataFrame,
    source_partition: Column,
    order: Sequence[str] = ARRIVAL,
    size: str = HOUR,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every trip with the stream time of its log partition on arrival, and whether its window had closed by then."""
    keyed = by_source_partition(trips, source_partition)
    running_time = {"stream_time": running_max(F.col("ts"))}
    timed = running(keyed, ["_none", "_partition"], order, running_time, rows_per_task).drop("_none", "_partition")
    return timed.withColumn("late", is_late(size))


def on_time(trips: DataFrame, source_partition: Column, **options) -> DataFrame:
    """The trips that a window without grace accepts."""
    return late_events(trips, source_partition, **options).filter("NOT late").select(*trips.columns)
