"""The thirteen questions about trips and routes, numbered as their result tables are.

Each is a function of the trip log and the route log. The ones on per-key totals have a
second form, ``*_from``, that starts at those totals: streams keep the totals up to date
and finish with the same code.

Two kinds of occupancy exist and must not be mixed. Questions 6 and 9 are percentages of
the seats summed over all versions of a route. Questions 12, 14 and 15 are fractions of
the capacity of one version. The transport type of 10, 11 and 13 is the trip's, that
of 12 and 14 the route's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ratios import mean, occupancy, occupancy_percent
from wayfare.functions.text import known_type
from wayfare.operators.changelog import first_updates_as_of, lookup_asof, route_table
from wayfare.operators.extremes import best, least_per
from wayfare.operators.folds import joined_names
from wayfare.operators.joins import BROADCAST_BYTES, join_by_key
from wayfare.operators.ordered import ROWS_PER_TASK
from wayfare.operators.rollups import (
    ARRIVAL, leading_counts, seats_per_route, total_seats, total_trips, trip_counts,
)
from wayfare.operators.windows import hourly_route_counts, hourly_type_counts, hourly_type_occupancy, window_start
from wayfare.session import written


def q04_passengers_per_route(trips: DataFrame, order: Sequence[str] = ARRIVAL, **limits: int) -> DataFrame:
    names = joined_names(trips, "route_id", "passenger_name", order, **limits)
    return names.withColumnRenamed("names", "passengers")


def q05_seats_per_route(routes: DataFrame) -> DataFrame:
    return seats_per_route(routes)


def q06_occupancy_per_route(trips: DataFrame, routes: DataFrame) -> DataFrame:
    # both sides are grouped by route before they meet, so a hot route joins as one row
    counts = trips.filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(F.count("*").alias("trips"))
    return q06_from(counts, seats_per_route(routes))


def q06_from(route_trips: DataFrame, route_seats: DataFrame) -> DataFrame:
    joined = route_trips.select("route_id", F.col("trips").alias("passengers")).join(route_seats, "route_id")
    return joined.withColumn("occupancy_pct", occupancy_percent(F.col("passengers"), F.col("seats")))


def q07_total_passengers(trips: DataFrame) -> DataFrame:
    return total_trips(trips)


def q08_total_seats(routes: DataFrame) -> DataFrame:
    return total_seats(routes)


def q09_total_occupancy(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return q09_from(total_trips(trips), total_seats(routes))


def q09_from(passengers: DataFrame, seats: DataFrame) -> DataFrame:
    """Two totals side by side: a union and an aggregate of at most two rows. No row until both exist."""
    both = passengers.unionByName(seats, allowMissingColumns=True).agg(
        F.max("total_passengers").alias("total_passengers"), F.max("total_seats").alias("total_seats")
    )
    return both.filter("total_passengers IS NOT NULL AND total_seats IS NOT NULL").withColumn(
        "occupancy_pct", occupancy_percent(F.col("total_passengers"), F.col("total_seats"))
    )


def q10_avg_passengers_per_type(trips: DataFrame) -> DataFrame:
    counts = (
        trips.filter(F.col("transport_type").isNotNull())
        .groupBy("transport_type").agg(F.count("*").alias("trips"))
    )
    return q10_from(counts)


def q10_from(type_trips: DataFrame) -> DataFrame:
    """Passengers over trips. A trip record is one passenger, so the average is 1."""
    return type_trips.select(
        "transport_type",
        F.col("trips").alias("passengers"),
        "trips",
        mean(F.col("trips"), F.col("trips")).alias("avg_passengers"),
    )


def q11_top_type(trips: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    return q11_from(leading_counts(trips, ["transport_type"], order))


def q11_from(type_trips: DataFrame) -> DataFrame:
    """Most trips; on a tie the type that reached the number first."""
    top = best(type_trips, F.desc("trips"), F.asc("last_at"), F.asc("transport_type"))
    return top.select("transport_type", F.col("trips").alias("passengers"))


def q12_least_occupied_route(trips: DataFrame, routes: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Per route type the route that is least full now; ties go to the smaller id."""
    counts = trip_counts(trips, "route_id", order).select("route_id", "trips")
    return q12_from(counts, route_table(routes, "type", "capacity"))


def q12_from(route_trips: DataFrame, table: DataFrame) -> DataFrame:
    rows = route_trips.join(table, "route_id").select(
        known_type(F.col("type")).alias("type"),
        "route_id",
        occupancy(F.col("trips"), F.col("capacity")).alias("occupancy"),
    )
    return least_per(rows, "type", "occupancy", "route_id")


def q12_least_occupied_route_changelog(
    trips: DataFrame, routes: DataFrame, order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Per route type the least occupancy that any update ever showed; ties go to the earlier update.

    Occupancy grows with each trip, so the least update of a route is that of its first trip.
    """
    return q12_changelog_from(trip_counts(trips, "route_id", order), route_table(routes, "type", "capacity"))


def q12_changelog_from(route_trips: DataFrame, table: DataFrame) -> DataFrame:
    return least_updates(route_trips, table).drop("first_at")


def least_updates(route_trips: DataFrame, table: DataFrame) -> DataFrame:
    """Per route type the least update, with its place."""
    rows = route_trips.join(table, "route_id").select(
        known_type(F.col("type")).alias("type"),
        "route_id",
        occupancy(F.lit(1), F.col("capacity")).alias("occupancy"),
        "first_at",
    )
    return least_per(rows, "type", "occupancy", "first_at")


def q12_least_occupied_route_asof(
    trips: DataFrame, routes: DataFrame, rows_per_task: int = ROWS_PER_TASK, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """As the changelog form, with the capacity and type that were valid at each trip's time.

    The least update per route version is its first.
    """
    firsts = first_updates_as_of(trips, routes, ["type", "capacity"], broadcast_bytes)
    if firsts is None:
        updates = lookup_asof(trips, routes, ["type", "capacity"], rows_per_task=rows_per_task)
        # numbers only, so this stays a hash aggregate
        firsts = updates.groupBy("route_id", "seq", "type", "capacity").agg(
            F.min("trips_so_far").alias("trips_so_far"),
            F.min_by("ts", "trips_so_far").alias("ts"),
            F.min_by("event_id", "trips_so_far").alias("event_id"),
        ).withColumn("place", F.struct("ts", "event_id"))
    rows = firsts.select(
        known_type(F.col("type")).alias("type"),
        "route_id",
        occupancy(F.col("trips_so_far"), F.col("capacity")).alias("occupancy"),
        "place",
    )
    return least_per(rows, "type", "occupancy", "place").drop("place")


def q13_top_hourly_type(trips: DataFrame, scope: str = "all", order: Sequence[str] = ARRIVAL) -> DataFrame:
    if scope != "all":
        return q13_from(hourly_type_counts(trips, order), scope)
    hours = trips.withColumn("window_start", window_start())
    return q13_from(leading_counts(hours, ["window_start", "transport_type"], order))


def q13_from(type_hours: DataFrame, scope: str = "all") -> DataFrame:
    """The type with most trips in one hour, of all hours or of the latest."""
    top = best(
        type_hours, *_of_scope(scope), F.desc("trips"), F.asc("last_at"),
        F.asc("window_start"), F.asc("transport_type"),
    )
    return top.select("window_start", "transport_type", "trips")


def q14_least_occupied_type(
    trips: DataFrame, routes: DataFrame, scope: str = "all", order: Sequence[str] = ARRIVAL
) -> DataFrame:
    table = route_table(routes, "type", "capacity")
    return q14_from(hourly_type_occupancy(hourly_route_counts(trips, order), table), scope)


def q14_from(type_hours: DataFrame, scope: str = "all") -> DataFrame:
    """The route type with the least final total in one hour, of all hours or of the latest."""
    top = best(
        type_hours, *_of_scope(scope), F.asc_nulls_last("compared"), F.asc("last_at"),
        F.asc("window_start"), F.asc("type"),
    )
    return top.select("window_start", "type", F.round("occupancy", 6).alias("occupancy"))


def q14_least_occupied_type_changelog(
    trips: DataFrame, routes: DataFrame, order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The least total that any update ever showed. Totals grow, so only the first of each hour counts."""
    table = route_table(routes, "type", "capacity")
    return q14_changelog_from(hourly_type_occupancy(hourly_route_counts(trips, order), table))


def q14_changelog_from(type_hours: DataFrame) -> DataFrame:
    top = best(type_hours, F.asc("first_occupancy"), F.asc("first_at"))
    return top.select("window_start", "type", F.col("first_occupancy").alias("occupancy"))


def _of_scope(scope: str) -> list:
    if scope not in ("all", "latest"):
        raise ValueError(f"scope is 'all' or 'latest', not {scope!r}")
    return [F.desc("window_start")] if scope == "latest" else []


def q15_top_operator(trips: DataFrame, routes: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    table = route_table(routes, "operator", "capacity")
    if len(order) == 1:
        return q15_from(trip_counts(trips, "route_id", order), table)
    # places of several columns would make the aggregate a sort of the log: they are looked for only on a tie
    known = trips.filter(F.col("route_id").isNotNull())
    counts = known.groupBy("route_id").agg(F.count("*").alias("trips"))
    full = written(
        counts.join(table, "route_id").filter(F.col("operator").isNotNull())
        .withColumn("occupancy", occupancy(F.col("trips"), F.col("capacity"))),
        "occupancies",
    )
    leaders = full.filter(F.col("occupancy") == F.lit(full.agg(F.max("occupancy")).first()[0]))
    if leaders.count() <= 1:
        return leaders.select("operator", "route_id", "occupancy")
    tied = join_by_key(known, leaders.select("route_id"), ["route_id"], "left_semi", order)
    return q15_from(trip_counts(tied, "route_id", order), leaders.select("route_id", "operator", "capacity"))


def operator_peaks(route_trips: DataFrame, table: DataFrame) -> DataFrame:
    """Per operator the fullest of its routes; on a tie the one that got there first."""
    full = occupancy(F.col("trips"), F.col("capacity"))
    rows = route_trips.join(table, "route_id").filter(F.col("operator").isNotNull()).select(
        "operator",
        "route_id",
        full.alias("occupancy"),
        (-full).alias("emptiness"),
        # a route without seats is infinitely full from its first trip on
        F.when(F.col("capacity") == 0, F.col("first_at")).otherwise(F.col("last_at")).alias("reached_at"),
    )
    return least_per(rows, "operator", "emptiness", "reached_at").drop("emptiness")


def q15_from(route_trips: DataFrame, table: DataFrame) -> DataFrame:
    """The operator of the fullest single route."""
    top = best(operator_peaks(route_trips, table), F.desc("occupancy"), F.asc("reached_at"))
    return top.select("operator", "route_id", "occupancy")


def q16_top_passenger(trips: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    return q16_from(leading_counts(trips, ["passenger_name"], order))


def q16_from(passenger_trips: DataFrame) -> DataFrame:
    """Most trips; on a tie the passenger who reached the number first."""
    top = best(passenger_trips, F.desc("trips"), F.asc("last_at"), F.asc("passenger_name"))
    return top.select("passenger_name", "trips")
