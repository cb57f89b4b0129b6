"""The log of running counts, and look-ups of routes from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.functions.ratios import occupancy_percent
from wayfare.operators.joins import BROADCAST_BYTES, join_by_key, measured_bytes
from wayfare.operators.ordered import ROWS_PER_TASK, Running, running, running_count, running_last, running_sum
from wayfare.operators.rollups import ARRIVAL
from wayfare.operators.tables import REMOVED, latest_per_key, versions_only
from wayfare.session import written


def trip_count_changelog(
    trips: DataFrame, key: str = "route_id", order: Sequence[str] = ARRIVAL, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every trip with the number of trips of its key so far."""
    keyed = trips.filter(F.col(key).isNotNull())
    return running(keyed, [key], order, {"trips_so_far": running_count()}, rows_per_task)


def route_table(routes: DataFrame, *fields: str) -> DataFrame:
    """The latest version of each route: all of it, or the given fields beside the id, which alone are then read.

    A log with a column ``removed`` has removals among its versions; a route whose last record is one is not
    in the table.
    """
    removed = REMOVED if REMOVED in routes.columns else None
    if not fields:
        return latest_per_key(routes, ["route_id"], ["seq"], removed)
    versions = routes.select("route_id", "seq", *fields, *([REMOVED] if removed else []))
    return latest_per_key(versions, ["route_id"], ["seq"], removed).drop("seq")


def seat_and_trip_log(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Both logs as one, in which each record adds a trip or seats to its route: (route_id, ts, kind, place, seats).

    At equal times a route version comes before a trip.
    """
    added = versions_only(routes).filter(F.col("route_id").isNotNull()).select(
        "route_id", F.col("effective_ts").alias("ts"), F.lit(0).alias("kind"), F.col("seq").alias("place"),
        F.coalesce("capacity", F.lit(0)).cast("bigint").alias("seats"),
    )
    made = trips.filter(F.col("route_id").isNotNull()).select(
        "route_id", "ts", F.lit(1).alias("kind"), F.col("event_id").alias("place"), F.lit(0).cast("bigint").alias("seats"),
    )
    return added.unionByName(made)


# what seat_and_trip_log is ordered by
JOINED_ORDER = ["ts", "kind", "place"]


def joined_totals() -> dict[str, Running]:
    """The totals of a route that each record of :func:`seat_and_trip_log` goes into."""
    return {
        "passengers": running_count(F.col("kind") == 1),
        "seats_so_far": running_sum(F.col("seats")),
        "versions": running_count(F.col("kind") == 0),
    }


def refreshed_occupancy(totals: DataFrame) -> DataFrame:
    """The join of trip and seat totals, a row per record on either side that refreshes it; none before both exist."""
    joined = totals.filter("passengers > 0 AND versions > 0").select(
        "route_id", "ts", "kind", "place", "passengers", F.col("seats_so_far").alias("seats")
    )
    return joined.withColumn("occupancy_pct", occupancy_percent(F.col("passengers"), F.col("seats")))


def occupancy_changelog(trips: DataFrame, routes: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every update of the occupancy per route, which a trip and a route version alike cause."""
    log = seat_and_trip_log(trips, routes)
    return refreshed_occupancy(running(log, ["route_id"], JOINED_ORDER, joined_totals(), rows_per_task))


def lookup_current(
    rows: DataFrame, dimension: DataFrame, key: str, spread_by: Sequence[str] = ARRIVAL, **limits: int
) -> DataFrame:
    """Each row with the latest row of its key; rows whose key is unknown are dropped."""
    return join_by_key(rows, dimension, [key], "inner", spread_by, **limits)


def with_route_as_of(
    trips: DataFrame,
    routes: DataFrame,
    fields: Sequence[str],
    keep: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Trips in event time, each with its running count and the route version valid at that time.

    Both logs are merged per route; at equal times a route comes before a trip, and a later
    version after an earlier one. The version is null for a trip before the first one.
    ``fields`` of the version and ``keep`` of the trip's own columns are passed through.
    """
    def absent(df: DataFrame, names: Sequence[str]) -> list:
        return [F.lit(None).cast(df.schema[name].dataType).alias(name) for name in names]

    # the kind of a row: 0 for a route, 1 for a trip
    versions = routes.select(
        "route_id", F.col("effective_ts").alias("ts"), F.lit(0).alias("kind"), F.col("seq").alias("event_id"),
        F.struct("seq", *fields).alias("version"), *absent(trips, keep),
    )
    events = trips.filter(F.col("route_id").isNotNull()).select(
        "route_id", "ts", F.lit(1).alias("kind"), "event_id", *absent(versions, ["version"]), *keep,
    )
    merged = running(
        versions.unionByName(events),
        ["route_id"],
        ["ts", "kind", "event_id"],
        {"trips_so_far": running_count(F.col("kind") == 1), "valid": running_last(F.col("version"))},
        rows_per_task,
    )
    return merged.filter("kind = 1").select(
        "event_id", "ts", "route_id", *keep, "trips_so_far",
        *[F.col("valid")[name].alias(name) for name in ("seq", *fields)],
    )


def lookup_asof(
    trips: DataFrame,
    routes: DataFrame,
    fields: Sequence[str],
    keep: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """As :func:`with_route_as_of`, without the trips that no route version covers."""
    return with_route_as_of(trips, routes, fields, keep, rows_per_task).filter(F.col("seq").isNotNull())


def version_arrays(routes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(route_id, versions): the versions of a route in the order in which they become valid, as one array."""
    version = F.struct("effective_ts", "seq", *fields)
    return versions_only(routes).filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(
        F.sort_array(F.collect_list(version)).alias("versions")
    )


def starts_until(starts: Column, ts: Column) -> Column:
    """How many of the rising ``starts`` are not after ``ts``, by halving: as many steps as their number has bits."""
    bits = F.ceil(F.log2(F.size(starts) + 1)).cast("int") - 1

    def step(found: Column, bit: Column) -> Column:
        further = found + F.pow(F.lit(2), bit).cast("int")
        passes = (further <= F.size(starts)) & (F.get(starts, further - 1) <= ts)
        return F.when(passes, further).otherwise(found)

    return F.aggregate(F.sequence(bits, F.lit(0), F.lit(-1)), F.lit(0), step)


def first_updates_as_of(
    trips: DataFrame, routes: DataFrame, fields: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """The first trip under each version of a route: (route_id, trips_so_far, place, and ``fields`` of the version).

    ``place`` rises with (ts, event_id). Each trip finds its version in the array of its route, trips are counted
    by hash per version, and what came before a version is a running sum over versions. So no trip is sorted.
    None if the arrays measure more than may be broadcast.
    """
    arrays = written(version_arrays(routes, fields), "versions")
    if measured_bytes(arrays) > broadcast_bytes:
        return None
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    # one number for both, as a struct would make the aggregate a sort
    place = micros.cast("decimal(38,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col("event_id")
    starts = arrays.select("route_id", F.col("versions.effective_ts").alias("starts"))
    counts = (
        trips.join(F.broadcast(starts), "route_id")
        .select("route_id", starts_until(F.col("starts"), F.col("ts")).alias("version"), place.alias("place"))
        .groupBy("route_id", "version").agg(F.count("*").alias("trips"), F.min("place").alias("place"))
    )
    earlier = W.partitionBy("route_id").orderBy("version").rowsBetween(W.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum("trips").over(earlier), F.lit(0)) + 1
    valid = F.element_at("versions", F.col("version"))
    return (
        counts.withColumn("trips_so_far", so_far).filter("version > 0").join(F.broadcast(arrays), "route_id")
        .select("route_id", "trips_so_far", "place", *[valid[f].alias(f) for f in fields])
    )
