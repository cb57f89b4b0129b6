"""Running values along a stream, as exact as along a table.

What a running value has reached is kept per key; a batch goes on from there, with the same windows and
slices as a batch query uses. So every single update of a count or a maximum is seen, and where batches end
makes no difference. Batches must come in the order of the log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.ratios import occupancy
from wayfare.functions.text import known_type
from wayfare.operators.changelog import JOINED_ORDER, joined_totals, refreshed_occupancy
from wayfare.operators.extremes import least_per
from wayfare.operators.joins import join_by_key
from wayfare.operators.ordered import ROWS_PER_TASK, Running, running, running_count, running_max
from wayfare.operators.rollups import ARRIVAL
from wayfare.operators.windows import by_source_partition, hourly_type_counts, is_late
from wayfare.session import scratch
from wayfare.streaming.flows import Flows, Handler
from wayfare.streaming.keyed import KeyedTable


def carried(
    batch: DataFrame, before: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Running],
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """(rows, after): ``batch`` with running values that go on from ``before``, and where they end per key.

    ``before`` has the keys and a column per value, and so has ``after``, for the keys of the batch only.
    """
    known = before.select(*keys, *[F.col(name).alias(f"{name}_before") for name in columns])
    local = running(batch, keys, order, columns, rows_per_task)
    totals = batch.groupBy(*keys).agg(*[c.total(order).alias(name) for name, c in columns.items()])
    combined = [c.combine(F.col(f"{name}_before"), F.col(name)).alias(name) for name, c in columns.items()]
    rows = join_by_key(local, known, keys, "left", order).select(*batch.columns, *combined)
    return rows, totals.join(known, list(keys), "left").select(*keys, *combined)


def follow(
    log: DataFrame, root: str, name: str, keys: Sequence[str], order: Sequence[str],
    columns: Mapping[str, tuple[Running, T.DataType]], then: Handler, trigger: Mapping[str, object],
    rows_per_task: int = ROWS_PER_TASK,
) -> None:
    """Run the stream ``log`` to its end; ``then`` sees each batch with its running values.

    ``then`` must replace what it did for a batch that is run again. ``order`` is unique within a key.
    """
    schema = T.StructType([log.schema[k] for k in keys] + [T.StructField(n, t) for n, (_, t) in columns.items()])
    state = KeyedTable(f"{root}/tables/{name}", schema, keys)
    values = {n: value for n, (value, _) in columns.items()}

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist()
        with scratch(session):
            rows, after = carried(batch, state.read(session, before=batch_id), keys, order, values, rows_per_task)
            then(rows, batch_id)
            state.write(after, batch_id)
        batch.unpersist()

    stream = log.writeStream.queryName(name).option("checkpointLocation", f"{root}/checkpoints/{name}")
    stream.foreachBatch(handle).trigger(**trigger).start().awaitTermination()


def counted_trips(flows: Flows, then: Handler, rows_per_task: int = ROWS_PER_TASK) -> None:
    """Every trip with the number of trips of its route so far, batch by batch."""
    log = flows.trips.filter(F.col("route_id").isNotNull()).select("event_id", "ts", "route_id")
    count = {"trips_so_far": (running_count(), T.LongType())}
    follow(log, flows.root, "counted_trips", ["route_id"], list(ARRIVAL), count, then, flows.trigger, rows_per_task)


def trip_count_updates(flows: Flows, rows_per_task: int = ROWS_PER_TASK) -> KeyedTable:
    """The changelog of trip counts as a log of its own: (event_id, ts, route_id, trips_so_far)."""
    schema = T.StructType(
        [flows.trips.schema[c] for c in ("event_id", "ts", "route_id")] + [T.StructField("trips_so_far", T.LongType())]
    )
    log = KeyedTable(f"{flows.root}/tables/trip_updates", schema, ())
    counted_trips(flows, log.write, rows_per_task)
    return log


def least_occupied_changelog(flows: Flows, rows_per_task: int = ROWS_PER_TASK) -> KeyedTable:
    """The least occupancy per route type that any single update showed: (type, occupancy, at, route_id).

    Every trip is an update and looks up the route version known when its batch came; one without is
    dropped for good. Within a batch the version of a route is one, and occupancy grows, so that the first
    update of a route is the least of the batch.
    """
    schema = T.StructType().add("type", "string").add("occupancy", "double").add("at", "long").add("route_id", "long")
    table = KeyedTable(f"{flows.root}/tables/least_occupied_changelog", schema, ["type"])

    def fold(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        firsts = rows.groupBy("route_id").agg(F.min("trips_so_far").alias("trips"), F.min("event_id").alias("at"))
        updates = firsts.join(flows.read("route_latest", session), "route_id").select(
            known_type(F.col("type")).alias("type"),
            occupancy(F.col("trips"), F.col("capacity")).alias("occupancy"),
            "at",
            "route_id",
        )
        known = table.read(session, before=batch_id)
        table.write(least_per(known.unionByName(updates), "type", "occupancy", "at"), batch_id)

    counted_trips(flows, fold, rows_per_task)
    return table


def occupancy_updates(
    log: DataFrame, root: str, trigger: Mapping[str, object], rows_per_task: int = ROWS_PER_TASK
) -> KeyedTable:
    """The changelog of the join of trip and seat totals from a stream of :func:`seat_and_trip_log`, as a log."""
    counters = {name: (value, T.LongType()) for name, value in joined_totals().items()}
    refreshed = refreshed_occupancy(log.select("*", *[F.lit(0).cast("bigint").alias(name) for name in counters]))
    table = KeyedTable(f"{root}/tables/occupancy_updates", refreshed.schema, ())

    def write(rows: DataFrame, batch_id: int) -> None:
        table.write(refreshed_occupancy(rows), batch_id)

    follow(log, root, "joined_totals", ["route_id"], JOINED_ORDER, counters, write, trigger, rows_per_task)
    return table


def hourly_on_time_counts(
    log: DataFrame, root: str, source_partition: Column, order: Sequence[str], trigger: Mapping[str, object],
    rows_per_task: int = ROWS_PER_TASK,
) -> KeyedTable:
    """Trips per hour and type without grace: a trip counts only if its hour had not closed when it came.

    An hour closes by the stream time of the trip's log partition, which is the greatest time it has seen,
    kept from batch to batch. A watermark, which moves between batches, would close hours later.
    """
    keyed = by_source_partition(log, source_partition)
    places = hourly_type_counts(log, order).schema
    table = KeyedTable(f"{root}/tables/on_time_hours", places, ["window_start", "transport_type"])

    def count(rows: DataFrame, batch_id: int) -> None:
        accepted = rows.withColumn("late", is_late()).filter("NOT late")
        keys = table.keys
        counts = hourly_type_counts(accepted, order)
        known = table.read(rows.sparkSession, before=batch_id).join(counts.select(*keys), keys, "left_semi")
        table.write(known.unionByName(counts).groupBy(*keys).agg(
            F.sum("trips").alias("trips"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
        ), batch_id)

    time = {"stream_time": (running_max(F.col("ts")), log.schema["ts"].dataType)}
    follow(
        keyed, root, "stream_time", ["_none", "_partition"], order, time, count, trigger, rows_per_task
    )
    return table
