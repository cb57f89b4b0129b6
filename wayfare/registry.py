"""Every query by name, over the given tables. The names are also those of ``oracle.SQL``."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.ratios import occupancy
from wayfare.functions.text import occupancy_text, parse_occupancy_text
from wayfare.operators import results as R
from wayfare.operators.changelog import (
    JOINED_ORDER, lookup_asof, lookup_current, occupancy_changelog, route_table, seat_and_trip_log, trip_count_changelog,
)
from wayfare.operators.folds import keyed_fold
from wayfare.operators.joins import join_by_key
from wayfare.operators.ordered import running, running_sum
from wayfare.operators.rollups import avg_per_group, regrouped, trip_counts
from wayfare.operators.tables import checked, latest_per_key, upsert, with_new_ids
from wayfare.operators.windows import (
    hourly_route_counts, hourly_type_counts, hourly_type_occupancy, late_events, on_time, with_update_time,
)
from wayfare.plans import answers as A
from wayfare.plans.report import all_answers, result_table_rows
from wayfare.schemas import OPERATORS, TRANSPORT_TYPES
from wayfare.session import shared_path, stream_session, written
from wayfare.sources import dimensions, json_log, tables
from wayfare.sources.polls import Polls
from wayfare.sources.results import results_scan, write_result_tables
from wayfare.streaming import carried, flows
from wayfare.streaming.taps import stream_taps, tapped

Query = Callable[[SparkSession, str], DataFrame]

LOOKED_UP_SUPPLIER = 7
LOOKED_UP_ROUTE = 42


def _trips(answer: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf: answer(tables.trips(spark, sf), *args, **options)


def _routes(answer: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: answer(tables.routes(spark, sf))


def _both(answer: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf: answer(tables.trips(spark, sf), tables.routes(spark, sf), **options)


def _shipments(answer: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf: answer(tables.shipment_log(spark, sf), order=tables.SHIPMENT_ORDER, **options)


def all_result_rows(spark: SparkSession, sf: str) -> DataFrame:
    return result_table_rows(all_answers(tables.trips(spark, sf), tables.routes(spark, sf)))


def _results_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "results")
    write_result_tables(all_result_rows(spark, sf), path)
    return results_scan(spark, path)


def _result_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return R.result_envelope(R.result_rows(A.q05_seats_per_route(tables.routes(spark, sf)), 5), 5)


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    encoded = json_log.encode_trips(tables.trips(spark, sf), keep=["event_id", "ts"])
    return json_log.decode_trips(encoded.drop("key")).select(*_TRIP_COLUMNS)


def _decoded_log(spark: SparkSession, sf: str) -> DataFrame:
    """A log that holds a tombstone and a record that is not JSON beside each event; only events are trips."""
    encoded = json_log.encode_trips(tables.trips(spark, sf), keep=["event_id", "ts"])
    value = F.explode(F.array("value", F.lit(None), F.concat(F.lit("{bad"), F.col("value"))))
    log = encoded.select("event_id", "ts", value.alias("value"))
    good, _ = json_log.split_bad(json_log.decode_trips(log, mode="PERMISSIVE"))
    return good.select(*_TRIP_COLUMNS)


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    return json_log.encode_routes(tables.routes(spark, sf), keep=["seq"])


_TRIP_COLUMNS = ["event_id", "ts", "route_id", "passenger_name", "origin", "destination", "transport_type"]


def _route_table(spark: SparkSession, sf: str) -> DataFrame:
    """From the JSON log, whose text key becomes the numeric key of the table."""
    log = json_log.encode_routes(tables.routes(spark, sf), keep=["seq"])
    decoded = json_log.decode_routes(log).withColumn("route_id", F.col("key").cast("bigint")).drop("key")
    return route_table(decoded)


def _with_removals(answer: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: answer(tables.trips(spark, sf), tables.routes_with_removals(spark, sf))


def _upsert_removals(spark: SparkSession, sf: str) -> DataFrame:
    """The first half of the route log as the table, and the rest of it, removals too, put over it."""
    log = tables.routes_with_removals(spark, sf)
    columns = ["route_id", "type", "operator", "capacity"]
    half = F.col("seq") % 4 < 2
    return upsert(route_table(log.filter(half), *columns[1:]), log.filter(~half), ["route_id"], ["seq"])


def _avg_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return avg_per_group(tables.table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")


def _lookup_current(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    updates = trip_count_changelog(tables.trips(spark, sf).select("event_id", "route_id"))
    table = route_table(tables.routes(spark, sf), "type", "operator", "capacity")
    looked_up = lookup_current(updates, table, "route_id", **limits)
    return looked_up.withColumn("occupancy", occupancy(F.col("trips_so_far"), F.col("capacity")))


def _lookup_asof(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    fields = ["type", "operator", "capacity"]
    found = lookup_asof(tables.trips(spark, sf), tables.routes(spark, sf), fields, **limits)
    return found.select("event_id", "route_id", "trips_so_far", "seq", "type", "operator", "capacity")


def _changelog(trips: DataFrame, **options) -> DataFrame:
    return trip_count_changelog(trips.select("event_id", "ts", "route_id"), **options)


def _hourly_type_occupancy(trips: DataFrame, routes: DataFrame) -> DataFrame:
    hours = hourly_type_occupancy(hourly_route_counts(trips), route_table(routes, "type", "capacity"))
    return hours.select(
        "window_start", "type", F.round("occupancy", 6).alias("occupancy"), "updates", "first_occupancy"
    )


def _late_events(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    log = tables.trips(spark, sf).select("event_id", "ts", "route_id", "transport_type")
    return late_events(log, tables.source_partition(F.col("route_id")), **limits)


def _late_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments arrive by order number, hence out of time order: most windows have closed before."""
    log, arrival = _shipments_by_arrival(spark, sf)
    flagged = late_events(log.drop("transport_type"), tables.source_partition(F.col("route_id")), order=arrival)
    return flagged.select("ts", "source_partition", *arrival, "stream_time", "late")


def _shipments_by_arrival(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    arrival = [c for c in tables.SHIPMENT_ORDER if c != "ts"]
    return tables.shipment_log(spark, sf).select("ts", "route_id", "transport_type", *arrival), arrival


def _hourly_on_time_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts without grace: shipments that arrive after their hour has closed do not count."""
    log, arrival = _shipments_by_arrival(spark, sf)
    accepted = on_time(log, tables.source_partition(F.col("route_id")), order=arrival)
    return hourly_type_counts(accepted, arrival).select("window_start", "transport_type", "trips")


def _update_times(spark: SparkSession, sf: str) -> DataFrame:
    log, arrival = _shipments_by_arrival(spark, sf)
    return with_update_time(log, order=arrival).select("route_id", *arrival, "ts", "update_ts")


def _keyed_fold(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    """Per route: trips, first passenger and last passenger, as one fold in log order."""
    def state(trips, first, last):
        return F.struct(trips.alias("trips"), first.alias("first_passenger"), last.alias("last_passenger"))

    none = F.lit(None).cast("string")
    folded = keyed_fold(
        tables.trips(spark, sf), "route_id", ["event_id"], F.col("passenger_name"),
        init=state(F.lit(0).cast("bigint"), none, none),
        step=lambda acc, name: state(acc["trips"] + 1, F.coalesce(acc["first_passenger"], name), name),
        merge=lambda a, b: state(
            a["trips"] + b["trips"],
            F.coalesce(a["first_passenger"], b["first_passenger"]),
            F.coalesce(b["last_passenger"], a["last_passenger"]),
        ),
        **limits,
    )
    return folded.select("route_id", "state.*")


def _keyed_fold_without_merge(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    """Per route the difference of each event's number and all before, a step whose order cannot be split up."""
    folded = keyed_fold(
        tables.trips(spark, sf).select("route_id", "event_id"), "route_id", ["event_id"], F.col("event_id"),
        init=F.lit(0).cast("bigint"), step=lambda acc, number: number - acc, **limits,
    )
    return folded.select("route_id", F.col("state").alias("difference"))


def _decoded_strict(spark: SparkSession, sf: str) -> DataFrame:
    """A log in which the records of errors have two fields too many; these are set apart with their names."""
    encoded = json_log.encode_trips(tables.trips(spark, sf), keep=["event_id", "transport_type"]).drop("key")
    longer = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(',"delay":1,"note":{"a":2}}'))
    value = F.when(F.col("transport_type") == "error", longer).otherwise(F.col("value"))
    decoded = json_log.decode_trips(
        encoded.select("event_id", value.alias("value")), mode="PERMISSIVE", unknown="refuse"
    )
    return decoded.select(
        "event_id", "route_id", "transport_type", F.col("bad_record").isNotNull().alias("refused"),
        F.array_join("unknown_fields", ", ").alias("unknown_fields"),
    )


def _polled_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """What a second bulk read of the suppliers shows: some renamed, some added, some gone."""
    first = tables.suppliers(spark, sf)
    polls = Polls(shared_path(spark, "polls"), first.schema, ["id"])
    polls.poll(first, 0)
    changes = with_new_ids(first, tables.supplier_changes(spark, sf), "id", ["position"])
    second = upsert(first, changes, ["id"], ["position"]).filter(F.col("id") % 10 != 0)
    return polls.poll(second, 1)


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers tapped from a batch job and from three streams while they ran, a row each."""
    trips, observation = tapped(
        tables.trips(spark, sf), "trips", {"rows_in": F.count("*"), "last_at": F.max("event_id")}
    )
    trips.write.format("noop").mode("overwrite").save()
    rows = [("trips", observation.get["rows_in"], observation.get["last_at"])]
    log = flows.flows_over(spark, sf)
    with stream_taps(log.spark) as taps:
        for query in [log.start(name) for name in ("type_trips", "route_trips", "route_latest")]:
            taps.wait_for(query)
            rows.append((query.name, taps.total(query.name, "rows_in"), None))
    return spark.createDataFrame(rows, "name STRING, rows_in LONG, last_at LONG")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    counts = trip_counts(tables.trips(spark, sf), "route_id").select("route_id", "trips")
    rows = counts.join(route_table(tables.routes(spark, sf), "type", "capacity"), "route_id")
    text = occupancy_text(F.col("route_id"), F.col("type"), occupancy(F.col("trips"), F.col("capacity")))
    return rows.select(parse_occupancy_text(text).alias("parsed")).select("parsed.*")


def _upsert_results(spark: SparkSession, sf: str) -> DataFrame:
    """The total as the existing table, and the running seat sum of every route update put over it."""
    routes = tables.routes(spark, sf)
    updates = running(routes, ["route_id"], ["seq"], {"seats": running_sum(F.col("capacity").cast("bigint"))})
    changes = updates.select(
        F.col("route_id").cast("string").alias("id"), F.col("seats").cast("string").alias("result"), "seq"
    )
    base = R.result_rows(A.q08_total_seats(routes), 8).select("id", "result")
    return upsert(base, changes, ["id"], ["seq"])


def _upsert_routes(spark: SparkSession, sf: str) -> DataFrame:
    base = route_table(tables.routes(spark, sf), "origin", "destination", "type", "operator", "capacity")
    changes = with_new_ids(base, tables.route_changes(spark, sf), "route_id", ["position"])
    return upsert(base, changes, ["route_id"], ["position"])


def _upsert_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    base = tables.suppliers(spark, sf)
    changes = with_new_ids(base, tables.supplier_changes(spark, sf), "id", ["position"])
    return upsert(base, changes, ["id"], ["position"])


def _validate_routes(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["route_id", "origin", "destination", "type", "operator", "capacity"]
    log = tables.routes(spark, sf).select(*columns).unionByName(tables.route_changes(spark, sf).select(*columns))
    return checked(log, {"type": TRANSPORT_TYPES, "operator": OPERATORS}, columns)


def _validate_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["id", "name", "type"]
    known = tables.suppliers(spark, sf).unionByName(tables.supplier_changes(spark, sf).select(*columns))
    segments = tables.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type")
    )
    return checked(known.unionByName(segments), {"type": TRANSPORT_TYPES}, ["name", "type"])


def _q06_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return A.q06_occupancy_per_route(tables.shipment_log(spark, sf), tables.parts_as_single_routes(spark, sf))


def _q15_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return A.q15_top_operator(
        tables.shipment_log(spark, sf), tables.parts_as_single_routes(spark, sf), order=tables.SHIPMENT_ORDER
    )


def _q16_shipments(spark: SparkSession, sf: str) -> DataFrame:
    # counted per order before the join, so that an order with many shipments joins as one row
    log, passengers = tables.shipment_log(spark, sf), tables.order_passengers(spark, sf)
    per_order = log.groupBy("order_key").agg(F.count("*").alias("trips")).join(passengers, "order_key")
    known = per_order.filter(F.col("passenger_name").isNotNull())
    counts = written(known.groupBy("passenger_name").agg(F.sum("trips").alias("trips")), "counts")
    leaders = counts.filter(F.col("trips") == F.lit(counts.agg(F.max("trips")).first()[0]))
    if leaders.count() <= 1:
        return leaders
    # who of several came first to the number; the place of a shipment has several columns
    orders = passengers.join(leaders.select("passenger_name"), "passenger_name")
    places = trip_counts(join_by_key(
        log, orders.select("order_key"), ["order_key"], "left_semi", tables.SHIPMENT_ORDER
    ), "order_key", tables.SHIPMENT_ORDER)
    return A.q16_from(regrouped(places.join(orders, "order_key"), "passenger_name"))


def _trip_count_updates(spark: SparkSession, sf: str, max_files: int, **limits: int) -> DataFrame:
    return carried.trip_count_updates(flows.flows_over(spark, sf, max_files=max_files), **limits).read(spark).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "route_id", "trips_so_far"
    )


def _least_occupied_changelog(spark: SparkSession, sf: str, max_files: int) -> DataFrame:
    """All routes first, then the trips in several batches, each trip an update."""
    log = flows.flows_over(spark, sf, max_files=max_files)
    log.run("route_latest")
    return carried.least_occupied_changelog(log).read(spark).select("type", "route_id", "occupancy")


def _stream_on_time_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments as a stream in the order of their arrival, in which most come after their hour has closed."""
    log, arrival = _shipments_by_arrival(spark, sf)
    path = shared_path(spark, "shipments")
    files = flows.write_log(log, path, arrival)
    session = stream_session(spark)
    stream = flows.file_stream(session, path, max_files=math.ceil(files / flows.BATCHES))
    table = carried.hourly_on_time_counts(
        stream, shared_path(spark, "streams"), tables.source_partition(F.col("route_id")), arrival, {"availableNow": True}
    )
    return table.read(spark).select("window_start", "transport_type", "trips")


def _stream_q06_changelog(spark: SparkSession, sf: str) -> DataFrame:
    """Both logs merged by time as one stream, in several batches."""
    log = seat_and_trip_log(tables.trips(spark, sf), tables.routes(spark, sf))
    path = shared_path(spark, "merged")
    files = flows.write_log(log, path, JOINED_ORDER)
    stream = flows.file_stream(stream_session(spark), path, max_files=math.ceil(files / flows.BATCHES))
    return carried.occupancy_updates(stream, shared_path(spark, "streams"), {"availableNow": True}).read(spark)


ANSWERS: dict[str, Query] = {
    "q04_passengers_per_route": _trips(A.q04_passengers_per_route),
    "q05_seats_per_route": _routes(A.q05_seats_per_route),
    "q06_occupancy_per_route": _both(A.q06_occupancy_per_route),
    "q07_total_passengers": _trips(A.q07_total_passengers),
    "q08_total_seats": _routes(A.q08_total_seats),
    "q09_total_occupancy": _both(A.q09_total_occupancy),
    "q10_avg_passengers_per_type": _trips(A.q10_avg_passengers_per_type),
    "q11_top_type": _trips(A.q11_top_type),
    "q12_least_occupied_route": _both(A.q12_least_occupied_route),
    "q12_least_occupied_route_changelog": _both(A.q12_least_occupied_route_changelog),
    "q12_least_occupied_route_asof": _both(A.q12_least_occupied_route_asof),
    "q13_top_hourly_type_all": _trips(A.q13_top_hourly_type, "all"),
    "q13_top_hourly_type_latest": _trips(A.q13_top_hourly_type, "latest"),
    "q14_least_occupied_type_all": _both(A.q14_least_occupied_type, scope="all"),
    "q14_least_occupied_type_latest": _both(A.q14_least_occupied_type, scope="latest"),
    "q14_least_occupied_type_changelog": _both(A.q14_least_occupied_type_changelog),
    "q15_top_operator": _both(A.q15_top_operator),
    "q16_top_passenger": _trips(A.q16_top_passenger),
    "q06_shipments": _q06_shipments,
    "q11_shipments": _shipments(A.q11_top_type),
    "q13_shipments": _shipments(A.q13_top_hourly_type),
    "q15_shipments": _q15_shipments,
    "q16_shipments": _q16_shipments,
}

OPERATOR_QUERIES: dict[str, Query] = {
    "trips_scan": lambda spark, sf: tables.trips(spark, sf).select(*_TRIP_COLUMNS),
    "routes_scan": lambda spark, sf: tables.routes(spark, sf),
    "decode_json_events": _decoded,
    "encode_json_events": _encoded,
    "supplier_snapshot": lambda spark, sf: dimensions.supplier_snapshot(tables.suppliers(spark, sf)),
    "capacity_snapshot": lambda spark, sf: dimensions.capacity_snapshot(tables.routes(spark, sf)),
    "list_suppliers": lambda spark, sf: dimensions.list_rows(tables.suppliers(spark, sf)),
    "list_routes": lambda spark, sf: dimensions.list_rows(route_table(tables.routes(spark, sf))),
    "lookup_supplier": lambda spark, sf: dimensions.lookup(tables.suppliers(spark, sf), "id", LOOKED_UP_SUPPLIER),
    "lookup_route": lambda spark, sf: dimensions.lookup(
        route_table(tables.routes(spark, sf)), "route_id", LOOKED_UP_ROUTE
    ),
    "results_scan": _results_scan,
    "result_rows": all_result_rows,
    "result_envelope": _result_envelope,
    "upsert_results": _upsert_results,
    "upsert_routes": _upsert_routes,
    "upsert_suppliers": _upsert_suppliers,
    "latest_per_key": lambda spark, sf: latest_per_key(
        tables.trips(spark, sf).select("passenger_name", "event_id", "ts", "route_id", "transport_type"),
        ["passenger_name"], ["event_id"],
    ),
    "route_table": _route_table,
    "route_table_with_removals": lambda spark, sf: route_table(tables.routes_with_removals(spark, sf)),
    "upsert_removals": _upsert_removals,
    "q12_least_occupied_route_with_removals": _with_removals(A.q12_least_occupied_route),
    "q15_top_operator_with_removals": _with_removals(A.q15_top_operator),
    "q06_changelog": _both(occupancy_changelog),
    "validate_routes": _validate_routes,
    "validate_suppliers": _validate_suppliers,
    "trip_counts": _trips(trip_counts, "route_id"),
    "avg_per_group": _avg_per_group,
    "trip_count_changelog": _trips(_changelog),
    "lookup_current": _lookup_current,
    "lookup_asof": _lookup_asof,
    "hourly_type_counts": _trips(hourly_type_counts),
    "hourly_type_occupancy": _both(_hourly_type_occupancy),
    "late_events": _late_events,
    "late_shipments": _late_shipments,
    "hourly_on_time_shipments": _hourly_on_time_shipments,
    "update_times": _update_times,
    "keyed_fold": _keyed_fold,
    "parse_occupancy_text": _parsed,
    "decode_json_strict": _decoded_strict,
    "poll_suppliers": _polled_suppliers,
}

# The same operators with limits so low that keys count as hot: sliced, salted, in chunks and in parts.
FEW = 60
SMALL_LIMITS: dict[str, Query] = {
    "q04_passengers_per_route_in_parts": _trips(A.q04_passengers_per_route, names_per_part=40, rows_per_task=FEW),
    "trip_count_changelog_sliced": _trips(_changelog, rows_per_task=FEW),
    "lookup_current_salted": partial(_lookup_current, broadcast_bytes=0, rows_per_salt=FEW),
    "q12_least_occupied_route_asof_sliced": _both(
        A.q12_least_occupied_route_asof, rows_per_task=FEW, broadcast_bytes=0
    ),
    "lookup_asof_sliced": partial(_lookup_asof, rows_per_task=FEW),
    "late_events_sliced": partial(_late_events, rows_per_task=10 * FEW),
    "keyed_fold_in_chunks": partial(_keyed_fold, rows_per_fold=7, rows_per_task=FEW),
    "keyed_fold_without_merge": partial(_keyed_fold_without_merge, rows_per_fold=30, rows_per_task=FEW),
    "decode_json_log": _decoded_log,
}

STREAMS: dict[str, Query] = {
    "stream_hourly_type_counts": flows.hourly_type_counts_of,
    "stream_closed_hours": flows.closed_hours_of,
    "stream_occupancy_per_route": flows.occupancy_per_route_of,
    "stream_top_type": flows.top_type_of,
    "stream_least_occupied_route": flows.least_occupied_route_of,
    "stream_least_occupied_updates": flows.least_occupied_updates_of,
    "stream_results": flows.results_of,
    "stream_results_with_removals": flows.removals_of,
    "observe_metrics": _observed,
}

# Streams that take the events in several batches.
BATCHED_STREAMS: dict[str, Query] = {
    "stream_occupancy_per_route_in_batches": flows.in_batches(flows.occupancy_per_route_of),
    "stream_top_type_in_batches": flows.in_batches(flows.top_type_of),
    "stream_hourly_type_counts_in_batches": flows.in_batches(flows.hourly_type_counts_of),
    "stream_trip_count_changelog": flows.in_batches(_trip_count_updates),
    "stream_trip_count_changelog_sliced": flows.in_batches(partial(_trip_count_updates, rows_per_task=FEW)),
    "stream_least_occupied_changelog": flows.in_batches(_least_occupied_changelog),
    "stream_hourly_on_time_shipments": _stream_on_time_shipments,
    "stream_q06_changelog": _stream_q06_changelog,
}

QUERIES: dict[str, Query] = {**ANSWERS, **OPERATOR_QUERIES, **SMALL_LIMITS, **STREAMS, **BATCHED_STREAMS}
