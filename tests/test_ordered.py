"""Hot keys: the sliced form of each ordered operator gives what the plain form gives."""

import pytest
from logs import random_logs, route, routes_df, trip, trips_df
from pyspark.sql import functions as F

from wayfare.operators.changelog import lookup_asof, lookup_current, route_table, trip_count_changelog
from wayfare.operators.folds import joined_names, keyed_fold
from wayfare.operators.ordered import (
    hot_keys, row_count, running, running_count, running_last, running_max, running_sum, slice_number, sliced, split,
    task_number,
)
from wayfare.operators.tables import upsert, with_new_ids
from wayfare.operators.windows import late_events, on_time, with_update_time
from wayfare.plans import answers as A

FEW = 25


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left = sorted(map(str, a.select(*columns).collect()))
    assert left and left == sorted(map(str, b.select(*columns).collect()))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module", params=[0, 1])
def logs(spark, request):
    t, r = random_logs(request.param, n_trips=600, n_versions=40)
    return trips_df(spark, t).cache(), routes_df(spark, r).cache()


def test_hot_keys_are_set_apart(logs):
    trips, _ = logs
    hot = hot_keys(trips, ["route_id"], 200)
    assert hot.count() == 1
    for limits in ({}, {"broadcast_bytes": 0, "rows_per_salt": FEW}):
        moderate, large = split(trips, ["route_id"], hot, ["event_id"], **limits)
        assert large.count() == row_count(hot) > 200 and moderate.count() + large.count() == 600
        assert large.columns == moderate.columns == trips.columns
        hot_id = hot.first().route_id
        assert moderate.filter(F.col("route_id") == hot_id).isEmpty()
    assert hot_keys(trips, ["route_id"], 600) is None


def test_running_values(logs):
    trips, _ = logs
    columns = {
        "n": running_count(),
        "buses": running_count(F.col("transport_type") == "Bus"),
        "total": running_sum(F.col("event_id")),
        "top": running_max(F.col("passenger_name")),
        "last_bus": running_last(F.when(F.col("transport_type") == "Bus", F.col("event_id"))),
    }
    for keys in (["route_id"], ["route_id", "transport_type"], []):
        same(running(trips, keys, ["event_id"], columns, FEW), running(trips, keys, ["event_id"], columns))


def test_changelog_and_lookups(logs):
    trips, routes = logs
    same(trip_count_changelog(trips, rows_per_task=FEW), trip_count_changelog(trips))
    fields = ["type", "operator", "capacity"]
    keep = ["passenger_name"]
    same(lookup_asof(trips, routes, fields, keep, FEW), lookup_asof(trips, routes, fields, keep))
    same(A.q12_least_occupied_route_asof(trips, routes, FEW), A.q12_least_occupied_route_asof(trips, routes))


def test_lookup_current_without_broadcast(logs):
    trips, routes = logs
    table = route_table(routes).select("route_id", "type", "capacity")
    salted = lookup_current(trips, table, "route_id", broadcast_bytes=0, rows_per_salt=FEW)
    same(salted, lookup_current(trips, table, "route_id"))
    assert "strategy=broadcast" not in optimized(salted) and "salt" in optimized(salted)
    assert "strategy=broadcast" in optimized(lookup_current(trips, table, "route_id"))


def test_long_lists_of_names_go_on_in_further_parts(logs):
    trips, _ = logs
    whole = {r[0]: r[2] for r in joined_names(trips, "route_id", "passenger_name").collect()}
    parts = joined_names(trips, "route_id", "passenger_name", names_per_part=10, rows_per_task=FEW).collect()
    joined = {}
    for route_id, part, names in sorted(parts):
        assert len(names.split(", ")) <= 10
        joined.setdefault(route_id, []).append(names)
        assert part == len(joined[route_id]) - 1
    assert {k: ", ".join(v) for k, v in joined.items()} == whole


@pytest.mark.parametrize("rows, per_slice, parallel, want", [
    (0, 10, 8, 1), (5, 10, 8, 4), (25, 10, 8, 8), (25, 10, 2, 3), (10**12, 4_000_000, 4000, 250_000),
    (10**12, 4_000_000, 500_000, 500_000), (10**10, 4_000_000, 400, 2500),
])
def test_slice_number(rows, per_slice, parallel, want):
    assert slice_number(rows, per_slice, parallel) == want


@pytest.mark.parametrize("slices, rows, parallel, want", [
    (100_000, 6_000_000, 24, 24), (600_000, 36_000_000, 24, 144), (3, 25, 2, 2), (2500, 10**10, 400, 2500), (4, 5, 8, 4),
])
def test_tasks_follow_the_rows_and_not_the_limit(slices, rows, parallel, want):
    assert task_number(slices, rows, parallel) == want


def test_small_slices_share_tasks(spark):
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = spark.range(1_000).select((F.col("id") % 3).alias("key"), F.xxhash64("id").alias("at"), "id")
    rows = sliced(log, ["key"], ["at"], 1_000, 7)
    assert len(rows.inputFiles()) <= parallel
    found = rows.collect()
    assert sorted(r.id for r in found) == list(range(1_000))
    slices = {}
    for r in found:
        slices.setdefault(r.slice, []).append((r.key, r.at))
    assert max(map(len, slices.values())) == 7 and len(slices) <= 1_000 / 7 + parallel
    in_order = [x for _, places in sorted(slices.items()) for x in sorted(places)]
    assert in_order == sorted(in_order)


def test_keyed_fold_in_order(logs):
    trips, _ = logs
    text = dict(
        key="route_id", order=["event_id"], value=F.col("passenger_name"), init=F.lit(""),
        step=lambda acc, x: F.concat(acc, x, F.lit(";")), merge=lambda a, b: F.concat(a, b),
    )
    same(keyed_fold(trips, **text, rows_per_fold=FEW), keyed_fold(trips, **text))
    want = {}
    for r in sorted(trips.collect(), key=lambda r: r.event_id):
        want[r.route_id] = want.get(r.route_id, "") + r.passenger_name + ";"
    assert dict(keyed_fold(trips, **text).collect()) == want


def late_log():
    return [trip(0, 1, minute=10), trip(1, 1, minute=65), trip(2, 1, minute=50), trip(3, 2, minute=50)]


def test_late_record(spark):
    trips = trips_df(spark, late_log())
    partition = F.col("route_id") % 5
    flags = {r.event_id: r.late for r in late_events(trips, partition).collect()}
    assert flags == {0: False, 1: False, 2: True, 3: False}
    assert sorted(r.event_id for r in on_time(trips, partition).collect()) == [0, 1, 3]
    assert late_events(trips, partition).columns[-2:] == ["stream_time", "late"]


def test_late_records_of_a_hot_partition(logs):
    trips, _ = logs
    shuffled = trips.withColumn("event_id", F.xxhash64("event_id"))
    partition = F.col("route_id") % 5
    same(late_events(shuffled, partition, rows_per_task=FEW), late_events(shuffled, partition))


def test_update_time_is_the_latest_so_far(spark, logs):
    trips = trips_df(spark, late_log())
    times = {r.event_id: r.update_ts for r in with_update_time(trips).collect()}
    assert times[2] == times[1] == trip(1, 1, minute=65)[5] and times[3] == trip(3, 2, minute=50)[5]
    shuffled = logs[0].withColumn("event_id", F.xxhash64("event_id"))
    same(with_update_time(shuffled, rows_per_task=FEW), with_update_time(shuffled))


def test_new_ids_have_no_gaps(spark, logs):
    trips, _ = logs
    base = spark.createDataFrame([(7, "x")], "id LONG, name STRING")
    changes = trips.select(F.lit(None).cast("long").alias("id"), F.col("passenger_name").alias("name"), "event_id")
    numbered = with_new_ids(base, changes, "id", ["event_id"], rows_per_task=FEW)
    same(numbered, with_new_ids(base, changes, "id", ["event_id"]))
    assert [r.id for r in numbered.orderBy("event_id").collect()] == list(range(8, 608))


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id LONG, name STRING")
    changes = spark.createDataFrame([(2, "late", 9), (2, "early", 3), (5, "new", 1)], "id LONG, name STRING, at LONG")
    assert sorted(map(tuple, upsert(base, changes, ["id"], ["at"]).collect())) == [(1, "a"), (2, "late"), (5, "new")]


def test_route_table_keeps_the_latest_version(spark):
    routes = routes_df(spark, [route(0, 1, 4), route(2, 1, 6), route(1, 1, 5)])
    assert [r.capacity for r in route_table(routes).collect()] == [6]
