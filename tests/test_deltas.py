"""Running values carried along streams, publishing by change, removals, and what a round costs."""

import json
import random

import pytest
from logs import random_logs, route, routes_df, trip, trips_df
from pyspark.sql import functions as F
from test_streaming import Q, write_files

from wayfare.operators.changelog import (
    JOINED_ORDER, occupancy_changelog, route_table, seat_and_trip_log, trip_count_changelog,
)
from wayfare.operators.results import with_result_table
from wayfare.operators.tables import REMOVED, latest_per_key, upsert
from wayfare.operators.windows import hourly_type_counts, on_time
from wayfare.plans import answers as A
from wayfare.schemas import RESULT_TABLES, ROUTE
from wayfare.session import stream_session
from wayfare.sources.json_log import decode_route_changes, decode_routes, encode_routes
from wayfare.sources.tables import source_partition
from wayfare.streaming import carried
from wayfare.streaming.deltas import BUCKETS
from wayfare.streaming.flows import FLOWS, Flows, file_stream, publish, write_log
from wayfare.streaming.keyed import KeyedTable

NOW = {"availableNow": True}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def flows_on(spark, root, folder, files=1):
    session = stream_session(spark)
    trips = file_stream(session, f"{folder}/trips", files).withColumn("ts", F.col("ts").cast("timestamp"))
    return Flows(session, str(root), trips, file_stream(session, f"{folder}/routes", files))


# running values along streams

@pytest.mark.parametrize("cuts, limit", [(1, 1_000), (2, 1_000), (7, 1_000), (3, 20)])
def test_counts_do_not_depend_on_where_batches_end(spark, tmp_path, cuts, limit):
    t, r = random_logs(11, n_trips=150)
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t, f"{folder}/trips", cuts)
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run("route_latest")
    updates = carried.trip_count_updates(flows, rows_per_task=limit).read(spark)
    want = trip_count_changelog(trips_df(spark, t).select("event_id", "route_id"))
    assert rows_of(updates.select("event_id", "route_id", "trips_so_far")) == rows_of(want)

    again = flows_on(spark, tmp_path / "second", folder)
    again.run("route_latest")
    least = carried.least_occupied_changelog(again).read(spark).select("type", "route_id", "occupancy")
    batch = A.q12_least_occupied_route_changelog(trips_df(spark, t), routes_df(spark, r))
    assert rows_of(least) == rows_of(batch.select("type", "route_id", "occupancy"))


def test_a_batch_that_fails_is_counted_once(spark, tmp_path):
    t, r = random_logs(12, n_trips=90)
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t, f"{folder}/trips", 3)
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    seen = []

    def fail_on_second(rows, batch_id):
        seen.append(batch_id)
        if seen.count(1) == 1 and batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        carried.counted_trips(flows, fail_on_second)
    updates = carried.trip_count_updates(flows_on(spark, tmp_path / "state", folder)).read(spark)
    want = {x.event_id: x.trips_so_far for x in trip_count_changelog(trips_df(spark, t)).collect()}
    got = {x.event_id: x.trips_so_far for x in updates.collect()}
    # the first batch was handed to the failing handler; the rest goes on from its counts
    assert got and all(want[e] == n for e, n in got.items()) and max(got) == max(want)


@pytest.mark.parametrize("cuts", [1, 4, 9])
def test_hours_close_by_stream_time_wherever_batches_end(spark, tmp_path, cuts):
    rnd = random.Random(5)
    types = ["Bus", "Taxi", None]
    t = [trip(i, rnd.randint(1, 9), transport_type=rnd.choice(types), minute=i + rnd.randint(-200, 60)) for i in range(300)]
    path = str(tmp_path / "trips")
    write_files(spark, trips_df, t, path, cuts)
    stream = file_stream(stream_session(spark), path, 1)
    by = source_partition(F.col("route_id"))
    got = carried.hourly_on_time_counts(stream, str(tmp_path / "state"), by, ["event_id"], NOW).read(spark)
    want = hourly_type_counts(on_time(trips_df(spark, t), by))
    assert 0 < sum(x.trips for x in want.collect()) < 200
    assert rows_of(got.select(*want.columns)) == rows_of(want)


@pytest.mark.parametrize("cuts", [1, 5])
def test_the_join_of_totals_is_refreshed_by_either_side(spark, tmp_path, cuts):
    t, r = random_logs(13, n_trips=80)
    trips, routes = trips_df(spark, t), routes_df(spark, r)
    log = seat_and_trip_log(trips, routes)
    write_log(log, str(tmp_path / "log"), JOINED_ORDER, rows_per_file=-(-log.count() // cuts))
    stream = file_stream(stream_session(spark), str(tmp_path / "log"), 1)
    got = carried.occupancy_updates(stream, str(tmp_path / "state"), NOW).read(spark)
    want, expected, counts, seats = occupancy_changelog(trips, routes), [], {}, {}
    merged = [(x[6], 0, x[7], x[0], x[5]) for x in r] + [(x[5], 1, x[6], x[0], 0) for x in t]
    for ts, kind, place, key, added in sorted(merged):
        counts[key] = counts.get(key, 0) + kind
        if not kind:
            seats[key] = seats.get(key, 0) + added
        if counts[key] and key in seats:
            full = counts[key] / seats[key] * 100 if seats[key] else 0.0
            expected.append((key, ts, kind, place, counts[key], seats[key], full))
    assert rows_of(want) == rows_of(got) == sorted(expected, key=str)


def test_a_log_is_taken_in_its_order(spark, tmp_path):
    rows = [(i if i % 10 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "place LONG, n LONG").repartition(3)
    files = write_log(df, str(tmp_path / "log"), ["place"], rows_per_file=25)
    assert files == 8
    taken = []
    stream = file_stream(stream_session(spark), str(tmp_path / "log"), 1)
    stream.writeStream.foreachBatch(lambda b, i: taken.append([r.place for r in b.collect()])).trigger(**NOW).start(
    ).awaitTermination()
    assert len(taken) == 8
    places = [p for batch in taken for p in sorted(batch, key=lambda p: -1 if p is None else p)]
    assert places == [None] * 20 + [i for i in range(200) if i % 10]


# publishing by change

def published(trips, routes):
    return sorted(
        (tuple(r) for q, answer in Q.items() for r in with_result_table(answer(trips, routes), q).collect()), key=str
    )


def test_each_round_equals_the_batch_answers(spark, tmp_path):
    t, r = random_logs(21, n_trips=160)
    folder = str(tmp_path / "logs")
    ends = [(60, 10), (61, 10), (110, len(r))]
    done = 0, 0
    for version, (trips, versions) in enumerate(ends):
        if trips > done[0]:
            write_files(spark, trips_df, t[done[0]:trips], f"{folder}/trips", 1)
        if versions > done[1]:
            write_files(spark, routes_df, r[done[1]:versions], f"{folder}/routes", 1)
        done = trips, versions
        flows = flows_on(spark, tmp_path / "state", folder)
        flows.run(*FLOWS)
        got = rows_of(publish(flows, spark, version))
        assert got == published(trips_df(spark, t[:trips]), routes_df(spark, r[:versions])), version
    names = publish(flows, spark, len(ends))  # nothing has changed
    assert rows_of(names) == got


def test_lists_of_names_go_on_in_their_open_part(spark, tmp_path):
    t, r = random_logs(22, n_trips=130, n_routes=3)
    folder = str(tmp_path / "logs")
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    for version, (start, end) in enumerate([(0, 50), (50, 51), (51, 130)]):
        write_files(spark, trips_df, t[start:end], f"{folder}/trips", 1)
        flows = flows_on(spark, tmp_path / "state", folder)
        flows.run("passenger_rows")
        got = publish(flows, spark, version, queries=(4,), names_per_part=7, rows_per_task=20)
        want = A.q04_passengers_per_route(trips_df(spark, t[:end]), names_per_part=7)
        assert rows_of(got) == rows_of(with_result_table(want, 4))


def test_a_round_after_one_trip_writes_and_reads_little(spark, tmp_path):
    t = [trip(i, i % 400, f"P{i % 300}", minute=i // 10) for i in range(4_000)]
    r = [route(i, i, 5 + i % 40) for i in range(400)]
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t, f"{folder}/trips", 1)
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run(*FLOWS)
    publish(flows, spark, 0)
    write_files(spark, trips_df, [trip(4_000, 7, "P1", minute=400)], f"{folder}/trips", 1)
    again = flows_on(spark, tmp_path / "state", folder)
    again.run(*FLOWS)
    publish(again, spark, 1)
    changed = spark.read.parquet(str(tmp_path / "state/tables/results/changes/batch=1"))
    # a list of names, an occupancy, two totals, two winners at most, the fullest operator, the least hour
    assert 4 <= changed.count() <= 8
    for name in ("route_trips", "passenger_trips", "route_hours"):
        table = again.table(name)
        one = table.read(spark, only=spark.createDataFrame([(7,)], "route_id LONG").withColumn(
            "passenger_name", F.lit("P1")))
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert all("bucket" in line for line in plan.splitlines() if "PartitionFilters" in line)
        read = spark.read.option("basePath", table.path).parquet(f"{table.path}/changes/*")
        buckets = {x.bucket for x in read.select("bucket").distinct().collect()}
        assert len(buckets) == BUCKETS


# removals

def route_log(spark, rows):
    """Versions, and removals where a capacity is missing."""
    return routes_df(spark, rows).withColumn(REMOVED, F.col("capacity").isNull())


def removal(seq, route_id):
    return (route_id, None, None, None, None, None, route(seq, route_id, 1)[6], seq)


def test_removed_routes_leave_the_table_and_come_back(spark):
    log = route_log(spark, [route(0, 1, 4), route(1, 2, 6), removal(2, 1), removal(3, 3), removal(4, 2), route(5, 2, 9)])
    assert [(x.route_id, x.capacity) for x in route_table(log).collect()] == [(2, 9)]
    assert [tuple(x) for x in route_table(log, "capacity").collect()] == [(2, 9)]
    latest = latest_per_key(log, ["route_id"], ["seq"])
    assert sorted((x.route_id, x.removed) for x in latest.collect()) == [(1, True), (2, False), (3, True)]
    base = spark.createDataFrame([(1, 10), (2, 20)], "route_id LONG, capacity INT")
    changes = spark.createDataFrame(
        [(1, None, True, 0), (3, 30, False, 1), (3, None, True, 2), (4, 40, False, 3)],
        "route_id LONG, capacity INT, removed BOOLEAN, seq LONG",
    )
    assert rows_of(upsert(base, changes, ["route_id"], ["seq"])) == [(2, 20), (4, 40)]


def test_tombstones_are_skipped_kept_or_refused(spark):
    log = encode_routes(routes_df(spark, [route(0, 1, 4)]), keep=["seq"]).unionByName(
        spark.createDataFrame([(1, "1", None)], "seq LONG, key STRING, value STRING"))
    assert [x.seq for x in decode_routes(log).collect()] == [0]
    kept = decode_route_changes(log)
    assert sorted((x.seq, x.route_id, x.capacity, x.removed) for x in kept.collect()) == [
        (0, 1, 4, False), (1, 1, None, True)]
    with pytest.raises(Exception, match="without a value"):
        decode_routes(log, tombstones="refuse").collect()
    with pytest.raises(ValueError):
        decode_routes(log, tombstones="drop")


def test_results_are_taken_back_when_their_routes_go(spark, tmp_path):
    """The only route of a type, and then of all operators, is removed between rounds."""
    folder = str(tmp_path / "logs")
    steps = [
        [route(0, 1, 4, "Metro", "OperatorA"), route(1, 2, 2, "Bus", "OperatorB")],
        [removal(2, 2)], [removal(3, 1)], [route(4, 2, 8, "Bus", "OperatorC")],
    ]
    write_files(spark, trips_df, [trip(0, 1), trip(1, 2), trip(2, 1)], f"{folder}/trips", 1)
    sent, log = [], []
    for version, rows in enumerate(steps):
        write_files(spark, lambda s, x: route_log(s, x), rows, f"{folder}/routes", 1)
        log += rows
        flows = flows_on(spark, tmp_path / "state", folder)
        flows.run("route_trips", "route_latest", "route_hours")

        def send(envelopes, topic):
            sent.extend((version, topic, x.key, x.value and json.loads(x.value)["payload"]["result"])
                        for x in envelopes.collect())

        got = publish(flows, spark, version, queries=(12, 14, 15), send=send)
        trips, routes = trips_df(spark, [trip(0, 1), trip(1, 2), trip(2, 1)]), route_log(spark, log)
        want = [
            tuple(x) for q in (12, 14, 15) for x in with_result_table(Q[q](trips, routes), q).collect()
        ]
        assert rows_of(got) == sorted(want, key=str), version
    assert (1, RESULT_TABLES[12], "Bus", None) in sent and (2, RESULT_TABLES[12], "Metro", None) in sent
    assert {s[1] for s in sent if s[0] == 2} == {RESULT_TABLES[q] for q in (12, 14, 15)}


def test_a_table_forgets_removed_keys_in_snapshots(spark, tmp_path):
    schema = spark.createDataFrame([], "k LONG, n LONG, removed BOOLEAN").schema
    table = KeyedTable(str(tmp_path / "t"), schema, ["k"], snapshot_every=3, buckets=4)
    marks = []
    for batch, rows in enumerate([
        [(k, k, False) for k in range(10)], [(1, None, True), (2, 20, False)], [(3, None, True)], [(1, 11, False)],
        [(4, None, True)], [(5, 50, False)],
    ]):
        table.write(spark.createDataFrame(rows, schema), batch)
        marks.append({(x.k, x.n) for x in table.read(spark).collect()})
    assert marks[1] == {(k, k) for k in range(10) if k not in (1, 2)} | {(2, 20)}
    assert marks[-1] == {(0, 0), (1, 11), (2, 20), (5, 50), (6, 6), (7, 7), (8, 8), (9, 9)}
    assert table.last_batch(spark) == 5
    assert {(x.k, x.n, x.removed) for x in table.since(spark, 3).collect()} == {(4, None, True), (5, 50, False)}
    # what lies before the older snapshot is gone, so all rows count as changed
    assert table.since(spark, 0).count() == 8 or {x.k for x in table.since(spark, 0).collect()} == {1, 2, 3, 4, 5}
    only = spark.createDataFrame([(1,), (3,), (77,)], "k LONG")
    assert rows_of(table.read(spark, only=only)) == [(1, 11)]
    assert rows_of(table.read(spark, before=3, only=only)) == []


def test_seats_of_a_log_with_removals(spark):
    rows = [route(0, 1, 4), removal(1, 1), route(2, 1, 5)]
    log = route_log(spark, rows)
    assert [tuple(x) for x in A.q05_seats_per_route(log).collect()] == [(1, 9)]
    assert [tuple(x) for x in A.q08_total_seats(log).collect()] == [(9,)]
    assert [tuple(x) for x in A.q08_total_seats(route_log(spark, [removal(0, 1)])).collect()] == []
    assert set(ROUTE.names) <= set(log.columns)
