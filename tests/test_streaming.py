"""Streams over many files: equal to batch, across restarts and repeated batches."""

import json
import os

import pytest
from logs import random_logs, route, routes_df, trip, trips_df
from pyspark.sql import functions as F

from wayfare.operators.results import with_result_table
from wayfare.operators.rollups import trip_counts
from wayfare.plans import answers as A
from wayfare.schemas import RESULT_TABLES
from wayfare.session import stream_session
from wayfare.streaming.flows import FLOWS, Flows, file_stream, keep_publishing, least_occupied_updates, publish
from wayfare.streaming.keyed import KeyedTable

Q = {
    4: lambda t, r: A.q04_passengers_per_route(t), 5: lambda t, r: A.q05_seats_per_route(r),
    6: A.q06_occupancy_per_route, 7: lambda t, r: A.q07_total_passengers(t), 8: lambda t, r: A.q08_total_seats(r),
    9: A.q09_total_occupancy, 10: lambda t, r: A.q10_avg_passengers_per_type(t), 11: lambda t, r: A.q11_top_type(t),
    12: A.q12_least_occupied_route_changelog, 13: lambda t, r: A.q13_top_hourly_type(t),
    14: A.q14_least_occupied_type_changelog, 15: A.q15_top_operator, 16: lambda t, r: A.q16_top_passenger(t),
}


def batch_results(trips, routes):
    return sorted(
        tuple(r) for q, answer in Q.items() for r in with_result_table(answer(trips, routes), q).collect()
    )


def write_files(spark, make, rows, folder, n):
    """``rows`` as ``n`` files in log order; a stream takes them by age, so each is written after the one before."""
    size = -(-len(rows) // n)
    for i in range(n):
        make(spark, rows[i * size:(i + 1) * size]).coalesce(1).write.mode("append").parquet(folder)


def flows_on(spark, root, folder):
    session = stream_session(spark)
    trips = file_stream(session, f"{folder}/trips", 1).withColumn("ts", F.col("ts").cast("timestamp"))
    return Flows(session, str(root), trips, file_stream(session, f"{folder}/routes", 1))


def test_all_results_over_many_batches_and_a_restart(spark, tmp_path):
    t, r = random_logs(3, n_trips=300)
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t[:200], f"{folder}/trips", 2)
    write_files(spark, routes_df, r, f"{folder}/routes", 2)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run(*FLOWS)
    first = sorted(tuple(x) for x in publish(flows, spark, 0).collect())
    assert first == batch_results(trips_df(spark, t[:200]), routes_df(spark, r))

    write_files(spark, trips_df, t[200:], f"{folder}/trips", 2)
    again = flows_on(spark, tmp_path / "state", folder)
    again.run(*FLOWS)
    second = sorted(tuple(x) for x in publish(again, spark, 1).collect())
    assert second == batch_results(trips_df(spark, t), routes_df(spark, r))
    # seats have not changed since, hence were not written again
    written = {d.split("=")[1] for d in os.listdir(tmp_path / "state/tables/results/changes/batch=1") if "=" in d}
    assert RESULT_TABLES[4] in written and RESULT_TABLES[5] not in written
    # the same version once more changes nothing
    assert sorted(tuple(x) for x in publish(again, spark, 1).collect()) == second


def test_results_are_published_until_the_flows_end(spark, tmp_path):
    t, r = random_logs(5, n_trips=100)
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t, f"{folder}/trips", 2)
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    keep_publishing(flows, spark, pause=1.0)
    published = sorted(tuple(x) for x in flows.results().read(spark).collect())
    assert published == batch_results(trips_df(spark, t), routes_df(spark, r))
    # a running service, stopped after a round and started again for the rest
    write_files(spark, trips_df, [trip(100, 1, "Zoe")], f"{folder}/trips", 1)
    again = flows_on(spark, tmp_path / "state", folder)
    again.trigger = {"processingTime": "1 second"}
    first = keep_publishing(again, spark, pause=0.1, rounds=1)
    assert not again.spark.streams.active
    again.trigger = {"availableNow": True}
    assert keep_publishing(again, spark, pause=0.1) > first
    assert again.read("trip_total").first().total_passengers == 101


def test_repeated_batch_counts_once(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), spark.createDataFrame([], "k LONG, n LONG").schema, ["k"])

    def rows(*values):
        return spark.createDataFrame(values, "k LONG, n LONG")

    table.write(rows((1, 1), (2, 1)), 0)
    table.write(rows((1, 2)), 1)
    table.write(rows((1, 2)), 1)
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 2), (2, 1)]
    assert sorted(map(tuple, table.read(spark, before=1).collect())) == [(1, 1), (2, 1)]


def test_snapshots_keep_the_table(spark, tmp_path):
    schema = spark.createDataFrame([], "k LONG, n LONG").schema
    table = KeyedTable(str(tmp_path / "t"), schema, ["k"], snapshot_every=2)
    for batch in range(6):
        table.write(spark.createDataFrame([(batch % 3, batch), (9, batch)], schema), batch)
    want = [(0, 3), (1, 4), (2, 5), (9, 5)]
    assert sorted(map(tuple, table.read(spark).collect())) == want
    reopened = KeyedTable(str(tmp_path / "t"), schema, ["k"])
    assert sorted(map(tuple, reopened.read(spark).collect())) == want
    assert sorted(map(tuple, reopened.read(spark, before=4).collect())) == [(0, 3), (1, 1), (2, 2), (9, 3)]
    # the snapshot of a batch that runs again, and a stray one without its mark, change nothing
    table.take_snapshot(spark, 4)
    for name in ("snapshots", "changes"):
        stray = tmp_path / "t" / name / "batch=6"
        spark.createDataFrame([(7, 7)], schema).write.parquet(str(stray))
        (stray / "_SUCCESS").unlink()
    assert sorted(map(tuple, reopened.read(spark).collect())) == want


def test_folders_of_a_long_stream_stay_few(spark, tmp_path):
    schema = spark.createDataFrame([], "k LONG, n LONG").schema
    seconds = 1_700_000_000  # versions may be times, never divisible by anything in particular
    for batch in range(40):
        table = KeyedTable(str(tmp_path / "t"), schema, ["k"], snapshot_every=5)  # as after a restart
        table.write(spark.createDataFrame([(batch % 7, batch)], schema), seconds + 30 * batch + 1)
        folders = [list((tmp_path / "t" / n).glob("batch=*")) for n in ("changes", "snapshots")]
        assert len(folders[0]) <= 10 and len(folders[1]) <= 2
    assert sorted(map(tuple, table.read(spark).collect())) == sorted((b % 7, b) for b in range(33, 40))


def test_stream_lookup_sees_the_route_known_at_the_time(spark, tmp_path):
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, [trip(0, 1), trip(1, 2), trip(2, 1), trip(3, 1)], f"{folder}/trips", 2)
    write_files(spark, routes_df, [route(0, 1, 4)], f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run("route_latest")
    table = least_occupied_updates(flows)
    # 1 of 4, then 3 of 4; route 2 is unknown and its update lost for good
    assert [tuple(r) for r in table.read(spark).collect()] == [("Metro", 0.25, 0, 1)]

    write_files(spark, routes_df, [route(1, 1, 100), route(2, 2, 100)], f"{folder}/routes", 1)
    write_files(spark, trips_df, [trip(4, 1)], f"{folder}/trips", 1)
    again = flows_on(spark, tmp_path / "state", folder)
    again.run("route_latest")
    table = least_occupied_updates(again)
    # the fourth trip of route 1 finds its new capacity; route 2 had no further trip
    assert [tuple(r) for r in table.read(spark).collect()] == [("Metro", 0.04, 4, 1)]


def test_late_trip_is_dropped_once_the_watermark_has_passed(spark, tmp_path):
    folder = str(tmp_path / "logs")
    # the watermark moves after a batch, and late rows are filtered by the one before
    for rows in ([trip(0, 1, minute=10), trip(1, 1, minute=65)], [trip(2, 1, minute=70)], [trip(3, 1, minute=55)]):
        write_files(spark, trips_df, rows, f"{folder}/trips", 1)
    write_files(spark, routes_df, [route(0, 1, 4)], f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run("type_hours", "type_trips")
    assert sorted(r.trips for r in flows.read("type_hours").collect()) == [1, 2]
    assert [r.trips for r in flows.read("type_trips").collect()] == [4]


def test_a_failure_within_a_batch_loses_and_repeats_nothing(spark, tmp_path):
    t, r = random_logs(4, n_trips=120)
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, t, f"{folder}/trips", 3)
    write_files(spark, routes_df, r, f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)

    def fail_on_second(changes, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        flows.start("route_trips", fail_on_second).awaitTermination()
    again = flows_on(spark, tmp_path / "state", folder)
    again.run("route_trips")
    want = {x.route_id: (x.trips, x.first_at, x.last_at) for x in trip_counts(trips_df(spark, t), "route_id").collect()}
    assert {x.route_id: (x.trips, x.first_at, x.last_at) for x in again.read("route_trips").collect()} == want


def test_rows_are_observed(spark, tmp_path):
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, [trip(i, 1) for i in range(7)], f"{folder}/trips", 1)
    write_files(spark, routes_df, [route(0, 1, 4)], f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    query = flows.start("type_trips")
    query.awaitTermination()
    seen = [p["observedMetrics"]["type_trips"]["rows_in"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(seen) == 7


def test_an_unknown_flow_is_refused(spark, tmp_path):
    flows = Flows(spark, str(tmp_path), None, None)
    with pytest.raises(KeyError):
        flows.start("nope")


def test_changed_results_are_sent_as_envelopes(spark, tmp_path):
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, [trip(0, 1), trip(1, 1)], f"{folder}/trips", 1)
    write_files(spark, routes_df, [route(0, 1, 4)], f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    flows.run("route_seats", "trip_total")
    sent = []

    def send(envelopes, topic):
        sent.extend((topic, r.key, json.loads(r.value)["payload"]["result"]) for r in envelopes.collect())

    publish(flows, spark, 1, queries=(5, 7), send=send)
    assert sorted(sent) == [(RESULT_TABLES[5], "1", "4"), (RESULT_TABLES[7], "total", "2")]
    publish(flows, spark, 2, queries=(5, 7), send=send)
    assert len(sent) == 2
