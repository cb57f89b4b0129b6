"""Strict records, repeated polls, folds whose states cannot be merged, and taps."""

import random

import pytest
from logs import random_logs, route, routes_df, trip, trips_df
from pyspark.sql import functions as F
from test_deltas import flows_on, rows_of
from test_streaming import write_files

from wayfare.operators import folds
from wayfare.operators.folds import keyed_fold
from wayfare.sources.json_log import decode_routes, decode_trips, encode_trips, split_bad
from wayfare.sources.polls import Polls, snapshot_changes
from wayfare.streaming.taps import stream_taps, tapped

GOOD = '{"routeId":1,"passengerName":"Ann","origin":"A","destination":"B","transportType":"Bus"}'


def records(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n LONG, value STRING")


def test_unknown_fields_are_named_and_set_apart(spark):
    log = records(spark, GOOD, GOOD[:-1] + ',"b":null,"a":{"routeId":2}}', "{bad", None, '{"routeId":3}', "[1]")
    decoded = decode_trips(log, mode="PERMISSIVE", unknown="refuse")
    got = {r.n: (r.route_id, r.bad_record, r.unknown_fields) for r in decoded.collect()}
    assert got[0] == (1, None, None) and got[4] == (3, None, None)
    assert got[1][0] is None and got[1][1].endswith("}}") and got[1][2] == ["b", "a"]
    assert got[2][1] == "{bad" and got[2][2] is None and 3 not in got
    good, bad = split_bad(decoded)
    assert sorted(r.n for r in good.collect() if r.route_id) == [0, 4] and 1 in {r.n for r in bad.collect()}


def test_a_strict_reader_stops_at_an_unknown_field(spark):
    assert decode_trips(records(spark, GOOD), unknown="refuse").count() == 1
    with pytest.raises(Exception, match="unknown fields: delay"):
        decode_trips(records(spark, GOOD[:-1] + ',"delay":1}'), unknown="refuse").collect()
    with pytest.raises(Exception, match="unknown fields: passengerName, transportType"):
        decode_routes(records(spark, GOOD), unknown="refuse").collect()
    assert decode_trips(records(spark, GOOD[:-1] + ',"delay":1}')).first().route_id == 1
    with pytest.raises(ValueError):
        decode_trips(records(spark, GOOD), unknown="drop")


SUPPLIERS = "id LONG, name STRING, type STRING"


def test_changes_between_two_snapshots(spark):
    old = spark.createDataFrame([(1, "a", "Bus"), (2, "b", None), (3, None, "Taxi"), (4, "d", "Bus")], SUPPLIERS)
    new = spark.createDataFrame([(1, "a", "Bus"), (2, None, "b"), (3, None, "Metro"), (5, None, None)], SUPPLIERS)
    assert rows_of(snapshot_changes(old, new, ["id"])) == sorted([
        (2, None, "b", "changed"), (3, None, "Metro", "changed"), (4, None, None, "removed"), (5, None, None, "inserted"),
    ], key=str)
    none = old.filter("false")
    assert {r.change for r in snapshot_changes(none, new, ["id"]).collect()} == {"inserted"}
    assert {r.change for r in snapshot_changes(old, none, ["id"]).collect()} == {"removed"}
    assert snapshot_changes(old, old, ["id"]).isEmpty()


def test_polls_follow_a_table(spark, tmp_path):
    rnd, state = random.Random(2), {i: "n" for i in range(30)}
    schema = spark.createDataFrame([], "id LONG, name STRING").schema
    polls = Polls(str(tmp_path), schema, ["id"])
    for version in range(5):
        before = dict(state) if version else {}
        for _ in range(6 if version else 0):
            i = rnd.randrange(40)
            if rnd.random() < 0.4:
                state.pop(i, None)
            else:
                state[i] = rnd.choice("xyz")
        snapshot = spark.createDataFrame(list(state.items()), schema)
        for _ in range(2):  # a poll that is repeated shows the same
            got = {(r.id, r.change) for r in polls.poll(snapshot, version).collect()}
            assert got == {
                (i, "removed" if i not in state else "inserted" if i not in before else "changed")
                for i in {*state, *before} if state.get(i) != before.get(i)
            }
        assert {(r.id, r.name) for r in polls.table.read(spark).collect()} == set(state.items())


@pytest.mark.parametrize("per_fold, per_task", [(1, 1_000), (7, 1_000), (50, 20), (10_000, 1_000)])
def test_a_step_that_cannot_be_merged(spark, per_fold, per_task):
    t, _ = random_logs(31, n_trips=60)
    folded = keyed_fold(
        trips_df(spark, t), "route_id", ["event_id"], F.col("event_id"), init=F.lit(5).cast("bigint"),
        step=lambda acc, n: (n - 2 * acc) % 1_009, rows_per_fold=per_fold, rows_per_task=per_task,
    )
    want = {}
    for x in sorted(t, key=lambda x: x[6]):
        value = x[6] - 2 * want.get(x[0], 5)
        want[x[0]] = abs(value) % 1_009 * (1 if value >= 0 else -1)
    assert {r.route_id: r.state for r in folded.collect()} == want


@pytest.mark.parametrize("per_pass", [1, 6, 20, 1_000])
def test_passes_go_on_from_the_states_before(spark, monkeypatch, per_pass):
    monkeypatch.setattr(folds, "ROWS_PER_FOLD", per_pass)
    t, _ = random_logs(32, n_trips=60)
    folded = keyed_fold(
        trips_df(spark, t), "route_id", ["event_id"], F.col("event_id"),
        # null for a key whose last number is even, so that a state without a value is one too
        init=F.lit(0).cast("bigint"), step=lambda acc, n: F.when(n % 2 == 1, n - F.coalesce(acc, F.lit(7))),
        rows_per_fold=3,
    )
    want = {}
    for x in sorted(t, key=lambda x: x[6]):
        acc = want.get(x[0], 0)
        want[x[0]] = x[6] - (7 if acc is None else acc) if x[6] % 2 else None
    assert {r.route_id: r.state for r in folded.collect()} == want


def test_few_rows_per_fold_make_no_more_passes(spark):
    """Small stretches of a key are folded one after the other in a pass, which costs some Spark jobs."""
    group = "few rows per fold"
    spark.sparkContext.setJobGroup(group, group)
    folded = keyed_fold(
        spark.range(300).select(F.lit(1).alias("key"), "id"), "key", ["id"], F.col("id"),
        F.lit(0).cast("bigint"), lambda acc, n: n - acc, rows_per_fold=3,
    )
    assert folded.collect()[0].state == 150
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 30


def test_a_fold_over_nothing(spark):
    empty = keyed_fold(trips_df(spark, []), "route_id", ["event_id"], F.col("event_id"), F.lit(0).cast("bigint"),
                       lambda acc, n: n - acc)
    assert empty.collect() == []


def test_a_batch_job_is_tapped(spark):
    trips, seen = tapped(trips_df(spark, [trip(i, 1) for i in range(9)]), "trips", {
        "n": F.count("*"), "last": F.max("event_id")})
    assert encode_trips(trips).filter("key = '1'").count() == 9
    assert seen.get == {"n": 9, "last": 8}


def test_streams_are_tapped_while_they_run(spark, tmp_path):
    folder = str(tmp_path / "logs")
    write_files(spark, trips_df, [trip(i, 1) for i in range(7)], f"{folder}/trips", 2)
    write_files(spark, routes_df, [route(0, 1, 4)], f"{folder}/routes", 1)
    flows = flows_on(spark, tmp_path / "state", folder)
    with stream_taps(flows.spark) as taps:
        for name in ("type_trips", "route_latest"):
            taps.wait_for(flows.start(name))
    assert (taps.total("type_trips", "rows_in"), taps.total("route_latest", "rows_in")) == (7, 1)
    assert len(taps.batches["type_trips"]) >= 2 and taps.total("nothing", "rows_in") == 0
