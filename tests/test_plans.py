"""Plans: what is read, how it is grouped, and that nothing runs through Python or one task."""

import pytest
from compare import TESTDATA

import __spark_entry__ as entry_module
from wayfare.registry import ANSWERS, BATCHED_STREAMS, QUERIES, STREAMS

SF = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema: " in line]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in STREAMS and n not in BATCHED_STREAMS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_module.queries()[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_windows_have_a_key(spark, name):
    for line in plan(ANSWERS[name](spark, SF)).splitlines():
        if "Window " in line or "Window[" in line:
            assert "windowspecdefinition(route_id" in line or "[route_id" in line


@pytest.mark.parametrize("name, columns", [
    ("q05_seats_per_route", {"struct<p_partkey:bigint,p_size:int>"}),
    ("q06_occupancy_per_route", {"struct<props:string>", "struct<p_partkey:bigint,p_size:int>"}),
    ("q07_total_passengers", {"struct<>"}),
    ("q10_avg_passengers_per_type", {"struct<event_type:string>"}),
    ("q11_top_type", {"struct<event_id:bigint,event_type:string>"}),
    ("q13_top_hourly_type_all", {"struct<event_id:bigint,ts:timestamp_ntz,event_type:string>"}),
    ("q16_top_passenger", {"struct<event_id:bigint,user_id:bigint>"}),
    ("q12_least_occupied_route", {"struct<props:string>", "struct<p_partkey:bigint,p_type:string,p_size:int>"}),
    ("q15_top_operator",
     {"struct<event_id:bigint,props:string>", "struct<p_partkey:bigint,p_brand:string,p_size:int>"}),
    ("capacity_snapshot", {"struct<p_size:int>"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert set(read_columns(plan(entry_module.queries()[name](spark, SF)))) == columns


@pytest.mark.parametrize("name", [
    "q06_occupancy_per_route", "q07_total_passengers", "q11_top_type", "q13_top_hourly_type_all",
    "q16_top_passenger", "trip_counts", "hourly_type_counts", "q06_shipments",
])
def test_the_log_is_grouped_by_hash(spark, name):
    text = plan(entry_module.queries()[name](spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("name", ["q11_shipments", "q13_shipments", "q16_shipments"])
def test_places_of_several_columns_are_looked_for_only_on_a_tie(spark, name):
    assert "SortAggregate" not in plan(entry_module.queries()[name](spark, SF))


def test_versions_are_found_without_sorting_trips(spark):
    text = plan(entry_module.queries()["q12_least_occupied_route_asof"](spark, SF))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("version" in line and "event_id" not in line for line in windows)


def test_json_is_decoded_once_per_row(spark):
    text = plan(entry_module.queries()["trip_counts"](spark, SF))
    assert sum("from_json" in line for line in text.splitlines()) == 1


def test_lookup_is_pushed_to_the_scan(spark):
    assert "EqualTo(s_suppkey,7)" in plan(entry_module.queries()["lookup_supplier"](spark, SF))


def test_top_one_does_not_sort_the_groups(spark):
    assert "TakeOrderedAndProject" in plan(entry_module.queries()["q16_top_passenger"](spark, SF))
