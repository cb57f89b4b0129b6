"""Decoding, encoding, look-ups, validation, result shapes, options of external systems."""

import json

import pytest
from logs import route, routes_df, trip, trips_df
from pyspark.sql import functions as F

from wayfare.functions.ratios import occupancy
from wayfare.functions.text import occupancy_text, parse_occupancy_text, percent_text, two_decimals
from wayfare.operators import results as R
from wayfare.operators.rollups import avg_per_group
from wayfare.operators.tables import checked, split_checked
from wayfare.schemas import OPERATORS, RESULT_ROW, RESULT_TABLES, ROUTE, SUPPLIER, TRANSPORT_TYPES, TRIP
from wayfare.sources import dimensions, external, json_log, tables
from wayfare.sources.results import results_scan, write_result_tables


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_decode(spark):
    good = '{"routeId":3,"passengerName":"Ann","origin":"A","destination":"B","transportType":"Bus"}'
    partial = '{"passengerName":"Bob","unknown":1}'
    rows = json_log.decode_trips(texts(spark, good, partial)).collect()
    assert [tuple(r) for r in rows] == [(3, "Ann", "A", "B", "Bus"), (0, "Bob", None, None, None)]
    assert json_log.decode_routes(texts(spark, '{"routeId":1}')).first().capacity == 0


def test_bad_record_stops_or_is_set_apart(spark):
    values = texts(spark, '{"routeId":3}', "{bad")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        json_log.decode_trips(values).collect()
    good, bad = json_log.split_bad(json_log.decode_trips(values, mode="PERMISSIVE"))
    assert [r.route_id for r in good.collect()] == [3]
    assert [r.bad_record for r in bad.collect()] == ["{bad"]


@pytest.mark.parametrize("text, want", [
    ('{"k": 69}', 69), ('{"k":0}', 0), ('{"k":  7}', 7), ('{"k": -3}', -3), ('{"a": 1, "k": 5}', 5), ('{"a": 1}', 0),
    (' {"k": 4} ', 4), ('{"k": 999999999999999999}', 999999999999999999), ('{"k": 9223372036854775807}', 2**63 - 1),
])
def test_json_number(spark, text, want):
    assert texts(spark, text).select(json_log.json_number("value", "k")).first()[0] == want


@pytest.mark.parametrize("text", ['{"k": 007}', '{"k": 1', '{"k": "x"}'])
def test_json_number_refuses_bad_records(spark, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        texts(spark, text).select(json_log.json_number("value", "k")).collect()


def test_encode_is_the_inverse_of_decode(spark):
    trips = trips_df(spark, [trip(0, 3, 'a "quoted" -> name', None), trip(1, 4)])
    encoded = json_log.encode_trips(trips)
    assert sorted(r.key for r in encoded.collect()) == ["3", "4"]
    decoded = json_log.decode_trips(encoded.drop("key"))
    assert sorted(map(str, decoded.collect())) == sorted(map(str, trips.select(*decoded.columns).collect()))
    record = json.loads(json_log.encode_routes(routes_df(spark, [route(0, 1, 4)])).first().value)
    assert record == {
        "routeId": 1, "origin": "A", "destination": "B", "type": "Metro", "operator": "OperatorA", "capacity": 4,
    }


def test_lookup_and_snapshots(spark):
    routes = routes_df(spark, [route(0, 1, 5), route(1, 2, 5)])
    assert dimensions.lookup(routes, "route_id", 2).count() == 1
    assert dimensions.lookup(routes, "route_id", 3).collect() == []
    assert [r.capacity for r in dimensions.capacity_snapshot(routes).collect()] == [5, 5]


def test_domain_checks(spark):
    rows = [("Bus", "OperatorA"), ("Boat", "OperatorA"), ("Bus", "OperatorZ"), (None, "OperatorA")]
    df = spark.createDataFrame(rows, "type STRING, operator STRING")
    verdict = checked(df, {"type": TRANSPORT_TYPES, "operator": OPERATORS}, ["type", "operator"])
    assert [r.violation for r in verdict.collect()] == [
        None, "type not allowed: Boat", "operator not allowed: OperatorZ", "type is null"
    ]
    accepted, rejected = split_checked(verdict)
    assert accepted.count() == 1 and rejected.count() == 3 and "violation" not in accepted.columns


def test_text_forms(spark):
    df = spark.sql("SELECT 0.125D AS a, 1.005D AS b, 1.0D / 10000 AS c")
    row = df.select(
        percent_text(F.col("a")), two_decimals(F.col("b")), F.col("c").cast("string"),
        parse_occupancy_text(occupancy_text(F.lit(1), F.lit("Night Bus"), F.col("c"))),
        parse_occupancy_text(occupancy_text(F.lit(1), F.lit(None).cast("string"), F.col("c")))["type"],
        occupancy(F.lit(1), F.lit(0)),
    ).first()
    assert tuple(row[:3]) == ("0.13%", "1.01", "1.0E-4")
    assert tuple(row[3]) == (1, "Night Bus", 0.0001)
    assert row[4] == "UNKNOWN" and row[5] == float("inf")


def test_envelope(spark):
    rows = spark.createDataFrame([("OperatorA", 2.0)], "operator STRING, occupancy DOUBLE")
    envelope = R.result_envelope(R.result_rows(rows, 15), 15).first()
    assert envelope.key == "MostOccupiedOperator"
    assert json.loads(envelope.value) == {
        "schema": {
            "type": "struct", "optional": False, "name": "MostOccupiedOperator",
            "fields": [{"field": "id", "type": "string"}, {"field": "result", "type": "string"}],
        },
        "payload": {"id": "MostOccupiedOperator", "result": "OperatorA -> 2.0"},
    }


def test_over_long_lists_keep_their_id_in_every_part(spark):
    rows = spark.createDataFrame([(3, 0, "a, b"), (3, 1, "c")], "route_id LONG, part LONG, passengers STRING")
    assert [tuple(r) for r in R.result_rows(rows, 4).collect()] == [("3", 0, "a, b"), ("3", 1, "c")]
    envelopes = [json.loads(r.value) for r in R.result_envelope(R.result_rows(rows, 4), 4).collect()]
    assert [e["payload"] for e in envelopes] == [
        {"id": "3", "result": "a, b", "part": 0}, {"id": "3", "result": "c", "part": 1}]


def test_null_records_are_no_trips(spark):
    log = spark.createDataFrame([(1, None), (2, '{"routeId":7}'), (3, '{"passengerName":"a"}'), (4, "{bad")], "event_id LONG, value STRING")
    good, bad = json_log.split_bad(json_log.decode_trips(log, mode="PERMISSIVE"))
    assert [(r.event_id, r.route_id) for r in good.orderBy("event_id").collect()] == [(2, 7), (3, 0)]
    assert [(r.event_id, r.route_id) for r in bad.collect()] == [(4, None)]
    whole = json_log.decode_trips(log.filter("event_id < 4"))
    assert [(r.event_id, r.route_id) for r in whole.orderBy("event_id").collect()] == [(2, 7), (3, 0)]


def test_topic_positions_are_unique_over_any_number_of_partitions(spark):
    records = spark.range(50).crossJoin(spark.range(9).toDF("partition")).withColumnRenamed("id", "offset")
    placed = records.select("offset", "partition", external.position().alias("event_id"))
    assert placed.select("event_id").distinct().count() == 450
    last = {}
    for r in placed.orderBy("partition", "offset").collect():
        assert r.event_id > last.get(r.partition, -1)
        last[r.partition] = r.event_id


def test_result_tables(spark, tmp_path):
    rows = spark.createDataFrame(
        [(RESULT_TABLES[5], "1", 0, "17"), (RESULT_TABLES[7], "total", 0, "10")], RESULT_ROW
    )
    path = str(tmp_path / "results")
    write_result_tables(rows, path)
    assert results_scan(spark, path).count() == 2
    one = results_scan(spark, path, 7)
    assert [tuple(r) for r in one.collect()] == [("total", 0, "10")]
    assert "PartitionFilters: [isnotnull(result_table" in one._jdf.queryExecution().executedPlan().toString()


def test_average_of_a_measure(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", None), (None, 3.0)], "k STRING, v DOUBLE")
    got = {r.k: (r.total, r.n, r.average) for r in avg_per_group(df, "k", "v").collect()}
    assert got == {"a": (5.0, 2, 2.5), "b": (None, 0, 0.0)}


@pytest.mark.parametrize("reader, schema", [(tables.trips, TRIP), (tables.routes, ROUTE), (tables.suppliers, SUPPLIER)])
def test_given_tables_have_the_record_types(spark, reader, schema):
    types = {f.name: f.dataType for f in reader(spark, "/root/testdata/sf0.001").schema}
    assert types == {f.name: f.dataType for f in schema}


def test_options_of_external_systems():
    assert external.kafka_options("broker:9092", "Trips") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "Trips", "startingOffsets": "earliest",
    }
    assert external.jdbc_options("jdbc:x", "SELECT capacity FROM Route", user="u") == {
        "url": "jdbc:x", "dbtable": "(SELECT capacity FROM Route) AS snapshot", "user": "u",
    }


def test_an_event_without_record_stops_the_query(spark):
    log = spark.createDataFrame([(None,)], "props STRING")
    with pytest.raises(Exception, match="no record"):
        log.select(json_log.json_number("props", "k")).collect()
