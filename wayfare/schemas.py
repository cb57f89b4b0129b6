"""Record types, domains and result names."""

from __future__ import annotations

from pyspark.sql import types as T

TRIP_PAYLOAD = T.StructType([
    T.StructField("route_id", T.LongType()),
    T.StructField("passenger_name", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("transport_type", T.StringType()),
])

ROUTE_PAYLOAD = T.StructType([
    T.StructField("route_id", T.LongType()),
    T.StructField("origin", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
])

SUPPLIER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
])

# A trip adds its event time and its position in the log; a route adds its version number and the
# time from which that version holds.
TRIP = T.StructType(TRIP_PAYLOAD.fields + [
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()),
])
ROUTE = T.StructType(ROUTE_PAYLOAD.fields + [
    T.StructField("effective_ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

RESULT_ROW = T.StructType([
    T.StructField("result_table", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("result", T.StringType()),
])

# --- fixed values -----------------------------------------------------------------------------
# JSON field names on the wire, in the order of the payload types above.
TRIP_FIELDS = ["routeId", "passengerName", "origin", "destination", "transportType"]
ROUTE_FIELDS = ["routeId", "origin", "destination", "type", "operator", "capacity"]

TRANSPORT_TYPES = ["Bus", "Taxi", "Train", "Metro", "Scooter"]
OPERATORS = ["OperatorA", "OperatorB", "OperatorC"]

# Result table of each query, by query number.
RESULT_TABLES = {
    4: "ResultsPassengersPerRoute",
    5: "ResultsAvailableSeatsPerRoute",
    6: "ResultsOccupancyPercentagePerRoute",
    7: "ResultsTotalPassengerCount",
    8: "ResultsTotalSeatingAvailable",
    9: "ResultsTotalOccupancyPercentage",
    10: "ResultsAveragePassengersPerTransportType",
    11: "ResultsHighestTransportType",
    12: "ResultsLeastOccupancyPerTransportType",
    13: "ResultsMostUsedTransportType",
    14: "ResultsLeastOccupiedTransportType",
    15: "ResultsMostOccupiedOperator",
    16: "ResultsMostTripsPassenger",
}
# Name inside the schema envelope: the table's name, except for query 15.
ENVELOPE_NAMES = {**RESULT_TABLES, 15: "MostOccupiedOperator"}

# Constant ids of the one-row results.
RESULT_IDS = {
    7: "total",
    8: "total",
    9: "total",
    11: "highest",
    13: "mostused",
    14: "least occupied transport type",
    15: "MostOccupiedOperator",
    16: "mosttrips",
}
# --- end of fixed values ----------------------------------------------------------------------
