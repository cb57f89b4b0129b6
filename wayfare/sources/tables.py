"""The given parquet tables read as trips, routes and suppliers.

Every reader is a projection over one scan, so that a query reads only the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import TRANSPORT_TYPES
from wayfare.sources.json_log import decode_route_changes, encode_routes, json_number

SOURCE_PARTITIONS = 5
SHIPMENT_ORDER = ["ts", "order_key", "line_number", "part_key", "supplier_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_trips(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as trips; the route id is decoded from the JSON properties."""
    return events.select(
        "event_id",
        "ts",
        json_number("props", "k").alias("route_id"),
        F.col("user_id").cast("string").alias("passenger_name"),
        F.lit(None).cast("string").alias("origin"),
        F.lit(None).cast("string").alias("destination"),
        F.col("event_type").alias("transport_type"),
    )


def parts_as_routes(part: DataFrame) -> DataFrame:
    """Parts (batch or stream) as the log of route versions."""
    key = F.col("p_partkey")
    route_id = key % 100
    minutes = F.floor(key / 100) * 60 + route_id
    return part.select(
        key.alias("seq"),
        route_id.alias("route_id"),
        F.col("p_name").alias("origin"),
        F.col("p_name").alias("destination"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("operator"),
        F.coalesce("p_size", F.lit(0)).alias("capacity"),
        (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval(mins=minutes.cast("int")))
        .alias("effective_ts"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trips(table(spark, sf_dir, "events"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_as_routes(table(spark, sf_dir, "part"))


def routes_with_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`route_records` decoded: versions, and removals with ``removed`` set."""
    return decode_route_changes(route_records(spark, sf_dir))


def _type_of(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, TRANSPORT_TYPES)), (number % 5 + 1).cast("int"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        _type_of(F.col("s_nationkey")).alias("type"),
    )


def supplier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt under a new name, and every customer as a supplier without an id yet."""
    supplier = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") < 0)
    customer = table(spark, sf_dir, "customer")
    renamed = supplier.select(
        F.col("s_suppkey").alias("id"),
        F.concat("s_name", F.lit(" (closed)")).alias("name"),
        _type_of(F.col("s_nationkey")).alias("type"),
        F.col("s_suppkey").alias("position"),
    )
    added = customer.select(
        F.lit(None).cast("bigint").alias("id"),
        F.col("c_name").alias("name"),
        _type_of(F.col("c_nationkey")).alias("type"),
        F.col("c_custkey").alias("position"),
    )
    return renamed.unionByName(added)


def route_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as new details of a route, and every region as a route without an id yet."""
    def change(names: DataFrame, key: str, name: str, route_id: Column) -> DataFrame:
        operator = F.concat(F.lit("Operator"), F.substring(F.lit("ABC"), (F.col(key) % 3 + 1).cast("int"), F.lit(1)))
        return names.select(
            route_id.cast("bigint").alias("route_id"),
            F.col(name).alias("origin"),
            F.col(name).alias("destination"),
            _type_of(F.col(key)).alias("type"),
            operator.alias("operator"),
            (F.col(key) + 1).cast("int").alias("capacity"),
            F.col(key).cast("bigint").alias("position"),
        )

    nations = change(table(spark, sf_dir, "nation"), "n_nationkey", "n_name", F.col("n_nationkey"))
    regions = change(table(spark, sf_dir, "region"), "r_regionkey", "r_name", F.lit(None))
    return nations.unionByName(regions)


def route_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route log as (seq, key, value) records; a capacity that ends in 0 is followed by the route's removal."""
    versions = encode_routes(routes(spark, sf_dir), keep=["seq", "capacity"])
    removals = versions.filter(F.col("capacity") % 10 == 0).select(
        (2 * F.col("seq") + 1).alias("seq"), "key", F.lit(None).cast("string").alias("value")
    )
    return versions.select((2 * F.col("seq")).alias("seq"), "key", "value").unionByName(removals)


def order_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passenger of each order's shipments."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").cast("string").alias("passenger_name")
    )


def shipment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a larger, unordered trip log. No single column orders it; SHIPMENT_ORDER does."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_partkey").alias("route_id"),
        F.col("l_returnflag").alias("transport_type"),
    )


def parts_as_single_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One route version per part, for the shipment log."""
    return parts_as_routes(table(spark, sf_dir, "part")).withColumn("route_id", F.col("seq"))


def source_partition(route_id: Column) -> Column:
    """The log partition a trip was read from."""
    return route_id % SOURCE_PARTITIONS
