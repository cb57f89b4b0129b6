"""Kafka and JDBC readers and writers.

Both need a connector jar on the cluster's class path; neither is needed for files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.json_log import BAD_RECORD, decode_routes, decode_trips, split_bad


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Read from the start of the topic; the checkpoint keeps the position afterwards."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}


# Low bits of a position that hold the partition; the offset has the 47 above them.
PARTITION_BITS = 16


def position(offset: str = "offset", partition: str = "partition") -> Column:
    """A record's place as one number: unique over all partitions of a topic, rising within each.

    Topics grow by partitions, so no number of them is assumed, but for a limit that stops the query.
    """
    known = F.col(partition).between(0, (1 << PARTITION_BITS) - 1) & (F.col(offset) < F.lit(1 << (63 - PARTITION_BITS)))
    number = F.shiftleft(F.col(offset).cast("bigint"), PARTITION_BITS).bitwiseOR(F.col(partition).cast("bigint"))
    return F.when(known, number).otherwise(F.raise_error(F.lit("partition or offset beyond a position's bits")))


def kafka_log(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic as (value, ts, event_id); ``event_id`` is the record's :func:`position`."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic)).load()
    return raw.select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"), position().alias("event_id")
    )


def kafka_trips(spark: SparkSession, servers: str, topic: str = "Trips", mode: str = "FAILFAST") -> DataFrame:
    """``mode`` as in :func:`decode_trips`; with ``PERMISSIVE`` bad records are passed over."""
    return _good(decode_trips(kafka_log(spark, servers, topic), mode=mode))


def kafka_routes(spark: SparkSession, servers: str, topic: str = "Routes", mode: str = "FAILFAST") -> DataFrame:
    log = _good(decode_routes(kafka_log(spark, servers, topic), mode=mode))
    return log.withColumnsRenamed({"ts": "effective_ts", "event_id": "seq"})


def _good(decoded: DataFrame) -> DataFrame:
    return split_bad(decoded)[0] if BAD_RECORD in decoded.columns else decoded


def write_topic(envelopes: DataFrame, servers: str, topic: str) -> None:
    """(key, value) records, such as result envelopes, to a topic; for use in a batch or a micro-batch."""
    envelopes.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def jdbc_options(url: str, query: str, **extra: str) -> dict[str, str]:
    """Options of a pushed-down query; columns not selected never leave the database."""
    return {"url": url, "dbtable": f"({query}) AS snapshot", **extra}


def jdbc_snapshot(spark: SparkSession, url: str, query: str, **extra: str) -> DataFrame:
    """A bulk read. For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` to read ranges of it in parallel."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **extra)).load()


def jdbc_suppliers(spark: SparkSession, url: str, **extra: str) -> DataFrame:
    return jdbc_snapshot(spark, url, "SELECT id, name, type FROM Supplier", **extra)


def jdbc_capacities(spark: SparkSession, url: str, **extra: str) -> DataFrame:
    return jdbc_snapshot(spark, url, "SELECT capacity FROM Route", **extra)
