"""Writes a larger log for timings: the events of a folder many times over, with hot keys.

    python multiply.py /root/testdata/sf0.1 /scratch/large 300

A third of all events gets one route, another third of them one passenger. Event ids stay unique and rise
with time: copies follow one another, each shifted by the time the events span. ``part`` is copied as it is.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import build_session

HOT_ROUTE = 7
HOT_PASSENGER = 11


def multiplied(events: DataFrame, times: int) -> DataFrame:
    span = events.agg(
        (F.max("event_id") - F.min("event_id") + 1).alias("ids"),
        (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp")) + 1).alias("time"),
    ).first()
    copy = F.col("copy")
    draw = F.pmod(F.xxhash64("event_id", "copy"), F.lit(9))
    moved = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + copy * span["time"])
    columns = {
        "event_id": F.col("event_id") + copy * span["ids"],
        "ts": moved.cast(events.schema["ts"].dataType),
        "user_id": F.when(draw % 3 == 1, F.lit(HOT_PASSENGER)).otherwise(F.col("user_id")),
        "props": F.when(draw < 3, F.lit(f'{{"k":{HOT_ROUTE}}}')).otherwise(F.col("props")),
    }
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(times - 1).cast("bigint"))))
    return copies.select(*[columns.get(c, F.col(c)).alias(c) for c in events.columns])


def write(spark: SparkSession, source: str, out: str, times: int) -> None:
    multiplied(spark.read.parquet(f"{source}/events.parquet"), times).write.parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{source}/part.parquet").write.parquet(f"{out}/part.parquet")


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("source")
    parser.add_argument("out")
    parser.add_argument("times", type=int)
    given = parser.parse_args()
    write(build_session("multiply"), given.source, given.out, given.times)
