"""Shards by consistent hashing with virtual nodes and bounded loads.

Documents and virtual nodes lie on a ring of ``POINTS`` points. The arc before a virtual node belongs to
its shard, until that shard is full: the documents of the arc beyond its room go on clockwise to the next
virtual node whose shard has room. Room is the exact even share, so that shards differ by one document at
most. Only numbers of documents per arc, of which there are as many as virtual nodes, are looked at to
plan this; documents then find their shard and their slot by their rank within their arc.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import ranked
from wayfare.session import written

POINTS = 1 << 16
VIRTUAL_NODES = 128
ARCS = "array<struct<arc: int, first: int, last: int>>"
ROOMS = "array<struct<arc: int, first: bigint, n: bigint, shard: int, slot: bigint>>"


def virtual_nodes(spark: SparkSession, shards: int, each: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(point, shard) around the ring; of nodes on one point the lowest shard stays."""
    nodes = spark.range(shards * each).select(
        (F.col("id") % shards).cast("int").alias("shard"), (F.col("id") / shards).cast("long").alias("node")
    )
    point = F.pmod(F.xxhash64(F.lit("node"), "shard", "node"), F.lit(POINTS)).cast("int")
    rows = nodes.groupBy(point.alias("point")).agg(F.min("shard").alias("shard")).collect()
    return sorted((r["point"], r["shard"]) for r in rows)


def arcs_of(nodes: Sequence[tuple[int, int]]) -> list[dict]:
    """Ranges of points per arc; the arc that wraps around the ring has two."""
    arcs = [
        {"arc": i, "first": (nodes[i - 1][0] + 1) if i else 0, "last": point} for i, (point, _) in enumerate(nodes)
    ]
    if nodes[-1][0] < POINTS - 1:
        arcs.append({"arc": 0, "first": nodes[-1][0] + 1, "last": POINTS - 1})
    return arcs


def rooms_for(counts: dict[int, int], owners: Sequence[int], shards: int) -> list[dict]:
    """Ranges of ranks of each arc with the shard and first slot they take."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    rooms = []
    for arc in range(len(owners)):
        done, left, at = 0, counts.get(arc, 0), arc
        while left:
            shard = owners[at % len(owners)]
            taken = min(left, room[shard] - used[shard])
            if taken:
                rooms.append({"arc": arc, "first": done, "n": taken, "shard": shard, "slot": used[shard]})
                used[shard] += taken
                done, left = done + taken, left - taken
            at += 1
    return rooms


def _literal(spark: SparkSession, rows: list[dict], kind: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def sharded(docs: DataFrame, shards: int = 8, each: int = VIRTUAL_NODES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs`` (doc_id, text).

    The law is ``rows``: shards hold equal numbers of documents, at most one apart. size is the text's UTF-8
    bytes plus 1, and text_crc32 the unsigned crc32 of the text, both of an empty text where it is null.
    Slots run from 0 without gaps. Rows with a null doc_id share one point of the ring; repeated rows are
    placed one by one. No documents give no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    nodes = virtual_nodes(spark, shards, each)
    points = _literal(spark, arcs_of(nodes), ARCS).select("arc", F.explode(F.sequence("first", "last")).alias("point"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digests = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(POINTS)).cast("int").alias("point"),
    )
    placed = written(digests.join(F.broadcast(points), "point"), "digests")
    counts = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}
    rooms = _literal(spark, rooms_for(counts, [shard for _, shard in nodes], shards), ROOMS)
    at = ranked(placed, ["arc"], ["point", "doc_id", "text_crc32", "size"])
    rooms = rooms.withColumnRenamed("arc", "_arc")
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    return at.join(F.broadcast(rooms), (F.col("arc") == F.col("_arc")) & inside).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
