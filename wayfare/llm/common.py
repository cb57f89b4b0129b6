"""Ranks and connected components over tables of any size, shared by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.session import written

# Rows of one partition are numbered within this many bits by monotonically_increasing_id.
PLACE_BITS = 33


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """``rows`` with their rank from 0 among the rows of the same ``keys`` (not null), along ``order``.

    The rows are sorted once over the cluster into slices of even size, whatever the sizes of the keys;
    a row's rank is its place in its slice plus the rows of its key in earlier slices. The table of
    those has at most one row per slice and one per distinct key. Callers have a fixed number of keys,
    which bounds it and so allows its broadcast. The slices are written, so that their bounds, which come
    from a sample, are drawn once. Rows equal in ``keys`` and ``order`` are ranked in any order.
    """
    spark = rows.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    laid = written(
        spread.repartitionByRange(slices, *keys, *order, "_tie").sortWithinPartitions(*keys, *order, "_tie")
        .drop("_tie").withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_slice", F.shiftright("_place", PLACE_BITS))
    counts = laid.groupBy("_slice", *keys).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = counts.select(
        "_slice", *keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return laid.join(F.broadcast(carried), ["_slice", *keys]).select(
        *rows.columns, (F.col("_place") + F.col("_shift")).alias(name)
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node that links lead to.

    Each round gives a node the least label among its neighbours and itself, then the label of that
    label. Nothing is gathered per node, so that a node with very many links is no burden; tables are
    written after each step, from which the next joins read both sides and can split a hot node.
    """
    both = written(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select("b", "a")).filter(F.col("node") != F.col("other")).distinct(),
        "links",
    )
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("component")),
        "labels",
    )
    while True:
        offered = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node").agg(F.min("component").alias("offer"))
        )
        taken = written(
            labels.join(offered, "node").select(
                "node", F.least("component", "offer").alias("component"), "component", "offer"
            ).toDF("node", "component", "old", "offer").drop("offer"),
            "labels",
        )
        if taken.filter(F.col("component") != F.col("old")).isEmpty():
            return taken.select("node", "component")
        heads = taken.select(F.col("node").alias("component"), F.col("component").alias("head"))
        labels = written(
            taken.join(heads, "component", "left")
            .select("node", F.coalesce("head", "component").alias("component")),
            "labels",
        )
