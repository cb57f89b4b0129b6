"""Ordered folds per key: concatenation of text, and folds given by the caller."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from wayfare.functions.text import NAME_SEPARATOR
from wayfare.operators.ordered import (
    ROWS_PER_TASK, hot_keys, row_count, running, running_count, running_sliced, running_with, split,
)
from wayfare.operators.rollups import ARRIVAL, at
from wayfare.session import shared_path

# A list of names this long is about a megabyte of text; longer lists go on in further parts.
NAMES_PER_PART = 50_000
ROWS_PER_FOLD = 50_000


def joined_names(
    trips: DataFrame,
    key: str,
    name: str,
    order: Sequence[str] = ARRIVAL,
    separator: str = NAME_SEPARATOR,
    names_per_part: int = NAMES_PER_PART,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Names per key in log order, as one text, duplicates kept: (key, part, names).

    A key with up to ``names_per_part`` rows has the single part 0. A longer one has
    part 0, 1, 2, ...; joined with the separator in that order they are the whole text,
    which as one cell could outgrow a task or the limit of a string.
    """
    keyed = trips.filter(F.col(key).isNotNull()).select(key, name, *order)
    text = F.expr(f"listagg(`{name}`, '{separator}') WITHIN GROUP (ORDER BY place)").alias("names")

    def joined(rows: DataFrame, part: Column) -> DataFrame:
        return rows.select(key, name, at(order).alias("place"), part.alias("part")).groupBy(key, "part").agg(text)

    whole = F.lit(0).cast("bigint")
    hot = hot_keys(keyed, [key], names_per_part)
    if hot is None:
        return joined(keyed, whole)
    # one branch per size of key, each put together before the union: rows numbered in a window by
    # key are in place for grouping by key and part, and need no second shuffle
    short, long = split(keyed, [key], hot, order)
    number, part = {"n": running_count()}, F.floor((F.col("n") - 1) / names_per_part)
    names = joined(short, whole)
    hotter = hot.filter(F.col("n") > rows_per_task)
    if not hotter.isEmpty():
        long, huge = split(long, [key], hotter, order)
        numbered = running_sliced(huge, [key], order, number, row_count(hotter), rows_per_task)
        names = names.unionByName(joined(numbered, part))
    return names.unionByName(joined(running_with(long, [key], order, number, None, rows_per_task), part))


def keyed_fold(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: Column,
    init: Column,
    step: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column] | None = None,
    rows_per_fold: int = ROWS_PER_FOLD,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(key, state): ``step`` folded over the values of a key in order, from ``init``.

    A key's rows are folded ``rows_per_fold`` at a time, and ``merge`` joins the states of neighbouring
    stretches, so that no array outgrows a task. All keys go this way, whatever their number of rows.
    ``init`` must be neutral for ``merge``, and ``order`` unique within a key. Without a ``merge`` the state of a
    stretch is carried into the next one, in passes of ``ROWS_PER_FOLD`` rows of each key, or of ``rows_per_fold``
    if these are more.
    """
    def folded(groups: GroupedData, columns: Sequence[str], item: str, function) -> DataFrame:
        items = F.array_sort(F.collect_list(F.struct(*columns, item)))
        return groups.agg(F.aggregate(items, init, lambda acc, x: function(acc, x[item])).alias("state"))

    rows = df.filter(F.col(key).isNotNull()).select(key, *order, value.alias("value"))
    placed = running(rows, [key], order, {"n": running_count()}, rows_per_task)
    chunks = placed.withColumn("chunk", F.floor((F.col("n") - 1) / rows_per_fold))
    if merge is None:
        return _folded_in_passes(chunks, key, order, init, step, max(1, ROWS_PER_FOLD // rows_per_fold))
    by_chunk = folded(chunks.groupBy(key, "chunk"), order, "value", step)
    stretches = by_chunk.withColumn("stretch", F.floor(F.col("chunk") / rows_per_fold))
    by_stretch = folded(stretches.groupBy(key, "stretch"), ["chunk"], "state", merge)
    return folded(by_stretch.groupBy(key), ["stretch"], "state", merge)


def _folded_in_passes(
    chunks: DataFrame, key: str, order: Sequence[str], init: Column, step: Callable[[Column, Column], Column],
    chunks_per_pass: int,
) -> DataFrame:
    """A fold whose states cannot be merged. Chunks lie in a folder per pass, so that each is read once.

    A pass goes through some chunks of every key that has as many, and hands its states on through the shared
    folder: the time follows the longest key, the work all rows. The last state of a key is its result.
    """
    spark = chunks.sparkSession
    path, states = shared_path(spark, "chunks"), shared_path(spark, "states")
    arrays = (
        chunks.withColumn("pass", F.floor(F.col("chunk") / chunks_per_pass))
        .repartition(key, "pass").groupBy(key, "pass", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct(*order, "value"))).alias("items"))
    )
    arrays.write.partitionBy("pass").parquet(path)
    read = spark.read.schema(arrays.schema).parquet(path)
    last = read.agg(F.max("pass")).first()[0]
    if last is None:
        return chunks.select(key, init.alias("state"))
    schema = None
    for number in range(last + 1):
        parts = read.filter(F.col("pass") == number).groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct("chunk", "items"))).alias("parts")
        )
        start = init
        if number:
            before = spark.read.schema(schema).parquet(f"{states}/pass={number - 1}")
            parts, start = parts.join(before, key), F.col("state")
        items = F.flatten(F.transform("parts", lambda part: part["items"]))
        folded = F.aggregate(items, start, lambda acc, x: step(acc, x["value"]))
        reached = parts.select(key, folded.alias("state"))
        schema = schema or reached.schema
        reached.write.parquet(f"{states}/pass={number}")
    passed = spark.read.schema(schema.add("pass", "long")).parquet(states)
    return passed.groupBy(key).agg(F.max_by("state", "pass").alias("state"))
