"""Running values along a log, also where one key holds much of it.

A window partitioned by key sorts a whole key in one task. That is the plan for keys of
known, moderate size. The rows of larger keys are set apart and range-partitioned by key
and order, which cuts them into slices of about equal size; each slice gets its local
running value, and the totals of the slices before it are carried in. The table of
totals has one row per key and slice, so the carry is cheap, and no row is lost or
approximated on either way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.operators.joins import joiner
from wayfare.session import written

ROWS_PER_TASK = 4_000_000
# Slices below this size share a task and its file, so that a low limit does not make a task of every few rows.
LEAST_ROWS_PER_TASK = 250_000
# Bits below the partition in a number of monotonically_increasing_id.
ROW_BITS = 33


@dataclass(frozen=True)
class Running:
    """A running value: within a slice, of a whole slice, over the slices before, and combined."""

    local: Column
    total: Callable[[Sequence[str]], Column]
    over_totals: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    # the rows that the total depends on, if not all
    only: Column | None = None


def running_count(condition: Column | None = None) -> Running:
    counted = F.lit(1) if condition is None else F.when(condition, 1)
    return Running(
        local=F.count(counted),
        total=lambda order: F.count(counted),
        over_totals=F.sum,
        combine=lambda before, here: F.coalesce(before, F.lit(0).cast("bigint")) + here,
    )


def running_sum(value: Column) -> Running:
    return Running(
        local=F.sum(value),
        total=lambda order: F.sum(value),
        over_totals=F.sum,
        combine=lambda before, here: F.coalesce(before + here, here, before),
    )


def running_max(value: Column) -> Running:
    return Running(
        local=F.max(value),
        total=lambda order: F.max(value),
        over_totals=F.max,
        combine=lambda before, here: F.greatest(before, here),
    )


def running_last(value: Column) -> Running:
    """The latest value that is not null."""
    return Running(
        local=F.last(value, ignorenulls=True),
        total=lambda order: F.max_by(value, F.when(value.isNotNull(), F.struct(*order))),
        over_totals=lambda total: F.last(total, ignorenulls=True),
        combine=lambda before, here: F.coalesce(here, before),
        only=value.isNotNull(),
    )


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """(keys, n) of the keys with more than ``limit`` rows, or None if there is none, the usual case.

    One hash aggregate over the key columns decides. At most rows / limit keys can be hot.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    hot = written(sizes, "hot_keys")
    return None if hot.isEmpty() else hot


def split(
    df: DataFrame, keys: Sequence[str], hot: DataFrame, spread_by: Sequence[str], **limits: int
) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of the ``hot`` keys).

    ``df`` is read once for both, and for whatever reads them again, as sampling for slices does: its rows
    are written with a flag, in the columns it has, which callers keep narrow.
    """
    if not keys:
        return df.filter(F.lit(False)), df
    known = hot.select(*keys, F.lit(True).alias("_hot"))
    flagged = written(joiner(known, keys, spread_by, **limits)(df, "left"), "flagged").select(*df.columns, "_hot")
    return flagged.filter(F.col("_hot").isNull()).drop("_hot"), flagged.filter("_hot").drop("_hot")


def row_count(hot: DataFrame) -> int:
    return hot.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def slice_number(rows: int, rows_per_slice: int, parallel: int) -> int:
    """Slices of at most ``rows_per_slice`` rows; smaller ones as long as tasks would be idle otherwise."""
    needed = math.ceil(rows / rows_per_slice)
    useful = min(parallel, math.ceil(8 * rows / rows_per_slice))
    return max(1, needed, useful)


def task_number(slices: int, rows: int, parallel: int) -> int:
    """Tasks that make the slices: one each, unless that leaves a task fewer than ``LEAST_ROWS_PER_TASK`` rows."""
    return min(slices, max(parallel, math.ceil(rows / LEAST_ROWS_PER_TASK)))


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, rows_per_slice: int) -> DataFrame:
    """``df`` with a column ``slice`` that rises with (keys, order), written to the shared folder.

    ``order`` must be unique within a key. Writing fixes the slice of each row: range
    bounds come from a sample, so a second evaluation could draw them differently.
    Small slices are cut within sorted partitions, so tasks and files follow the rows and not the limit.
    """
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = slice_number(rows, rows_per_slice, parallel)
    tasks = task_number(n, rows, parallel)
    ranged = df.repartitionByRange(tasks, *keys, *order)
    if tasks == n:
        return written(ranged.withColumn("slice", F.spark_partition_id()), "slices")
    numbered = ranged.sortWithinPartitions(*keys, *order).withColumn("slice", F.monotonically_increasing_id())
    # a slice is named by its first row
    place = F.col("slice").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return written(numbered.withColumn("slice", F.col("slice") - place % rows_per_slice), "slices")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Running],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``df`` with a running value per entry of ``columns``, per key along ``order``.

    ``order`` must be unique within a key, and keys not null. No keys means one log.
    """
    return running_with(df, keys, order, columns, hot_keys(df, keys, rows_per_task), rows_per_task)


def running_with(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Running],
    hot: DataFrame | None,
    rows_per_task: int,
) -> DataFrame:
    """:func:`running` for a caller that knows the keys with more than ``rows_per_task`` rows."""
    window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = [c.local.over(window).alias(name) for name, c in columns.items()]
    if hot is None:
        return df.select("*", *local)
    moderate, large = split(df, keys, hot, order)
    in_slices = running_sliced(large, keys, order, columns, row_count(hot), rows_per_task)
    return moderate.select("*", *local).unionByName(in_slices)


def running_sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Running],
    rows: int, rows_per_task: int,
) -> DataFrame:
    """:func:`running` for ``rows`` rows of hot keys: slice by slice, with the totals before carried in."""
    rows_in = sliced(df, keys, order, rows, rows_per_task)
    window = W.partitionBy("slice", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows_in.select("*", *[c.local.over(window).alias(name) for name, c in columns.items()])

    on = ["slice", *keys]
    of_all = [c.total(order).alias(name) for name, c in columns.items() if c.only is None]
    totals = rows_in.groupBy(*on).agg(F.count("*").alias("slice_rows"), *of_all)
    for name, c in columns.items():
        # a total over few rows, such as the last route version, is aggregated from these alone
        if c.only is not None:
            totals = totals.join(rows_in.filter(c.only).groupBy(*on).agg(c.total(order).alias(name)), on, "left")
    earlier = W.partitionBy(*keys).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(
        *on,
        *[c.over_totals(F.col(name)).over(earlier).alias(f"{name}_before") for name, c in columns.items()],
    )
    joined = local.join(carried, on)
    return joined.select(
        *df.columns, *[c.combine(F.col(f"{name}_before"), F.col(name)).alias(name) for name, c in columns.items()]
    )
