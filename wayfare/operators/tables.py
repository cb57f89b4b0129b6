"""Keyed tables: latest row per key, insert-or-update, new ids, domain checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.ordered import ROWS_PER_TASK, running, running_count


# The column that marks a record as the removal of its key, as a null value does in a compacted topic.
REMOVED = "removed"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], removed: str | None = None
) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate rather than a window: each task sends at most one row per key, so a key
    with many versions costs the shuffle no more than any other. A key whose latest row has the flag
    ``removed`` has no row; later ones bring it back. The flag itself is not in the result.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    latest = F.max(F.struct(*order, *rest)).alias("latest")
    rows = df.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*df.columns)
    return rows if removed is None else without_removed(rows, removed)


def without_removed(rows: DataFrame, removed: str = REMOVED) -> DataFrame:
    """The rows that are no removals, without the flag."""
    return rows.filter(~F.coalesce(removed, F.lit(False))).drop(removed)


def versions_only(log: DataFrame) -> DataFrame:
    """A log without the removals in it, if it can have any."""
    return without_removed(log) if REMOVED in log.columns else log


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``base`` with ``changes`` put over it: a known key is replaced, a new one added.

    Several changes of one key apply in the order of ``order``, a column of ``changes`` only. Changes with
    a column ``removed`` take keys away where it is set.
    """
    columns = base.columns
    removed = REMOVED if REMOVED in changes.columns and REMOVED not in columns else None
    old = base.select(*columns, F.lit(0).alias("is_change"), *[
        F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in order
    ], *([F.lit(False).alias(REMOVED)] if removed else []))
    new = changes.select(*columns, F.lit(1).alias("is_change"), *order, *([REMOVED] if removed else []))
    return latest_per_key(old.unionByName(new), keys, ["is_change", *order], removed).select(*columns)


def with_new_ids(
    base: DataFrame, changes: DataFrame, key: str, order: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``changes`` where a row without a key gets the next free one, in the order of ``order``.

    Numbers follow the greatest key of either side without gaps, and the numbering is spread
    over tasks like any other running count.
    """
    known = changes.filter(F.col(key).isNotNull())
    numbered = running(changes.filter(F.col(key).isNull()), [], order, {"n": running_count()}, rows_per_task)
    top = base.select(key).unionByName(known.select(key)).agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    added = numbered.withColumn(key, top.scalar() + F.col("n")).select(*changes.columns)
    return known.unionByName(added)


def checked(df: DataFrame, domains: Mapping[str, Sequence[str]], required: Sequence[str]) -> DataFrame:
    """``df`` with ``violation``: the first broken rule of a row, or null where all hold."""
    rules: list[Column] = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    rules += [
        F.when(~F.col(c).isin(*values), F.concat(F.lit(f"{c} not allowed: "), F.col(c)))
        for c, values in domains.items()
    ]
    return df.withColumn("violation", F.coalesce(*rules))


def split_checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their violation)."""
    return rows.filter("violation IS NULL").drop("violation"), rows.filter("violation IS NOT NULL")
