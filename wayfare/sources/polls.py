"""Repeated bulk reads of a table, each compared with the one before.

A poll reads the whole table, as a connector in bulk mode does, and passes on only what has changed since the
last poll. Rows are compared by a hash, so that the shuffle of the old side carries keys and hashes alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.tables import REMOVED
from wayfare.session import written
from wayfare.streaming.keyed import KeyedTable

CHANGE = "change"


def _row_hash(columns: Sequence[str]) -> Column:
    # a null changes the number of fields that are hashed, not only their values
    return F.xxhash64(*[c for name in columns for c in (F.col(name).isNull(), F.col(name))])


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that are ``inserted`` or ``changed``, and keys that are ``removed``, with that in ``change``.

    Both have the same columns and one row per key, none null. A removed row has its key and no other value.
    """
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*keys, _row_hash(rest).alias("_before"))
    now = new.select("*", _row_hash(rest).alias("_now"))
    change = (
        F.when(F.col("_before").isNull(), F.lit("inserted")).when(F.col("_now").isNull(), F.lit("removed"))
        .when(F.col("_before") != F.col("_now"), F.lit("changed"))
    )
    return (
        now.join(before, list(keys), "full_outer").withColumn(CHANGE, change)
        .filter(F.col(CHANGE).isNotNull()).select(*new.columns, CHANGE)
    )


class Polls:
    """A table as its polls have shown it, with the changes of each poll."""

    def __init__(self, root: str, schema: T.StructType, keys: Sequence[str]):
        self.schema, self.keys = schema, list(keys)
        stored = T.StructType([*schema.fields, T.StructField(REMOVED, T.BooleanType())])
        self.table = KeyedTable(f"{root}/polled", stored, keys)

    def poll(self, snapshot: DataFrame, version: int) -> DataFrame:
        """Take in a bulk read as the state of ``version``, which rises; a poll that is repeated replaces itself."""
        spark = snapshot.sparkSession
        known = self.table.read(spark, before=version)
        changes = written(snapshot_changes(known, snapshot.select(*self.schema.names), self.keys), "poll")
        self.table.write(changes.withColumn(REMOVED, F.col(CHANGE) == "removed"), version)
        return changes
