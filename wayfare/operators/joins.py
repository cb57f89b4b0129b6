"""Joins of a log with a table that is unique by key, safe for hot keys and for any size of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.session import written

# A table up to this size is sent to every task; it is measured, not guessed.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that one task joins; a key with more is spread over as many tasks as that takes.
ROWS_PER_SALT = 4_000_000


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as rows of text and 16 bytes per field, by one aggregate over it."""
    text = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields]
    width = sum((t + 16 for t in text), F.lit(0).cast("bigint"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def join_by_key(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``rows`` joined with a ``table`` that has at most one row per key.

    A table of a moderate size is broadcast. A larger one is joined by key, and where a key has more
    than ``rows_per_salt`` of the ``rows``, on (key, salt): its rows are spread over as many salts as
    that takes by the hash of ``spread_by``, and its row of the table is copied for each. Other keys
    are not copied.
    """
    return joiner(table, keys, spread_by, broadcast_bytes, rows_per_salt)(rows, how)


def joiner(
    table: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
):
    """:func:`join_by_key` with one table for several joins, whose size is measured once."""
    if measured_bytes(table) <= broadcast_bytes:
        return lambda rows, how: rows.join(F.broadcast(table), list(keys), how)

    def salted(rows: DataFrame, how: str) -> DataFrame:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_salt)
        # at most one key per rows_per_salt rows, hence small beside either side
        hot = written(counts.select(*keys, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")), "hot_keys")
        if hot.isEmpty():
            return rows.join(table, list(keys), how)
        spread = F.pmod(F.xxhash64(*spread_by), F.coalesce("_salts", F.lit(1))).cast("int")
        left = rows.join(hot, list(keys), "left").withColumn("_salt", spread).drop("_salts")
        copies = table.join(hot, list(keys), "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        ).drop("_salts")
        return left.join(copies, [*keys, "_salt"], how).drop("_salt")

    return salted
