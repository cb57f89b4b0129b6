"""Answers in the shape of the result tables: (id, part, result), and the JSON envelope around it.

Only the name lists of question 4 have parts beyond 0; id and part together are the key of every table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.text import count_text, name_occupancy_text, percent_text, route_occupancy_text, two_decimals
from wayfare.schemas import ENVELOPE_NAMES, RESULT_IDS, RESULT_TABLES

# Questions whose answer can be longer than a cell should be.
IN_PARTS = (4,)


def _fixed(query: int) -> Callable[[], Column]:
    return lambda: F.lit(RESULT_IDS[query])


_ID: dict[int, Callable[[], Column]] = {
    4: lambda: F.col("route_id"),
    5: lambda: F.col("route_id"),
    6: lambda: F.col("route_id"),
    10: lambda: F.col("transport_type"),
    12: lambda: F.col("type"),
    **{query: _fixed(query) for query in RESULT_IDS},
}

_RESULT: dict[int, Callable[[], Column]] = {
    4: lambda: F.col("passengers"),
    5: lambda: F.col("seats"),
    6: lambda: percent_text(F.col("occupancy_pct")),
    7: lambda: F.col("total_passengers"),
    8: lambda: F.col("total_seats"),
    9: lambda: percent_text(F.col("occupancy_pct")),
    10: lambda: two_decimals(F.col("avg_passengers")),
    11: lambda: count_text(F.col("transport_type"), F.col("passengers")),
    12: lambda: route_occupancy_text(F.col("route_id"), F.col("occupancy")),
    13: lambda: count_text(F.col("transport_type"), F.col("trips")),
    14: lambda: name_occupancy_text(F.col("type"), F.col("occupancy")),
    15: lambda: name_occupancy_text(F.col("operator"), F.col("occupancy")),
    16: lambda: count_text(F.col("passenger_name"), F.col("trips")),
}


def result_rows(answer: DataFrame, query: int, keep: Sequence[str] = ()) -> DataFrame:
    """(id, part, result) of the typed answer to question ``query``; ``keep`` passes columns through."""
    part = F.col("part") if query in IN_PARTS else F.lit(0)
    return answer.select(
        _ID[query]().cast("string").alias("id"), part.cast("bigint").alias("part"),
        _RESULT[query]().cast("string").alias("result"),
        *keep,
    )


def with_result_table(answer: DataFrame, query: int, keep: Sequence[str] = ()) -> DataFrame:
    name = F.lit(RESULT_TABLES[query]).alias("result_table")
    return result_rows(answer, query, keep).select(name, "id", "part", "result", *keep)


def result_envelope(rows: DataFrame, query: int) -> DataFrame:
    """(key, value): each result row as JSON with its schema beside it. Answers in parts carry the part too."""
    kinds = {"id": "string", "result": "string", **({"part": "int64"} if query in IN_PARTS else {})}

    def field(name: str) -> Column:
        return F.struct(F.lit(name).alias("field"), F.lit(kinds[name]).alias("type"))

    schema = F.struct(
        F.lit("struct").alias("type"),
        F.array(*map(field, kinds)).alias("fields"),
        F.lit(False).alias("optional"),
        F.lit(ENVELOPE_NAMES[query]).alias("name"),
    )
    return rows.select(
        F.col("id").alias("key"),
        F.to_json(F.struct(schema.alias("schema"), F.struct(*kinds).alias("payload"))).alias("value"),
    )
