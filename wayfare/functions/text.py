"""Text forms of results, and the parsers of those forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: labels, arrows and number formats of the text forms --------------------------
ROUTE_LABEL = "RouteId: "
TYPE_LABEL = " Type: "
OCCUPANCY_LABEL = " Occupancy: "
ROUTE_ARROW = " -> Occupancy: "
COUNT_ARROW = "->"
OCCUPANCY_ARROW = " -> "
NAME_SEPARATOR = ", "
UNKNOWN_TYPE = "UNKNOWN"
TWO_DECIMALS = "%.2f"
PERCENT = "%.2f%%"
# --- end of fixed values ------------------------------------------------------------------------

OCCUPANCY_PATTERN = rf"^{ROUTE_LABEL}(\d+){TYPE_LABEL}(.*){OCCUPANCY_LABEL}(\S+)$"


def two_decimals(x: Column) -> Column:
    return F.format_string(TWO_DECIMALS, x)


def percent_text(x: Column) -> Column:
    return F.format_string(PERCENT, x)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def count_text(name: Column, n: Column) -> Column:
    return _text(name, COUNT_ARROW, n)


def name_occupancy_text(name: Column, occupancy: Column) -> Column:
    return _text(name, OCCUPANCY_ARROW, occupancy)


def route_occupancy_text(route_id: Column, occupancy: Column) -> Column:
    return _text(ROUTE_LABEL, route_id, ROUTE_ARROW, occupancy)


def known_type(transport_type: Column) -> Column:
    return F.coalesce(transport_type, F.lit(UNKNOWN_TYPE))


def occupancy_text(route_id: Column, transport_type: Column, occupancy: Column) -> Column:
    return _text(ROUTE_LABEL, route_id, TYPE_LABEL, known_type(transport_type), OCCUPANCY_LABEL, occupancy)


def parse_occupancy_text(text: Column) -> Column:
    """(route_id, type, occupancy) of an occupancy record; exponents are read in full."""
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(text, OCCUPANCY_PATTERN, i), F.lit(""))

    return F.struct(
        part(1).cast("bigint").alias("route_id"),
        known_type(part(2)).alias("type"),
        part(3).cast("double").alias("occupancy"),
    )
