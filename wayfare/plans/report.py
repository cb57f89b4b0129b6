"""All thirteen answers at once, from a few shared passes over the logs.

Asked one by one the answers group the trip log by route five times and by type three
times. Here each grouping is made once, by the hour, and written to the shared folder; the
answers start from these tables, which have a row per key and hour at most.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wayfare.operators.changelog import route_table
from wayfare.operators.results import with_result_table
from wayfare.operators.rollups import regrouped, seats_per_route, trip_counts
from wayfare.operators.windows import hourly_route_counts, hourly_type_counts, hourly_type_occupancy
from wayfare.plans import answers as A
from wayfare.session import written


def all_answers(trips: DataFrame, routes: DataFrame) -> dict[int, DataFrame]:
    """Typed answers by number; 12 and 14 in the form over the full changelog. Every trip must have a time."""
    route_hours = written(hourly_route_counts(trips), "route_hours")
    type_hours = written(hourly_type_counts(trips), "type_hours")
    seats = written(seats_per_route(routes), "route_seats")
    table = written(route_table(routes, "type", "operator", "capacity"), "route_table")
    route_trips = regrouped(route_hours, "route_id")
    type_trips = regrouped(type_hours, "transport_type")
    total_trips = A.q07_total_passengers(trips)
    total_seats = A.q08_total_seats(seats.withColumnRenamed("seats", "capacity"))
    return {
        4: A.q04_passengers_per_route(trips),
        5: seats,
        6: A.q06_from(route_trips, seats),
        7: total_trips,
        8: total_seats,
        9: A.q09_from(total_trips, total_seats),
        10: A.q10_from(type_trips),
        11: A.q11_from(type_trips),
        12: A.q12_changelog_from(route_trips, table),
        13: A.q13_from(type_hours),
        14: A.q14_changelog_from(hourly_type_occupancy(route_hours, table)),
        15: A.q15_from(route_trips, table),
        16: A.q16_from(trip_counts(trips, "passenger_name")),
    }


def result_table_rows(answers: Mapping[int, DataFrame]) -> DataFrame:
    """(result_table, id, result) rows of the given answers."""
    rows = None
    for query, answer in answers.items():
        part = with_result_table(answer, query)
        rows = part if rows is None else rows.unionByName(part)
    return rows
