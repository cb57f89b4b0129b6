"""Answers by change: what a publishing round has to do follows what has changed since the last one.

For each question and each flow that it reads, the last batch taken into account is kept. A round reads the
rows that changed since, finds the keys of the answer that they touch, and works out these alone:

- totals per key (5, 7, 8, 10) are the changed rows; 9 is a row from two totals;
- 6 is a join of which either side may have changed: changed trip counts meet all seats, changed seats
  all trip counts, by the keys of both;
- the best of growing values (11, 13, 16) is the best of the last winner and the changed rows, and so are the
  least and greatest occupancies (12, 15), as long as no route has a new version or is removed;
- the least first occupancy of an hour (14) is kept per hour and type; changed routes offer theirs anew;
- lists of names (4) have parts that never change once they are full; only the open one is kept aside and
  goes on.

A changed route version can raise as well as lower what 12, 14 and 15 compare. They are then worked out
from the tables per route, which have no row per trip, and what is no longer there is removed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.text import NAME_SEPARATOR
from wayfare.operators.folds import NAMES_PER_PART
from wayfare.operators.joins import join_by_key
from wayfare.operators.ordered import ROWS_PER_TASK, running, running_count
from wayfare.operators.rollups import ARRIVAL
from wayfare.operators.tables import REMOVED
from wayfare.operators.windows import hourly_type_occupancy
from wayfare.plans import answers as A
from wayfare.session import written
from wayfare.streaming.keyed import Keys, KeyedTable

# Folders by key of the state kept here and of the flows' tables; more of them suit larger tables.
BUCKETS = 8

# the flows that a question reads
INPUTS = {
    4: ("passenger_rows",), 5: ("route_seats",), 6: ("route_trips", "route_seats"), 7: ("trip_total",),
    8: ("seat_total",), 9: ("trip_total", "seat_total"), 10: ("type_trips",), 11: ("type_trips",),
    12: ("route_trips", "route_latest"), 13: ("type_hours",), 14: ("route_hours", "route_latest"),
    15: ("route_trips", "route_latest"), 16: ("passenger_trips",),
}

_REMOVABLE = T.StructField(REMOVED, T.BooleanType())


def _schema(*fields: tuple[str, T.DataType], removable: bool = False) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields] + ([_REMOVABLE] if removable else []))


MARKS = _schema(("query", T.IntegerType()), ("flow", T.StringType()), ("upto", T.LongType()))
# the best so far per question, and per type for question 12: the least measure, the first of equal ones
BESTS = _schema(
    ("query", T.IntegerType()), ("id", T.StringType()), ("measure", T.DoubleType()), ("at", T.LongType()),
    ("label", T.StringType()), ("route_id", T.LongType()), ("window_start", T.TimestampNTZType()), removable=True,
)
HOURS = _schema(
    ("window_start", T.TimestampNTZType()), ("type", T.StringType()), ("first_occupancy", T.DoubleType()),
    ("first_at", T.LongType()), ("route_id", T.LongType()), removable=True,
)
OPEN_NAMES = _schema(
    ("route_id", T.LongType()), ("part", T.LongType()), ("n", T.LongType()), ("names", T.StringType())
)

_BEST_OF = (11, 12, 13, 15, 16)


@dataclass
class Round:
    """One publishing round: the state before it, and what it will leave when it has been carried through."""

    spark: SparkSession
    root: str
    version: int
    tables: Mapping[str, KeyedTable]
    names_per_part: int = NAMES_PER_PART
    rows_per_task: int = ROWS_PER_TASK
    _marks: dict[tuple[int, str], int] | None = None
    _keys: dict[tuple, Keys] = field(default_factory=dict)
    _after: list[tuple[KeyedTable, DataFrame]] = field(default_factory=list)

    def state(self, name: str) -> KeyedTable:
        schema, keys, buckets = {
            "marks": (MARKS, ["query", "flow"], 0),
            "bests": (BESTS, ["query", "id"], 0),
            "hour_firsts": (HOURS, ["window_start", "type"], BUCKETS),
            "open_names": (OPEN_NAMES, ["route_id"], BUCKETS),
        }[name]
        return KeyedTable(f"{self.root}/tables/{name}", schema, keys, buckets=buckets)

    def before(self, name: str, only: Keys | None = None) -> DataFrame:
        return self.state(name).read(self.spark, before=self.version, only=only)

    def mark(self, query: int, flow: str) -> int | None:
        if self._marks is None:
            # a row per question and flow
            self._marks = {(r["query"], r["flow"]): r["upto"] for r in self.before("marks").collect()}
        return self._marks.get((query, flow))

    def changed(self, query: int, flow: str) -> bool:
        last = self.tables[flow].last_batch(self.spark)
        return last is not None and last != self.mark(query, flow)

    def changes(self, query: int, flow: str) -> DataFrame:
        """Rows of ``flow`` that ``query`` has not seen."""
        return self.tables[flow].since(self.spark, self.mark(query, flow))

    def changed_routes(self, query: int, *flows: str) -> Keys | None:
        """The routes in the changes of ``flows``, or None at first, when all are new. Questions share them."""
        seen = tuple((flow, self.mark(query, flow)) for flow in flows)
        if any(mark is None for _, mark in seen):
            return None
        if seen not in self._keys:
            parts = [self.changes(query, flow).select("route_id").dropna() for flow in flows]
            self._keys[seen] = Keys(reduce(DataFrame.unionByName, parts))
        return self._keys[seen]

    def now(self, flow: str, only: Keys | None = None) -> DataFrame:
        return self.tables[flow].read(self.spark, only=only)

    def keep(self, name: str, rows: DataFrame) -> None:
        self._after.append((self.state(name), rows))

    def finish(self, marks: Sequence[tuple[int, str, int]]) -> None:
        """Store the new state. A round that ends before this is repeated by the next one, which changes nothing."""
        for table, rows in self._after:
            table.write(rows, self.version)
        self.state("marks").write(self.spark.createDataFrame(list(marks), MARKS), self.version)


def _names(r: Round) -> DataFrame:
    """Question 4: the parts that new trips fall into. The open part of a route is put in front of its new names."""
    new = r.changes(4, "passenger_rows").filter(F.col("route_id").isNotNull())
    open_parts = r.before("open_names", only=r.changed_routes(4, "passenger_rows")).select(
        "route_id", F.col("part").alias("open"), F.col("n").alias("held"), F.col("names").alias("so_far")
    )
    numbered = running(new, ["route_id"], list(ARRIVAL), {"i": running_count()}, r.rows_per_task)
    zero = F.lit(0).cast("bigint")
    placed = join_by_key(numbered, open_parts.select("route_id", "open", "held"), ["route_id"], "left", ARRIVAL).select(
        "route_id", "passenger_name", "event_id",
        (F.coalesce("open", zero) + F.floor((F.coalesce("held", zero) + F.col("i") - 1) / r.names_per_part)).alias("part"),
    )
    listed = F.expr(f"listagg(passenger_name, '{NAME_SEPARATOR}') WITHIN GROUP (ORDER BY event_id)")
    parts = placed.groupBy("route_id", "part").agg(listed.alias("added"), F.count("*").alias("n"))
    goes_on = F.col("part") == F.col("open")
    names = F.concat_ws(NAME_SEPARATOR, F.when(goes_on, F.col("so_far")), "added")
    lists = written(parts.join(open_parts, "route_id", "left").select(
        "route_id", "part",
        # an empty list of names is none, but a list of one empty name is a text
        F.when(F.coalesce(F.when(goes_on, F.col("so_far")), F.col("added")).isNotNull(), names).alias("passengers"),
        (F.col("n") + F.when(goes_on, F.col("held")).otherwise(0)).alias("n"),
    ), "names")
    last = lists.groupBy("route_id").agg(F.max("part").alias("part"))
    r.keep("open_names", lists.join(last, ["route_id", "part"]).select(
        "route_id", "part", "n", F.col("passengers").alias("names")
    ))
    return lists.select("route_id", "part", "passengers")


def _occupancy(r: Round) -> DataFrame:
    """Question 6: the routes that changed on either side, joined anew."""
    keys = r.changed_routes(6, "route_trips", "route_seats")
    return A.q06_from(r.now("route_trips", only=keys), r.now("route_seats", only=keys))


def _best(measure: Column, at: str, label: str, query: int, id: Column | None = None, **more: str) -> list[Column]:
    none = {"route_id": F.lit(None).cast("long"), "window_start": F.lit(None).cast("timestamp_ntz")}
    return [
        F.lit(query).alias("query"), (F.lit("") if id is None else id).alias("id"),
        measure.cast("double").alias("measure"), F.col(at).alias("at"), F.col(label).alias("label"),
        *[(F.col(more[name]) if name in more else none[name]).alias(name) for name in none],
    ]


def _candidates(r: Round, query: int, complete: bool) -> DataFrame:
    """Rows that can be the new best of ``query``: all of them if ``complete``, else the changed ones."""
    flow = INPUTS[query][0]
    rows = r.now(flow) if complete else r.changes(query, flow)
    if query == 13:
        return rows.select(*_best(-F.col("trips"), "last_at", "transport_type", 13, window_start="window_start"))
    if query in (11, 16):
        name = {11: "transport_type", 16: "passenger_name"}[query]
        return rows.select(*_best(-F.col("trips"), "last_at", name, query))
    table = r.now("route_latest", only=None if complete else r.changed_routes(query, flow))
    if query == 12:
        least = A.least_updates(rows, table)
        return least.select(*_best(F.col("occupancy"), "first_at", "type", 12, F.col("type"), route_id="route_id"))
    peaks = A.operator_peaks(rows, table)
    return peaks.select(*_best(-F.col("occupancy"), "reached_at", "operator", 15, route_id="route_id"))


def _bests(r: Round, queries: Sequence[int]) -> dict[int, DataFrame]:
    """Questions 11, 12, 13, 15 and 16 together: per question, and per type, the best of the old best and new rows."""
    complete = [q for q in queries if "route_latest" in INPUTS[q] and r.changed(q, "route_latest")]
    old = r.before("bests").filter(F.col("query").isin(*queries))
    rows = old.filter(~F.col("query").isin(*complete)) if complete else old
    for query in queries:
        rows = rows.unionByName(_candidates(r, query, query in complete))
    keys, rest = ["query", "id"], ["label", "route_id", "window_start"]
    best = F.min(F.struct("measure", "at", *rest)).alias("best")
    bests = written(rows.groupBy(*keys).agg(best).select(*keys, "best.*"), "bests")
    gone = old.join(bests, keys, "left_anti")
    changed = bests.withColumn(REMOVED, F.lit(False)).unionByName(gone.withColumn(REMOVED, F.lit(True)))
    r.keep("bests", changed)
    return {query: _answer(query, changed.filter(F.col("query") == query)) for query in queries}


def _answer(query: int, best: DataFrame) -> DataFrame:
    """Bests as the typed answer of their question, with removals."""
    number = (-F.col("measure")).cast("long")
    columns = {
        11: [F.col("label").alias("transport_type"), number.alias("passengers")],
        12: [F.col("label").alias("type"), F.col("route_id"), F.col("measure").alias("occupancy")],
        13: [F.col("window_start"), F.col("label").alias("transport_type"), number.alias("trips")],
        15: [F.col("label").alias("operator"), F.col("route_id"), (-F.col("measure")).alias("occupancy")],
        16: [F.col("label").alias("passenger_name"), number.alias("trips")],
    }[query]
    return best.select(*columns, REMOVED)


def _least_hour(r: Round) -> DataFrame:
    """Question 14: the least of the first occupancies of all hours and types."""
    complete = r.changed(14, "route_latest")
    routes = None if complete else r.changed_routes(14, "route_hours")
    offered = hourly_type_occupancy(r.now("route_hours", only=routes), r.now("route_latest", only=routes)).select(
        "window_start", "type", "first_occupancy", "first_at", "first_route"
    ).withColumnRenamed("first_route", "route_id")
    keys = ["window_start", "type"]
    old = r.before("hour_firsts")
    if complete:
        firsts = offered.withColumn(REMOVED, F.lit(False))
        gone = old.join(offered, keys, "left_anti").withColumn(REMOVED, F.lit(True))
        firsts = written(firsts.unionByName(gone), "firsts")
        rows = firsts.filter(~F.col(REMOVED))
    else:
        others = old if routes is None else old.join(routes.frame, "route_id", "left_anti")
        first = F.min(F.struct("first_at", "first_occupancy", "route_id")).alias("first")
        rows = written(
            others.unionByName(offered).groupBy(*keys).agg(first).select(*keys, "first.*").select(*offered.columns), "firsts"
        )
        firsts = rows.join(old, offered.columns, "left_anti").withColumn(REMOVED, F.lit(False))
    r.keep("hour_firsts", firsts)
    found = written(A.q14_changelog_from(rows), "least_hour")
    return found.withColumn(REMOVED, F.lit(False)) if not found.isEmpty() else _nothing(found)


def _nothing(answer: DataFrame) -> DataFrame:
    """The removal of a one-row answer that no longer exists."""
    return answer.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in answer.schema.fields], F.lit(True).alias(REMOVED)
    )


def changed_answers(r: Round, queries: Sequence[int]) -> tuple[dict[int, DataFrame], list[tuple[int, str, int]]]:
    """(typed answers with the rows that may have changed, marks to keep) for those of ``queries`` with any change.

    A row with ``removed`` set has no other use than its id.
    """
    open_queries = [q for q in queries if any(r.changed(q, flow) for flow in INPUTS[q])]
    marks = [
        (q, flow, last) for q in open_queries for flow in INPUTS[q]
        if (last := r.tables[flow].last_batch(r.spark)) is not None
    ]
    simple: dict[int, Callable[[], DataFrame]] = {
        4: lambda: _names(r),
        5: lambda: r.changes(5, "route_seats"),
        6: lambda: _occupancy(r),
        7: lambda: r.changes(7, "trip_total").select("total_passengers"),
        8: lambda: r.changes(8, "seat_total").select("total_seats"),
        9: lambda: A.q09_from(r.now("trip_total").drop("id"), r.now("seat_total").drop("id")),
        10: lambda: A.q10_from(r.changes(10, "type_trips")),
        14: lambda: _least_hour(r),
    }
    answers = {q: simple[q]() for q in open_queries if q in simple}
    best_of = [q for q in open_queries if q in _BEST_OF]
    if best_of:
        answers |= _bests(r, best_of)
    return answers, marks
