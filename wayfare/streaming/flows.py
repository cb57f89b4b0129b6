"""The continuous form of the queries.

A flow is one streaming aggregate, mostly in update mode, whose changed rows go to a keyed table.
Aggregates of aggregates, which update mode does not allow, are batch plans over those
tables and share their code with the batch answers; they handle one row per key, not
one per trip.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from wayfare.functions.ratios import occupancy
from wayfare.functions.text import known_type
from wayfare.operators.extremes import least_per
from wayfare.operators.results import result_envelope, with_result_table
from wayfare.operators.tables import REMOVED, versions_only
from wayfare.plans import answers as A
from wayfare.schemas import RESULT_ROW, RESULT_TABLES
from wayfare.session import scratch, shared_path, stream_session, written
from wayfare.sources.json_log import decode_route_changes
from wayfare.sources.tables import events_as_trips, parts_as_routes, route_records
from wayfare.streaming.deltas import BUCKETS, INPUTS, Round, changed_answers
from wayfare.streaming.keyed import KeyedTable


def _places() -> tuple[Column, Column]:
    return F.min("event_id").alias("first_at"), F.max("event_id").alias("last_at")


@dataclass(frozen=True)
class Flow:
    """A streaming aggregate of one log, and the key of its rows."""

    log: str
    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    # update: every change as it comes; append: a row once, when it can no longer change
    mode: str = "update"
    # the part of the key that readers look rows up by, if not all of it
    looked_up_by: tuple[str, ...] = ()


def _counts(key: str) -> Callable[[DataFrame], DataFrame]:
    def rows(trips: DataFrame) -> DataFrame:
        return trips.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("trips"), *_places())
    return rows


def _hourly(key: str) -> Callable[[DataFrame], DataFrame]:
    """Counts per hour without grace: the watermark closes an hour once later trips have come."""
    def rows(trips: DataFrame) -> DataFrame:
        counts = (
            trips.filter(F.col(key).isNotNull())
            .withWatermark("ts", "0 seconds")
            .groupBy(F.window("ts", "1 hour").alias("hour"), key)
            .agg(F.count("*").alias("trips"), *_places())
        )
        start = F.col("hour")["start"].cast("timestamp_ntz").alias("window_start")
        return counts.select(start, key, "trips", "first_at", "last_at")
    return rows


def _total(total: str, value: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda log: log.groupBy(F.lit("total").alias("id")).agg(value().alias(total))


def _seat_sum() -> Column:
    return F.coalesce(F.sum("capacity"), F.lit(0)).cast("bigint")


def _seats(routes: DataFrame) -> DataFrame:
    return versions_only(routes).groupBy("route_id").agg(_seat_sum().alias("seats"))


def _latest(routes: DataFrame) -> DataFrame:
    """The latest record of a route; of a log with removals also whether it is one, which readers of the table obey."""
    removed = [REMOVED] if REMOVED in routes.columns else []
    version = F.max(F.struct("seq", "type", "operator", "capacity", *removed)).alias("version")
    return routes.groupBy("route_id").agg(version).select("route_id", "version.*")


FLOWS = {
    "route_trips": Flow("trips", ("route_id",), _counts("route_id")),
    "type_trips": Flow("trips", ("transport_type",), _counts("transport_type")),
    "passenger_trips": Flow("trips", ("passenger_name",), _counts("passenger_name")),
    "type_hours": Flow("trips", ("window_start", "transport_type"), _hourly("transport_type")),
    "closed_type_hours": Flow("trips", ("window_start", "transport_type"), _hourly("transport_type"), "append"),
    "route_hours": Flow(
        "trips", ("window_start", "route_id"), _hourly("route_id"), looked_up_by=("route_id",)
    ),
    "trip_total": Flow("trips", ("id",), _total("total_passengers", lambda: F.count("*"))),
    "route_seats": Flow("routes", ("route_id",), _seats),
    "route_latest": Flow("routes", ("route_id",), _latest),
    "seat_total": Flow("routes", ("id",), lambda routes: _total("total_seats", _seat_sum)(versions_only(routes))),
    # a list of passengers grows with every trip, so the trips are kept as rows and put together on reading
    "passenger_rows": Flow("trips", (), lambda trips: trips.select("event_id", "route_id", "passenger_name")),
}

# the flows that the answers need
RESULT_FLOWS = tuple(name for name in FLOWS if name != "closed_type_hours")

Handler = Callable[[DataFrame, int], None]

# Parts that a log is cut into for streams in several batches, and rows of a file of it.
BATCHES = 4
ROWS_PER_FILE = 1_000_000


@dataclass
class Flows:
    """Flows over a trip and a route stream, with their tables and checkpoints below ``root``."""

    spark: SparkSession
    root: str
    trips: DataFrame
    routes: DataFrame
    # folders by key of each table; more of them suit larger tables
    buckets: int = BUCKETS
    # work off what the logs hold by now and stop; {"processingTime": "10 seconds"} goes on
    trigger: Mapping[str, object] = field(default_factory=lambda: {"availableNow": True})

    def _log(self, name: str) -> DataFrame:
        return self.trips if FLOWS[name].log == "trips" else self.routes

    def table(self, name: str) -> KeyedTable:
        flow = FLOWS[name]
        schema = flow.rows(self._log(name)).schema
        return KeyedTable(
            f"{self.root}/tables/{name}", schema, flow.keys,
            buckets=self.buckets if flow.keys else 0, bucket_by=flow.looked_up_by,
        )

    def results(self) -> KeyedTable:
        """The result tables, a folder each."""
        schema = StructType([*RESULT_ROW.fields, StructField(REMOVED, BooleanType())])
        keys = ("result_table", "id", "part")
        return KeyedTable(
            f"{self.root}/tables/results", schema, keys,
            partition_by=keys[:1], buckets=self.buckets, bucket_by=keys[1:2],
        )

    def start(self, name: str, then: Handler | None = None) -> StreamingQuery:
        """Start a flow. ``then`` sees each batch after its rows are stored."""
        table = self.table(name)
        rows = FLOWS[name].rows(self._log(name).observe(name, F.count("*").alias("rows_in")))

        def store(changes: DataFrame, batch_id: int) -> None:
            if then is None:
                table.write(changes, batch_id)
                return
            changes.persist()
            table.write(changes, batch_id)
            then(changes, batch_id)
            changes.unpersist()

        return (
            rows.writeStream.queryName(name)
            .outputMode(FLOWS[name].mode)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .foreachBatch(store)
            .trigger(**self.trigger)
            .start()
        )

    def run(self, *names: str) -> None:
        """Run flows side by side until they end."""
        for query in [self.start(name) for name in names]:
            query.awaitTermination()

    def read(self, name: str, spark: SparkSession | None = None) -> DataFrame:
        return self.table(name).read(spark or self.spark)


def least_occupied_updates(flows: Flows) -> KeyedTable:
    """The least occupancy per type over all updates seen, kept batch by batch.

    Each changed count looks up the route version known at that moment; a count without one
    is dropped for good. Updates within one batch are seen as one.
    """
    schema = StructType().add("type", "string").add("occupancy", "double").add("at", "long").add("route_id", "long")
    table = KeyedTable(f"{flows.root}/tables/least_occupied", schema, ["type"])

    def fold(changes: DataFrame, batch_id: int) -> None:
        session = changes.sparkSession
        known = flows.read("route_latest", session)
        updates = changes.join(known, "route_id").select(
            known_type(F.col("type")).alias("type"),
            occupancy(F.col("trips"), F.col("capacity")).alias("occupancy"),
            F.col("last_at").alias("at"),
            "route_id",
        )
        best = least_per(table.read(session, before=batch_id).unionByName(updates), "type", "occupancy", "at")
        table.write(best, batch_id)

    flows.start("route_trips", fold).awaitTermination()
    return table


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream over a parquet file or folder of the given tables."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # written as a pattern, since a stream source takes a single file only that way
    return reader.parquet(path if "*" in path else f"{path[:-1]}[{path[-1]}]")


def write_log(rows: DataFrame, path: str, order: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> int:
    """``rows`` as files in ``order``, as a log would have left them; returns the number of files.

    There are at least ``BATCHES``, and more where a file would hold more rows than it should. A file stream
    goes by age, so the files are given times in their order. Rows without a place come first.
    """
    spark = rows.sparkSession
    n = max(BATCHES, math.ceil(rows.count() / rows_per_file))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")), key=str)
    now = int(time.time() * 1000)
    for place, file in enumerate(files):
        system.setTimes(file, now - len(files) + place, -1)
    return len(files)


def trip_stream(events: DataFrame) -> DataFrame:
    """Events as trips; a watermark needs an instant, and the session of a stream runs in UTC."""
    return events_as_trips(events).withColumn("ts", F.col("ts").cast("timestamp"))


def flows_over(spark: SparkSession, sf_dir: str, root: str | None = None, max_files: int | None = None) -> Flows:
    session = stream_session(spark)
    return Flows(
        session,
        root or shared_path(spark, "streams"),
        trip_stream(file_stream(session, f"{sf_dir}/events.parquet", max_files)),
        parts_as_routes(file_stream(session, f"{sf_dir}/part.parquet", max_files)),
    )


Sender = Callable[[DataFrame, str], None]


def publish(
    flows: Flows, spark: SparkSession, version: int, queries: Sequence[int] = tuple(RESULT_TABLES),
    send: Sender | None = None, **limits: int,
) -> DataFrame:
    """Bring the result tables up to the flows, as the state of ``version``, and read them.

    Versions must rise. Only what changed since the last version is worked out, see ``deltas``, and only rows that
    differ from what the tables hold are written. ``send`` gets these rows before, as envelopes, per result
    table, with the table's name, such as to put them to a topic; a row that is removed has no value. If
    a round fails on the way, the next one sends them again.
    """
    table = flows.results()
    tables = {flow: flows.table(flow) for query in queries for flow in INPUTS[query]}
    current = Round(spark, flows.root, version, tables, **limits)
    answers, marks = changed_answers(current, queries)
    if answers:
        changed = _differing(table, spark, version, answers)
        if send:
            changed = written(changed, "changed")
        for query in answers if send else ():
            rows = changed.filter(F.col("result_table") == RESULT_TABLES[query])
            gone = rows.filter(REMOVED).select(F.col("id").alias("key"), F.lit(None).cast("string").alias("value"))
            send(result_envelope(rows.filter(~F.col(REMOVED)), query).unionByName(gone), RESULT_TABLES[query])
        table.write(changed, version)
        current.finish(marks)
    return table.read(spark)


def _differing(table: KeyedTable, spark: SparkSession, version: int, answers: Mapping[int, DataFrame]) -> DataFrame:
    """Result rows of ``answers`` that the result tables do not hold as they are, and removals of those they hold."""
    rows = None
    for query, answer in answers.items():
        flag = F.col(REMOVED) if REMOVED in answer.columns else F.lit(False)
        part = with_result_table(answer.withColumn(REMOVED, flag), query, keep=[REMOVED])
        rows = part if rows is None else rows.unionByName(part)
    if table.last_batch(spark, before=version) is None:
        return rows.filter(~F.col(REMOVED))
    rows = written(rows, "candidates")
    # lists of names are new by the way they come about, and long: they are not compared
    names = RESULT_TABLES[4]
    others = rows.filter(F.col("result_table") != names)
    held = table.read(spark, before=version, only=others)
    same = others.filter(~F.col(REMOVED)).join(held, RESULT_ROW.names, "left_anti")
    gone = others.filter(REMOVED).join(held, table.keys, "left_semi")
    return rows.filter(F.col("result_table") == names).unionByName(same).unionByName(gone)


def keep_publishing(
    flows: Flows, spark: SparkSession, pause: float, rounds: int | None = None, send: Sender | None = None
) -> int:
    """Start all flows and publish again and again until they have ended; returns the last version.

    A version is a time in seconds, so that versions rise across restarts.
    """
    running = [flows.start(name) for name in RESULT_FLOWS]
    version = done = 0
    try:
        while True:
            ended = not any(query.isActive for query in running)
            for query in running:
                if query.exception() is not None:
                    raise query.exception()
            version = max(version + 1, int(time.time()))
            with scratch(spark):
                publish(flows, spark, version, send=send)
            done += 1
            if ended or done == rounds:
                return version
            time.sleep(pause)
    finally:
        for query in running:
            query.stop()


def hourly_type_counts_of(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    flows = flows_over(spark, sf_dir, max_files=max_files)
    flows.run("type_hours")
    return flows.read("type_hours", spark).select("window_start", "transport_type", "trips")


def closed_hours_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the hours that the log has passed, each written once."""
    flows = flows_over(spark, sf_dir)
    flows.run("closed_type_hours")
    return flows.read("closed_type_hours", spark).select("window_start", "transport_type", "trips")


def occupancy_per_route_of(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    flows = flows_over(spark, sf_dir, max_files=max_files)
    flows.run("route_trips", "route_seats")
    return A.q06_from(flows.read("route_trips", spark), flows.read("route_seats", spark))


def top_type_of(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    flows = flows_over(spark, sf_dir, max_files=max_files)
    flows.run("type_trips")
    return A.q11_from(flows.read("type_trips", spark))


def least_occupied_route_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = flows_over(spark, sf_dir)
    flows.run("route_trips", "route_latest")
    return A.q12_from(flows.read("route_trips", spark), flows.read("route_latest", spark))


def least_occupied_updates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All routes first, then the trips, whose updates look them up as they arrive."""
    flows = flows_over(spark, sf_dir)
    flows.run("route_latest")
    return least_occupied_updates(flows).read(spark)


def removals_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions 12 and 15 after two rounds, with the second half of a route log that removes routes in between."""
    folder, root = shared_path(spark, "removals"), shared_path(spark, "streams")
    session = stream_session(spark)
    log = route_records(spark, sf_dir)
    half = log.agg(F.max("seq")).first()[0] // 2
    for version, part in enumerate((log.filter(F.col("seq") <= half), log.filter(F.col("seq") > half))):
        write_log(part, f"{folder}/{version}", ["seq"])
        records = file_stream(session, f"{folder}/*")
        trips = trip_stream(file_stream(session, f"{sf_dir}/events.parquet"))
        flows = Flows(session, root, trips, decode_route_changes(records))
        flows.run("route_trips", "route_latest")
        answers = publish(flows, spark, version, queries=(12, 15))
    return answers


def results_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = flows_over(spark, sf_dir)
    flows.run(*RESULT_FLOWS)
    return publish(flows, spark, version=0)


def in_batches(answer: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``answer`` over the same events as files in log order, taken in ``BATCHES`` batches."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_path(spark, "batches")
        files = write_log(spark.read.parquet(f"{sf_dir}/events.parquet"), f"{folder}/events.parquet", ["event_id"])
        write_log(spark.read.parquet(f"{sf_dir}/part.parquet"), f"{folder}/part.parquet", ["p_partkey"])
        return answer(spark, folder, max_files=math.ceil(files / BATCHES))

    return run
