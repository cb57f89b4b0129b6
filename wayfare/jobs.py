"""Jobs for spark-submit: the report, the continuous form, and a look at a result table.

    spark-submit wayfare/jobs.py report --data /data --out /results
    spark-submit wayfare/jobs.py stream --data /data --root /state
    spark-submit wayfare/jobs.py stream --kafka broker:9092 --root /state --every 30
    spark-submit wayfare/jobs.py stream --kafka broker:9092 --root /state --skip-bad --large
    spark-submit wayfare/jobs.py show --out /results --query 6
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from functools import partial

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from wayfare.plans.report import all_answers, result_table_rows  # noqa: E402
from wayfare.schemas import RESULT_TABLES  # noqa: E402
from wayfare.session import build_session, clear_shared, stream_session  # noqa: E402
from wayfare.sources import external, tables  # noqa: E402
from wayfare.sources.results import results_scan, write_result_tables  # noqa: E402
from wayfare.streaming.flows import Flows, flows_over, keep_publishing  # noqa: E402


def report(spark: SparkSession, data: str, out: str) -> None:
    """All result tables from the logs as they are, to a new folder."""
    answers = all_answers(tables.trips(spark, data), tables.routes(spark, data))
    write_result_tables(result_table_rows(answers), out)


def stream(
    spark: SparkSession, root: str, data: str | None, kafka: str | None, every: float | None, skip_bad: bool = False,
    results_to: str | None = None,
) -> None:
    """Result tables below ``root`` from files or topics: once over what has arrived, or ``every`` so many seconds.

    ``results_to`` names servers to whose topics, one per result table, changed rows go as envelopes.
    """
    if kafka:
        session = stream_session(spark)
        mode = "PERMISSIVE" if skip_bad else "FAILFAST"
        trips, routes = (read(session, kafka, mode=mode) for read in (external.kafka_trips, external.kafka_routes))
        flows = Flows(session, root, trips, routes)
    else:
        flows = flows_over(spark, data, root)
    if every:
        flows.trigger = {"processingTime": f"{every} seconds"}
    send = partial(_to_topic, results_to) if results_to else None
    keep_publishing(flows, spark, pause=every or 1.0, send=send)


def _to_topic(servers: str, envelopes: DataFrame, topic: str) -> None:
    external.write_topic(envelopes, servers, topic)


def show(spark: SparkSession, out: str, query: int) -> DataFrame:
    """The result table of a question."""
    return results_scan(spark, out, query)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    command = commands.add_parser("report")
    command.add_argument("--data", required=True)
    command.add_argument("--out", required=True)
    command = commands.add_parser("stream")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--data")
    source.add_argument("--kafka")
    command.add_argument("--root", required=True)
    command.add_argument("--every", type=float)
    command.add_argument("--results-to", help="servers whose topics get changed result rows")
    command.add_argument("--skip-bad", action="store_true", help="pass over records of topics that are not JSON")
    command = commands.add_parser("show")
    command.add_argument("--out", required=True)
    command.add_argument("--query", type=int, required=True, choices=sorted(RESULT_TABLES))
    for command in commands.choices.values():
        command.add_argument("--large", action="store_true", help="settings for thousands of cores")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments(argv)
    spark = build_session(f"wayfare {options.command}", large=options.large)
    if options.command == "report":
        report(spark, options.data, options.out)
        clear_shared(spark)
    elif options.command == "stream":
        stream(spark, options.root, options.data, options.kafka, options.every, options.skip_bad, options.results_to)
    else:
        show(spark, options.out, options.query).show(truncate=False)


if __name__ == "__main__":
    main()
