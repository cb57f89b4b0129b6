"""The jobs over the given tables."""

import os

import pytest
from compare import TESTDATA, duckdb_over, duckdb_rows, spark_rows

from wayfare import jobs, oracle
from wayfare.plans.report import all_answers
from wayfare.schemas import RESULT_TABLES
from wayfare.session import clear_shared, written
from wayfare.sources import tables
from wayfare.sources.results import results_scan
from wayfare.streaming.flows import flows_over

SF = f"{TESTDATA}/sf0.001"


def expected():
    return duckdb_rows(duckdb_over(SF), oracle.SQL["result_rows"])


def test_report_and_show(spark, tmp_path, capsys):
    out = str(tmp_path / "results")
    jobs.main(["report", "--data", SF, "--out", out])
    assert spark_rows(results_scan(spark, out)) == expected()
    jobs.main(["show", "--out", out, "--query", "7"])
    assert "total" in capsys.readouterr().out


def test_stream(spark, tmp_path):
    root = str(tmp_path / "state")
    jobs.main(["stream", "--data", SF, "--root", root])
    assert spark_rows(flows_over(spark, SF, root).results().read(spark)) == expected()


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        jobs.arguments(["show", "--out", "x", "--query", "3"])
    with pytest.raises(SystemExit):
        jobs.arguments(["stream", "--root", "x"])


def test_all_answers_have_a_result_table(spark):
    answers = all_answers(tables.trips(spark, SF), tables.routes(spark, SF))
    assert set(answers) == set(RESULT_TABLES)


def test_clear_shared(spark):
    kept = written(spark.range(3), "to_clear").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(kept)
    clear_shared(spark)
    assert not os.path.exists(kept)
