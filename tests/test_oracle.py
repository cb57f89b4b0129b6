"""Every registered query against its SQL counterpart, on whole tables."""

import importlib
import sys

import pytest
from compare import TESTDATA, duckdb_over, duckdb_rows, spark_rows

import __spark_entry__ as entry_module
from wayfare import oracle, registry

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF)


def test_each_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.SQL)
    assert set(registry.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("missing", ["corpus_pipeline", "wayfare.llm"])
def test_entry_points_do_without_the_optional_subpackage(monkeypatch, missing):
    monkeypatch.setitem(sys.modules, missing, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert set(alone.queries()) == set(registry.QUERIES) == set(alone.oracle_sql())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["route_id", "passengers", "seats", "occupancy_pct"]
    assert df.count() == 100


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    columns, rows = spark_rows(registry.QUERIES[name](spark, SF))
    expected_columns, expected = duckdb_rows(duck, oracle.SQL[name])
    assert columns == expected_columns
    assert rows == expected
