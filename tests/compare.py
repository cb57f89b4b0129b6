"""Side-by-side runs of a Spark query and its DuckDB counterpart."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TESTDATA = "/root/testdata"


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(map(_plain, r)) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _sorted([tuple(r) for r in df.select(*columns).collect()])


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    index = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in index], _sorted([tuple(r[i] for i in index) for r in cursor.fetchall()])
