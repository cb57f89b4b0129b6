"""Result tables: one folder per result table below a common path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import RESULT_ROW, RESULT_TABLES


def write_result_tables(rows: DataFrame, path: str) -> None:
    """Rows of (result_table, id, result), each table to its own folder."""
    rows.write.partitionBy("result_table").parquet(path)


def results_scan(spark: SparkSession, path: str, query: int | None = None) -> DataFrame:
    """All result tables, or the one of a question; only its folder is read then."""
    rows = spark.read.schema(RESULT_ROW).parquet(path)
    if query is None:
        return rows.select(*RESULT_ROW.names)
    return rows.filter(F.col("result_table") == RESULT_TABLES[query]).select("id", "part", "result")
