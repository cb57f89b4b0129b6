"""Winners with stated tie rules: the running best of a log, computed from final groups.

A running maximum of a growing value ends at the maximum of the final values, and the
group that got there first is the one whose last row is earliest. A running minimum of
a growing value is the minimum of the first values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best(groups: DataFrame, *ranking: Column) -> DataFrame:
    """The first row in the order of ``ranking``: each task keeps one row, the driver merges them."""
    return groups.orderBy(*ranking).limit(1)


def least_per(groups: DataFrame, key: str, *ranking: str) -> DataFrame:
    """Per ``key`` the row with the least ``ranking``, combined on the map side."""
    rest = [c for c in groups.columns if c not in (key, *ranking)]
    row = F.min(F.struct(*ranking, *rest)).alias("row")
    return groups.groupBy(key).agg(row).select(key, "row.*").select(*groups.columns)
