"""Set operations on whole rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    return union_all([df.select(*cols) for df in dfs]).distinct()


def union_max_all(dfs: Sequence[DataFrame], key: str, col: str) -> DataFrame:
    """Keys with the largest value over all inputs together."""
    together = union_all([df.select(key, col) for df in dfs])
    return together.filter(F.col(col) == together.agg(F.max(col)).scalar()).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    # distinct first: a hot value is combined on the map side before the anti join shuffles it
    return a.distinct().subtract(b.distinct())


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().intersect(b.distinct())
