"""Column picking, computed columns, unique values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def project_arithmetic(df: DataFrame, qty: str, taken: str, out: str = "real_count") -> DataFrame:
    """quantity - taken, a missing ``taken`` counting as 0."""
    return df.withColumn(out, F.col(qty) - F.coalesce(F.col(taken), F.lit(0)))


def project_case(df: DataFrame, cond: Column, yes: str, no: str, out: str = "status") -> DataFrame:
    return df.withColumn(out, F.when(cond, yes).otherwise(no))


def mask_columns(df: DataFrame, hidden: Sequence[str]) -> DataFrame:
    return df.drop(*hidden)


def distinct_single(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_rows(
    a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], pred: Column | None = None
) -> DataFrame:
    """Unique combinations of ``cols`` after joining on ``key``; ``pred`` narrows the joined rows."""
    joined = a.join(b, key)
    if pred is not None:
        joined = joined.filter(pred)
    return joined.select(*cols).distinct()
