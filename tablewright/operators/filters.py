"""Row filters. Comparisons stay on the bare column, so they reach the Parquet scan."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARE = {
    "<": operator.lt, "<=": operator.le, ">": operator.gt,
    ">=": operator.ge, "=": operator.eq, "<>": operator.ne,
}


def typed(df: DataFrame, col: str, value) -> Column:
    """``value`` as a literal of the column's own type, so the column is never cast."""
    return F.lit(value).cast(df.schema[col].dataType)


def filter_compare(df: DataFrame, col: str, op: str, v) -> DataFrame:
    return df.filter(COMPARE[op](F.col(col), typed(df, col, v)))


def filter_and_or(df: DataFrame, alternatives: Sequence[Column]) -> DataFrame:
    """Keep rows that meet any alternative; each alternative is itself an AND of conditions."""
    return df.filter(reduce(operator.or_, alternatives))


def filter_between(
    df: DataFrame, col: str, lo, hi, pred: Column | None = None, spelled_out: bool = False
) -> DataFrame:
    """Closed range, as BETWEEN or as two comparisons."""
    c, low, high = F.col(col), typed(df, col, lo), typed(df, col, hi)
    kept = df.filter((c >= low) & (c <= high)) if spelled_out else df.filter(c.between(low, high))
    return kept if pred is None else kept.filter(pred)


def filter_date_range(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """start <= date < end."""
    return df.filter((F.col(col) >= typed(df, col, start)) & (F.col(col) < typed(df, col, end)))


def filter_in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin([typed(df, col, v) for v in values]))


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def filter_char_class(df: DataFrame, col: str) -> DataFrame:
    """Texts of digits only, or of Latin letters only in any case."""
    digits_only = ~F.col(col).rlike("[^0-9]")
    letters_only = ~F.lower(col).rlike("[^a-z]")
    return df.filter(digits_only | letters_only)


def filter_ci_equals(df: DataFrame, col: str, v: str) -> DataFrame:
    return df.filter(F.lower(col) == v.lower())


def filter_year_upto_first(df: DataFrame, date: str) -> DataFrame:
    """Rows dated in or before the year of the earliest row, as a range on the bare column."""
    first_year = F.year(df.agg(F.min(date)).scalar())
    return df.filter(F.col(date) < F.make_date(first_year + 1, F.lit(1), F.lit(1)))


def filter_below_average(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < df.agg(F.avg(col)).scalar())


def filter_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.col(col).contains(text))
