"""Views that show columns in another form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import dates as dt


def str_concat_dates(df: DataFrame, start: str, end: str, out: str = "dates") -> DataFrame:
    return df.withColumn(out, dt.dates_as_text(F.col(start), F.col(end)))


def str_split_dates(df: DataFrame, col: str, start: str = "start", end: str = "finish") -> DataFrame:
    return df.withColumn(start, dt.first_date_of(F.col(col))).withColumn(end, dt.second_date_of(F.col(col)))


def str_upper(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(col))


def date_weekday_text(df: DataFrame, date: str, out: str) -> DataFrame:
    return df.withColumn(out, dt.weekday_text(F.col(date)))


def date_to_unix(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn(date, dt.unix_seconds(F.col(date)))


def date_to_unix_tz(df: DataFrame, date: str, source: str = "+00:00", target: str = "+03:00") -> DataFrame:
    return df.withColumn(date, dt.unix_seconds_shifted(F.col(date), source, target))


def date_parts(df: DataFrame, date: str) -> DataFrame:
    """Year, weekday (1 = Sunday), day of month."""
    return df.select(
        "*", F.year(date).alias("year"), F.dayofweek(date).alias("weekday"), F.dayofmonth(date).alias("day")
    )


def date_parse_dmy(df: DataFrame, col: str, days: Sequence[str]) -> DataFrame:
    """Rows whose day-first date text names one of ``days`` (ISO dates)."""
    return df.filter(F.to_date(col, "dd.MM.yyyy").isin([F.lit(d).cast("date") for d in days]))


def json_canonical_text(df: DataFrame, struct: str, text: str = "text", parsed: str = "parsed") -> DataFrame:
    """A struct as JSON text, and that text parsed back."""
    kind = df.schema[struct].dataType
    return df.withColumn(text, F.to_json(struct)).withColumn(parsed, F.from_json(text, kind))
