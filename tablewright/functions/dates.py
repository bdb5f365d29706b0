"""Column functions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def fn_duration_status(start: Column, end: Column) -> Column:
    """'<days> OK' below 10 days, '<days> NOTICE' up to 30, '<days> WARNING' above."""
    days = F.datediff(end, start)
    grade = F.when(days < 10, " OK").when(days <= 30, " NOTICE").when(days > 30, " WARNING")
    return F.concat(days.cast("string"), grade)


def broken_date_rules(start: Column, end: Column, is_insert: Column, as_of: Column) -> dict[int, Column]:
    """Rule number -> condition that breaks it."""
    return {
        1: start > as_of,
        2: (end < as_of) & is_insert,
        3: end < start,
    }


def fn_check_dates(start: Column, end: Column, is_insert: Column, as_of: Column) -> Column:
    """1 if all rules hold, else minus the number of the highest broken rule."""
    rules = broken_date_rules(start, end, is_insert, as_of)
    result = F.lit(1)
    for number in sorted(rules):
        result = F.when(rules[number], -number).otherwise(result)
    return result


def fn_all_broken_dates(start: Column, end: Column, is_insert: Column, as_of: Column) -> Column:
    """Numbers of all broken rules, as an array."""
    rules = broken_date_rules(start, end, is_insert, as_of)
    return F.array_compact(F.array(*[F.when(rules[n], n) for n in sorted(rules)]))


def weekday_text(date: Column) -> Column:
    """'YYYY-MM-DD - Sunday'."""
    return F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" - "), F.date_format(date, "EEEE"))


def unix_seconds(date: Column) -> Column:
    """Midnight UTC of a date as Unix seconds, whatever the session zone."""
    return F.unix_date(date).cast("bigint") * SECONDS_PER_DAY


def unix_seconds_shifted(date: Column, source: str, target: str) -> Column:
    """Unix seconds of the wall clock a date shows after moving from one zone to another."""
    moved = F.convert_timezone(F.lit(source), F.lit(target), date.cast("timestamp_ntz"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, moved)


def dates_as_text(start: Column, end: Column) -> Column:
    """'start - finish'; NULL if either is NULL."""
    return F.concat(start.cast("string"), F.lit(" - "), end.cast("string"))


def first_date_of(text: Column) -> Column:
    return F.substring_index(text, " ", 1).try_cast("date")


def second_date_of(text: Column) -> Column:
    """The date three characters after the first blank."""
    return F.substring(text, F.instr(text, " ") + 3, F.length(text)).try_cast("date")
