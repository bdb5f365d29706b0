"""Data modification as snapshot in, snapshot out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranking import surrogate_keys


def _holds(pred: Column) -> Column:
    """SQL modifies rows only where the predicate is TRUE; NULL counts as not met."""
    return F.coalesce(pred, F.lit(False))


def _once(src: DataFrame, key: str) -> DataFrame:
    """``src`` without NULL keys; a key that comes twice is an error when the plan runs, as it would multiply rows.

    Keys alone are counted; their largest count is a scalar that the filter on the rows asks for.
    """
    rows = src.filter(F.col(key).isNotNull())
    counted = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    worst = counted.agg(F.max(F.struct("_n", "_key"))).scalar()
    twice = F.raise_error(F.concat(F.lit(f"{key} repeats: "), worst["_key"].cast("string")))
    return rows.filter(F.when(worst["_n"] == 1, True).otherwise(twice.cast("boolean")))


def insert_rows(df: DataFrame, rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Append rows; those without a key get the next numbers in ``order``."""
    return df.unionByName(surrogate_keys(rows, df, key, order))


def insert_conditional(
    df: DataFrame, rows: DataFrame, key: str, order: Sequence[str], status: str, due: str, as_of: Column,
    before: str = "Y", after: str = "N",
) -> DataFrame:
    """Append rows whose status says whether ``as_of`` still lies before the due date. ``due`` is not stored."""
    judged = rows.withColumn(status, F.when(as_of < F.col(due), before).otherwise(after))
    kept = judged.select(*df.columns, *[c for c in order if c not in df.columns])
    return df.unionByName(surrogate_keys(kept, df, key, order).select(*df.columns))


def update_where(df: DataFrame, pred: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``pred`` is TRUE. All new values see the old row."""
    hit = _holds(pred)
    return df.select(
        *[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns]
    )


def update_shift_date(df: DataFrame, pred: Column, col: str, months: int = 0, days: int = 0) -> DataFrame:
    """Move a date by months (clamped to the month's end), then by days."""
    return update_where(df, pred, {col: F.date_add(F.add_months(col, months), days)})


def update_from_join(
    df: DataFrame, src: DataFrame, key: str, changes: Mapping[str, str], keep_unmatched: bool = False
) -> DataFrame:
    """Set columns from ``src`` (one row per key). Unmatched rows get NULL, or stay as they are."""
    renamed = _once(src, key).select(F.col(key).alias("_key"), *[F.col(s).alias(f"_{c}") for c, s in changes.items()])
    joined = df.join(renamed, df[key] == renamed["_key"], "left")
    hit = F.col("_key").isNotNull()
    cols = []
    for c in df.columns:
        if c not in changes:
            cols.append(F.col(c))
        else:
            cols.append((F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) if keep_unmatched else F.col(f"_{c}")).alias(c))
    return joined.select(*cols)


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    return df.filter(~_holds(pred))


def delete_by_weekday(df: DataFrame, date: str, dow: int, pred: Column) -> DataFrame:
    """Delete rows that meet ``pred`` on a weekday, 1 being Sunday."""
    return delete_where(df, pred & (F.dayofweek(date) == dow))


def delete_by_month_day(df: DataFrame, date: str, day: int) -> DataFrame:
    return delete_where(df, F.dayofmonth(date) > day)


def replace_into(df: DataFrame, rows: DataFrame, unique: str, key: str) -> DataFrame:
    """Drop rows that share the unique value of a new row, then insert the new rows with new keys.

    Keys go on after the largest key before the deletion, as an auto-increment column would.
    """
    kept = df.join(rows.select(unique).distinct(), unique, "left_anti").select(*df.columns)
    keyed = surrogate_keys(rows.select(*df.columns), df, key, [unique])
    return kept.unionByName(keyed)


def upsert_rename_duplicate(df: DataFrame, src: DataFrame, key: str, name: str, suffix: str = "[OLD]") -> DataFrame:
    """Copy rows of ``src`` in; where its key is taken, the existing row stays and its name gets the suffix."""
    plain = src.select(F.col(key).alias("_key"), F.col(name).alias("_name"))
    incoming = _once(plain, "_key").unionByName(plain.filter(F.col("_key").isNull()))
    both = df.join(incoming, df[key] == incoming["_key"], "full_outer")
    clash = F.col(key).isNotNull() & F.col("_key").isNotNull()
    return both.select(
        F.coalesce(key, "_key").alias(key),
        F.when(clash, F.concat(F.col(name), F.lit(suffix))).otherwise(F.coalesce(name, "_name")).alias(name),
    )


def add_column_default(df: DataFrame, name: str, type_name: str, default=None) -> DataFrame:
    return df.withColumn(name, F.lit(default).cast(type_name))


def view_insert_through(
    base: DataFrame, rows: DataFrame, inverse: Mapping[str, Column], key: str, order: Sequence[str],
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert rows given in view form. ``inverse`` maps base columns to expressions on the view's columns.

    ``checks`` names conditions every row must meet (such as: only digits where an id is meant).
    """
    for what, cond in (checks or {}).items():
        # part of the plan: a row that breaks a condition ends the job that would insert it
        rows = rows.filter(F.when(_holds(cond), True).otherwise(F.raise_error(F.lit(what)).cast("boolean")))
    plain = rows.select(
        *[inverse.get(c, F.col(c)).cast(base.schema[c].dataType).alias(c) for c in base.columns],
    )
    return base.unionByName(surrogate_keys(plain, base, key, order))


def view_update_through(base: DataFrame, edited: DataFrame, inverse: Mapping[str, Column], key: str) -> DataFrame:
    """Apply edited view rows to the base by key.

    Expressions in ``inverse`` may use ``old`` (the base row) and ``new`` (the edited row). An edited row
    whose key the base does not know means the key itself was changed, which is refused.
    """
    refused = F.raise_error(F.lit(f"changing {key} through the view is not allowed")).cast("boolean")
    old = base.select(F.col(key), F.struct(*base.columns).alias("old"))
    new = _once(edited, key).unionByName(edited.filter(F.col(key).isNull())).select(F.col(key), F.struct(*edited.columns).alias("new"))
    joined = old.join(new, key, "full_outer").filter(F.when(F.col("old").isNotNull(), True).otherwise(refused))
    hit = F.col("new").isNotNull()
    return joined.select(
        *[
            F.when(hit, inverse[c].cast(base.schema[c].dataType)).otherwise(F.col(f"old.{c}")).alias(c)
            if c in inverse else F.col(f"old.{c}").alias(c)
            for c in base.columns
        ]
    )


def view_delete_through(base: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    return base.join(deleted.select(key).distinct(), key, "left_anti")
