"""Ranks, first rows, sorted output, extremes.

Where only rank 1 is asked for, an extreme value and an equality filter answer it without
sorting anything; ties stay spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.lists import ordered_list
from tablewright.operators.numbering import ordered_slices, with_row_index


def _extreme(df: DataFrame, col: str, desc: bool) -> Column:
    return df.agg(F.max(col) if desc else F.min(col)).scalar()


def rank_ties_first(df: DataFrame, col: str, desc: bool = True) -> DataFrame:
    """All rows that a rank over ``col`` would put first."""
    return df.filter(F.col(col) == _extreme(df, col, desc))


def rank_over_aggregate(df: DataFrame, key: str | Sequence[str], desc: bool = True, out: str = "rows") -> DataFrame:
    """Groups ranked by their row count, first rank only."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count("*").alias(out))
    return counts.filter(F.col(out) == _extreme(counts, out, desc))


def rank_unique_winner(df: DataFrame, col: str, desc: bool = True) -> DataFrame:
    """The row ranked first, unless another row shares the rank."""
    best = df.filter(F.col(col) == _extreme(df, col, desc))
    return best.filter(best.agg(F.count("*")).scalar() == 1)


def row_number_first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row of each key in ``order``; map-side minimum instead of a window over the key."""
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(key, "_row.*").select(*df.columns)


def rank_over_grouped_dates(df: DataFrame, key: str, date: str, id_col: str) -> DataFrame:
    """Per key, the row with the smallest id of the earliest date: group by date, rank, join back."""
    per_date = df.groupBy(key, date).agg(F.min(id_col).alias("_id"))
    # a rank puts NULL dates first, and so does the order of structs
    ids = per_date.groupBy(key).agg(F.min_by("_id", F.struct(date, "_id")).alias("_id"))
    return df.join(ids, df[id_col] == ids["_id"], "left_semi")


def surrogate_keys(new: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Give rows without a key (NULL or 0) the numbers after the largest existing key, in ``order``."""
    top = F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0))
    missing = F.col(key).isNull() | (F.col(key) == 0)
    given = new.filter(~F.coalesce(missing, F.lit(True)))
    numbered = with_row_index(ordered_slices(new.filter(missing), list(order)), [], list(order), "_nth")
    fresh = numbered.withColumn(key, (top + F.col("_nth") + 1).cast(new.schema[key].dataType))
    return given.unionByName(fresh.select(*new.columns))


def sort_asc(df: DataFrame, col: str, tie: Sequence[str] = ()) -> DataFrame:
    """Ascending, NULLs first. Tie columns also split a hot value over several sort ranges."""
    return df.orderBy(F.col(col).asc_nulls_first(), *tie)


def sort_desc(df: DataFrame, col: str, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(col).desc_nulls_last(), *tie)


def sort_multi_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])


def top_1(df: DataFrame, col: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie)).limit(1)


def top_1_lookup(
    dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, order: Sequence[str], desc: bool = False
) -> DataFrame:
    """The dimension row of the first (or last) fact row; the key found filters the dimension scan."""
    pick = F.max_by if desc else F.min_by
    found = fact.agg(pick(fact_key, F.struct(*order))).scalar()
    return dim.filter(F.col(dim_key) == found)


def max_rows_all_ties(df: DataFrame, col: str, pred: Column | None = None) -> DataFrame:
    rows = df if pred is None else df.filter(pred)
    return rows.filter(F.col(col) == _extreme(rows, col, True))


def min_rows_all_ties(df: DataFrame, col: str, pred: Column | None = None) -> DataFrame:
    rows = df if pred is None else df.filter(pred)
    return rows.filter(F.col(col) == _extreme(rows, col, False))


def first_row_per_key_joins(df: DataFrame, key: str, date: str, id_col: str) -> DataFrame:
    """Per key, earliest date, then smallest id of that date, then the row itself: joins only."""
    earliest = df.groupBy(key).agg(F.min(date).alias(date))
    # joins on the earliest date, so rows without a date never come first here
    ids = df.join(earliest, [key, date]).groupBy(key).agg(F.min(id_col).alias(id_col))
    return df.join(ids, [key, id_col]).select(*df.columns)


def first_visit_list(
    df: DataFrame, key: str, date: str, item: str, names: DataFrame, name: str, out: str = "name"
) -> DataFrame:
    """Names of everything a person took on the first date, as ordered lists. Only rows of that date look up a name."""
    first = df.groupBy(key).agg(F.min(date).alias(date))
    taken = df.join(first, [key, date]).select(key, item)
    return ordered_list(taken.join(names.select(item, name), item), [key], name, out)


def extreme_of_extreme(df: DataFrame, a: str, b: str, owners: DataFrame, item: str, owner: str) -> DataFrame:
    """Owners of the rows with the largest ``b`` among those with the smallest ``a``."""
    least = df.filter(F.col(a) == _extreme(df, a, False))
    best = least.filter(F.col(b) == _extreme(least, b, True))
    return owners.join(best.select(item).distinct(), item, "left_semi").select(owner).distinct()
