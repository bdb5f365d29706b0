"""Ordered lists per group, one row per name.

A list is (keys, pos, name) with positions from 1, for groups of every size: no task gathers a group, and nothing is
cut off or cut up. `joined_text` makes one text of a list where a caller knows that its groups are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.numbering import SLICE, explode_range, ordered_slices, with_running_sum


def ordered_list(df: DataFrame, keys: Sequence[str], col: str, out: str = "name", distinct: bool = False) -> DataFrame:
    """(keys, pos, out): names of each group in order, repeats kept unless ``distinct``. NULL names drop out."""
    names = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_name")).agg(F.count("*").alias("_n"))
    if distinct:
        names = names.withColumn("_n", F.lit(1).cast("bigint"))
    # a name that comes often is one row up to here, so it can't pile up in one slice
    slices = ordered_slices(names, [*keys, "_name"])
    placed = with_running_sum(slices, keys, ["_name"], F.col("_n"), "_before").drop(SLICE)
    if distinct:
        return placed.select(*keys, (F.col("_before") + 1).alias("pos"), F.col("_name").alias(out))
    ends = placed.select(*keys, "_name", (F.col("_before") + 1).alias("_lo"), (F.col("_before") + F.col("_n")).alias("_hi"))
    return explode_range(ends, "_lo", "_hi", "pos").select(*keys, "pos", F.col("_name").alias(out))


def joined_text(rows: DataFrame, keys: Sequence[str], name: str = "name", sep: str = ", ", out: str = "names") -> DataFrame:
    """One text per group out of an ordered list. Each group must fit a row; registered queries don't use this."""
    gathered = F.sort_array(F.collect_list(F.struct("pos", F.col(name).cast("string").alias("name"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(gathered, lambda p: p["name"]), sep).alias(out))


def concat_ordered(df: DataFrame, keys: Sequence[str], col: str, out: str = "name") -> DataFrame:
    """All names of a group in order, repeats kept."""
    return ordered_list(df, keys, col, out)


def concat_default_separator(df: DataFrame, keys: Sequence[str], col: str, out: str = "name") -> DataFrame:
    """Different names of a group in order."""
    return ordered_list(df, keys, col, out, distinct=True)
