"""Jobs on the gaps of a key column. Keys are whole numbers from 1 up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.numbering import (
    explode_range,
    ordered_slices,
    with_adjacent,
    with_row_index,
    with_running_sum,
)
from tablewright.sources.scratch import write_scratch


def _key_slices(df: DataFrame, key: str) -> DataFrame:
    keys = df.select(F.col(key).cast("bigint").alias("k")).filter(F.col("k").isNotNull()).distinct()
    return ordered_slices(keys, ["k"])


def _gaps(slices: DataFrame) -> DataFrame:
    """(k, start, stop): the free run right before each key, empty runs left out. Written, since those who count runs read it twice."""
    near = with_adjacent(slices, [], ["k"], {"k": "_prev"})
    runs = near.select(
        "_slice", "k",
        (F.greatest(F.coalesce("_prev", F.lit(0)), F.lit(0)) + 1).alias("start"), (F.col("k") - 1).alias("stop"),
    )
    return write_scratch(runs.filter(F.col("stop") >= F.col("start")), "gaps")


def tf_free_key_ranges(df: DataFrame, key: str) -> DataFrame:
    """Missing key ranges (start, stop) from 1 to the largest key."""
    return _gaps(_key_slices(df, key)).select("start", "stop")


def free_keys(df: DataFrame, key: str) -> DataFrame:
    """Missing keys, one row each, with their 0-based order."""
    runs = _gaps(_key_slices(df, key))
    sized = with_running_sum(runs, [], ["k"], F.col("stop") - F.col("start") + 1, "_before")
    each = explode_range(sized.select("start", "stop", "_before"), "start", "stop", "free_key")
    return each.select("free_key", (F.col("_before") + F.col("free_key") - F.col("start")).alias("nth"))


def fn_free_keys_list(df: DataFrame, key: str) -> DataFrame:
    """Missing keys as one list (pos, free_key), positions from 1."""
    return free_keys(df, key).select((F.col("nth") + 1).alias("pos"), "free_key")


def proc_compact_keys(df: DataFrame, key: str) -> DataFrame:
    """(old_key, new_key) for every key: the largest keys move into the smallest gaps until none is left.

    With n keys, those above n move; they and the gaps in 1..n are equally many. Moved keys in falling
    order pair with gaps in rising order. Keys below 1 are refused.
    """
    below = F.raise_error(F.lit("keys below 1 cannot be compacted"))
    # refused while the keys are written, not by a pass of its own
    slices = _key_slices(df.select(F.when(F.col(key) < 1, below).otherwise(F.col(key)).alias(key)), key)
    n = slices.agg(F.count("*")).scalar()
    placed = with_row_index(slices, [], ["k"], "nth")
    moved = placed.filter(F.col("k") > n).select(F.col("k").alias("old_key"), (n - 1 - F.col("nth")).alias("turn"))

    runs = _gaps(slices).withColumn("stop", F.least("stop", n)).filter(F.col("stop") >= F.col("start"))
    sized = with_running_sum(runs, [], ["k"], F.col("stop") - F.col("start") + 1, "_before")
    each = explode_range(sized.select("start", "stop", "_before"), "start", "stop", "new_key")
    holes = each.select("new_key", (F.col("_before") + F.col("new_key") - F.col("start")).alias("turn"))

    kept = slices.filter(F.col("k") <= n).select(F.col("k").alias("old_key"), F.col("k").alias("new_key"))
    return kept.unionByName(moved.join(holes, "turn").select("old_key", "new_key"))


def compact_table(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The table with compacted keys, and one row with the number of keys changed."""
    plan = proc_compact_keys(df, key)
    changes = plan.filter(F.col("old_key") != F.col("new_key"))
    renamed = (
        df.join(changes, df[key] == changes["old_key"], "left")
        .withColumn(key, F.coalesce("new_key", F.col(key)))
        .select(*df.columns)
    )
    return renamed, changes.agg(F.count("*").alias("keys_changed"))
