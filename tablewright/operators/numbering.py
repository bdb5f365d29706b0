"""Order inside groups, and over a whole table, without one big partition.

``ordered_slices`` range-partitions rows over all shuffle partitions and writes them with the
number of their slice. Rows of one hot group spread over many slices when the order goes on
after the group columns. Running sums and neighbours are then computed inside each slice, and
what crosses a slice border is carried by a table with at most one row per slice, which is why
that table (and only that) is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.sources.scratch import write_scratch

SLICE = "_slice"


def ordered_slices(df: DataFrame, by: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rows of ``df`` written in slices that follow each other in ascending order of ``by``, NULLs first.

    ``by`` should end in a unique column, or equal rows pile up in one slice. Without a number of
    slices there are as many as the session's shuffle partitions, and adaptive execution joins
    neighbouring slices that came out small.
    """
    order = [F.col(c).asc_nulls_first() for c in by]
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return write_scratch(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def _same_group(left: DataFrame, right: DataFrame, names: Sequence[str], right_names: Sequence[str]) -> Column:
    pairs = [left[a].eqNullSafe(right[b]) for a, b in zip(names, right_names)]
    return reduce(lambda x, y: x & y, pairs)


def with_running_sum(
    slices: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group (exclusive; 0 on the first row)."""
    rows = slices.withColumn("_value", F.coalesce(value.cast("bigint"), F.lit(0)))
    order_cols = [F.col(c).asc_nulls_first() for c in order]
    before = Window.partitionBy(SLICE, *group).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(before), F.lit(0)))

    # group totals per slice; a group cut by k borders has k + 1 rows here
    totals = rows.groupBy(SLICE, *group).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    renamed = [f"_g{i}" for i in range(len(group))]
    carry = (
        totals.withColumn("_carry", F.sum("_total").over(earlier))
        .filter(F.col("_carry").isNotNull())
        .select(F.col(SLICE).alias("_at"), "_carry", *[F.col(g).alias(r) for g, r in zip(group, renamed)])
    )
    # only the first group of a slice can have been cut, so carry holds at most one row per slice
    matched = inside.join(
        F.broadcast(carry), _same_group(inside, carry, [SLICE, *group], ["_at", *renamed]), "left"
    )
    return matched.withColumn(out, F.col("_inside") + F.coalesce("_carry", F.lit(0))).drop(
        "_value", "_inside", "_carry", "_at", *renamed
    )


def with_row_index(slices: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Add the 0-based position of each row inside its group."""
    return with_running_sum(slices, group, order, F.lit(1), out)


def with_adjacent(
    slices: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    take: dict[str, str],
    step: int = -1,
) -> DataFrame:
    """Add columns of the previous (``step=-1``) or next (``step=1``) row of the same group, else NULL.

    ``take`` maps a source column to the name of the added column. ``order`` must be unique inside a group.
    """
    if step not in (-1, 1):
        raise ValueError("step is -1 or 1")
    full_order = [*group, *order]
    payload = F.struct(
        *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)],
        *[F.col(source).alias(f"t{i}") for i, source in enumerate(take)],
    )
    sort_cols = [F.col(c).asc_nulls_first() for c in full_order]
    in_slice = Window.partitionBy(SLICE).orderBy(*sort_cols)
    shift = F.lag if step < 0 else F.lead
    pick = F.max_by if step < 0 else F.min_by

    # the last (first) row of each slice, handed to the slice after (before) it
    edge = slices.groupBy(SLICE).agg(pick(payload, F.struct(*full_order)).alias("_edge"))
    handed = edge.select(
        F.col(SLICE).alias("_at"), shift("_edge").over(Window.orderBy(SLICE)).alias("_edge")
    )
    rows = slices.withColumn("_near", shift(payload).over(in_slice))
    joined = rows.join(F.broadcast(handed), rows[SLICE] == handed["_at"], "left")
    near = F.coalesce("_near", "_edge")
    same = reduce(
        lambda x, y: x & y,
        [F.col(g).eqNullSafe(near[f"g{i}"]) for i, g in enumerate(group)],
        near.isNotNull(),
    )
    added = {name: F.when(same, near[f"t{i}"]) for i, name in enumerate(take.values())}
    return joined.withColumns(added).drop("_near", "_edge", "_at")


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group. ``order`` must be unique inside a group.

    Groups of every size go through the slices, so there is no size at which another plan sets in.
    """
    return with_running_sum(ordered_slices(df, [*group, *order]), group, order, value, out).drop(SLICE)


def adjacent(df: DataFrame, group: Sequence[str], order: Sequence[str], take: dict[str, str], step: int = -1) -> DataFrame:
    """Add columns of the previous or next row of the group, as ``with_adjacent`` does, whatever the group's size."""
    return with_adjacent(ordered_slices(df, [*group, *order]), group, order, take, step).drop(SLICE)


def explode_range(df: DataFrame, lo: str, hi: str, out: str, chunk: int = 65_536) -> DataFrame:
    """One row per whole number in [lo, hi]; long ranges are cut into chunks and spread first."""
    starts = df.withColumn("_from", F.explode(F.sequence(F.col(lo), F.col(hi), F.lit(chunk).cast("bigint"))))
    spread = starts.repartition("_from")
    upto = F.least(F.col("_from") + (chunk - 1), F.col(hi))
    return spread.withColumn(out, F.explode(F.sequence(F.col("_from"), upto))).drop("_from")
