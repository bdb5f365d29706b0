"""Aggregates. Grouped sums and counts combine on the map side, so a hot group sends few rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.lists import ordered_list
from tablewright.sources.scratch import write_scratch


def _kept(df: DataFrame, pred: Column | None) -> DataFrame:
    return df if pred is None else df.filter(pred)


def count_rows(df: DataFrame, out: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def count_filtered(df: DataFrame, col: str, pred: Column, out: str = "in_use") -> DataFrame:
    return df.filter(pred).agg(F.count(col).alias(out))


def count_distinct_filtered(
    df: DataFrame, col: str, pred: Column | None = None, out: str = "in_use", approximate: float | None = None
) -> DataFrame:
    """Exact distinct count; ``approximate`` (a relative error) trades it for a sketch."""
    rows = _kept(df, pred)
    counted = F.count_distinct(col) if approximate is None else F.approx_count_distinct(col, approximate)
    return rows.agg(counted.alias(out))


def multi_aggregate(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.sum(col).alias("sum"), F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("avg")
    )


def scalar_average(df: DataFrame, col: str, pred: Column | None = None, out: str = "average") -> DataFrame:
    return _kept(df, pred).agg(F.avg(col).alias(out))


def min_max_dates(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def group_count(df: DataFrame, key: str, out: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(out))


def group_by_year(df: DataFrame, date: str, out: str = "rows") -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.count("*").alias(out))


def group_by_year_distinct(df: DataFrame, date: str, person: str, out: str = "persons") -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.count_distinct(person).alias(out))


def group_by_case(df: DataFrame, cond: Column, yes: str, no: str, out: str = "rows") -> DataFrame:
    return df.groupBy(F.when(cond, yes).otherwise(no).alias("status")).agg(F.count("*").alias(out))


def group_avg_joined(a: DataFrame, b: DataFrame, key: str, owner: str, val: str, out: str = "average") -> DataFrame:
    return a.join(b, key).groupBy(owner).agg(F.avg(val).alias(out))


def group_max_joined(a: DataFrame, b: DataFrame, key: str, owner: str, val: str, out: str = "highest") -> DataFrame:
    return a.join(b, key).groupBy(owner).agg(F.max(val).alias(out))


def group_avg_filtered(df: DataFrame, key: str, val: str, lo, out: str = "average") -> DataFrame:
    """Average of ``val`` per ``key`` above ``lo``."""
    return df.filter(F.col(key) > lo).groupBy(key).agg(F.avg(val).alias(out))


def group_sum_m2m(a: DataFrame, link: DataFrame, b: DataFrame, owner: str, item: str, val: str, out: str = "total") -> DataFrame:
    """Sum of an item measure per owner through a distinct link table; summed before the owner's columns join in."""
    sums = link.join(b.select(item, val), item).groupBy(owner).agg(F.sum(val).alias(out))
    return a.join(sums, owner)


def group_count_joined(
    a: DataFrame, b: DataFrame, key: str, owner: Sequence[str], pred: Column | None = None, out: str = "rows"
) -> DataFrame:
    """Linked rows per owner. Rows of ``b`` are counted per key before the join."""
    counts = _kept(b, pred).groupBy(key).agg(F.count("*").alias("_n"))
    return a.join(counts, key).groupBy(*owner).agg(F.sum("_n").alias(out))


def having_count(df: DataFrame, key: str, n: int, out: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(out)).filter(F.col(out) >= n)


def in_groups_having(df: DataFrame, link: DataFrame, key: str, pred: Column) -> DataFrame:
    """Rows of ``df`` whose key has a group in ``link`` with ``pred`` true; the group size is ``size``."""
    groups = link.groupBy(key).agg(F.count("*").alias("size")).filter(pred)
    return df.join(groups, key, "left_semi")


def avg_of_group_counts(df: DataFrame, key: str, col: str, distinct: bool = False, out: str = "average") -> DataFrame:
    counted = F.count_distinct(col) if distinct else F.count(col)
    return df.groupBy(key).agg(counted.alias("_n")).agg(F.avg("_n").alias(out))


def avg_over_union_all(dfs: Sequence[DataFrame], col: str, out: str = "average") -> DataFrame:
    together = reduce(DataFrame.unionByName, [df.select(col) for df in dfs])
    return together.agg(F.avg(col).alias(out))


def avg_days_between(df: DataFrame, start: Column, end: Column, pred: Column | None = None, out: str = "avg_days") -> DataFrame:
    return _kept(df, pred).agg(F.avg(F.datediff(end, start)).alias(out))


def avg_days_open_or_closed(df: DataFrame, start: str, end: str, active: Column, as_of: Column, out: str = "avg_days") -> DataFrame:
    """Days up to the agreed end, or up to ``as_of`` where date and status disagree (kept late, or back early)."""
    due = F.col(end) <= as_of
    agreed = (due & ~active) | (~due & active)
    disagreed = (due & active) | (~due & ~active)
    days = F.when(agreed, F.datediff(F.col(end), F.col(start))).when(
        disagreed, F.datediff(as_of, F.col(start))
    )
    return df.agg(F.avg(days).alias(out))


def power_mean_decimal(df: DataFrame, key: str, col: str, p: int = 3, div: int = 2, out: str = "mw") -> DataFrame:
    return df.groupBy(key).agg((F.avg(F.pow(F.col(col), F.lit(p)) / div)).cast("decimal(12,2)").alias(out))


def ratio_averages(people: DataFrame, loans: DataFrame, active: Column, start: str, end: str) -> DataFrame:
    """One row: loans out per person, days per returned loan, returned loans per person. NULL for a zero divisor."""
    persons = people.agg(F.count("*")).scalar()
    sums = loans.agg(
        F.count(F.when(active, 1)).alias("active"),
        F.count(F.when(~active, 1)).alias("inactive"),
        F.sum(F.when(~active, F.datediff(end, start))).alias("days"),
    )
    return sums.select(
        F.try_divide(F.col("active"), persons).alias("books_taken"),
        F.try_divide(F.col("days"), F.col("inactive")).alias("days_to_read"),
        F.try_divide(F.col("inactive"), persons).alias("books_returned"),
    )


def library_totals(books: DataFrame, loans: DataFrame, quantity: str, active: Column) -> DataFrame:
    """One row (total, given, rest), 0 where there is nothing to add up."""
    given = loans.filter(active).agg(F.count("*")).scalar()
    totals = books.agg(F.coalesce(F.sum(quantity), F.lit(0)).cast("bigint").alias("total"))
    return totals.withColumn("given", given).withColumn("rest", F.col("total") - F.col("given"))


def max_of_group_counts(
    owners: DataFrame, parts: DataFrame, owner: str, item: str, out: str = "most", max_only: bool = False
) -> DataFrame:
    """Per owner, the largest number of parts any one of its items has, single-part items left out.

    Parts are counted per item before owners join in, so owners and parts of an item are never paired
    off. ``max_only`` keeps just the owners that reach the overall largest count.
    """
    counts = parts.groupBy(item).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    most = owners.select(owner, item).join(counts, item).groupBy(owner).agg(F.max("_n").alias(out))
    if not max_only:
        return most
    return most.filter(F.col(out) == most.agg(F.max(out)).scalar())


def distinct_pairs_count(owners: DataFrame, parts: DataFrame, owner: str, item: str, part: str, n: int, out: str = "items") -> DataFrame:
    """Owners with more than ``n`` distinct parts over all their items. ``part`` holds whole numbers.

    The parts of an item are a word of 64 bits per 64 numbers, so an item's owners meet a few words instead of each of
    its parts; an owner's words are joined bit by bit and counted. A word has eight bytes, which hash aggregates hold in place.
    """
    number = F.col(part).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    maps = parts.groupBy(item, F.shiftright(number, 6).alias("_bucket")).agg(F.bit_or(bit).alias("_bits"))
    merged = owners.select(owner, item).distinct().join(maps, item).groupBy(owner, "_bucket").agg(F.bit_or("_bits").alias("_bits"))
    counted = merged.groupBy(owner).agg(F.sum(F.coalesce(F.bit_count("_bits"), F.lit(0))).alias(out))
    return counted.filter(F.col(out) > n)


def median_of_counts(df: DataFrame, key: str, out: str = "median") -> DataFrame:
    """Exact median of the per-group row counts.

    Counts are turned into a histogram first. N rows give at most sqrt(2N) different counts, so the
    last step sees a short table however many groups there are.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    histogram = counts.groupBy("_n").agg(F.count("*").alias("_groups"))
    return histogram.agg(F.percentile("_n", F.lit(0.5), F.col("_groups")).alias(out))


def champion_argmax(df: DataFrame, key: str, out: str = "rows") -> DataFrame:
    """The group with the most rows, the smallest key winning a tie."""
    counts = df.groupBy(key).agg(F.count("*").alias(out))
    return counts.orderBy(F.col(out).desc(), F.col(key)).limit(1)


def concat_distinct_two(
    first: DataFrame, second: DataFrame, keys: Sequence[str], first_list: tuple[str, str], second_list: tuple[str, str],
) -> DataFrame:
    """(keys, list, pos, name): two de-duplicated ordered lists for each group that both inputs have.

    The lists come from separate inputs, so the two sides of a group are never multiplied; they are tagged, put in one
    order and numbered once. A NULL key is a group like any other. Each pair is (source column, name of the list).
    """
    tagged = reduce(DataFrame.unionByName, [
        rows.select(*keys, F.lit(label).alias("list"), F.col(col).alias("_item"))
        for rows, (col, label) in ((first, first_list), (second, second_list))
    ])
    # both inputs may be joins, and are read for the groups and for the lists
    tagged = write_scratch(tagged, "tagged")
    names = [f"_k{i}" for i in range(len(keys))]
    # groups with both tags, as a number that hash aggregates hold in place; combined on the map side, a group sends one
    tag = F.when(F.col("list") == first_list[1], 1).otherwise(2)
    both = (
        tagged.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.bit_or(tag).alias("_tags")).filter(F.col("_tags") == 3).select(*names)
    )
    same = reduce(lambda x, y: x & y, [tagged[k].eqNullSafe(both[n]) for k, n in zip(keys, names)])
    return ordered_list(tagged.join(both, same, "left_semi"), [*keys, "list"], "_item", distinct=True)
