"""Joins and subquery forms, always on equal keys.

No side is forced to be broadcast: Spark broadcasts a side only when its measured size is under
the session's threshold. Hot keys: adaptive execution splits them on both sides of an inner join,
but only on the left side of a semi, anti or left join. So the right side of a semi or anti join is
reduced to its distinct keys first (combined on the map side), counts are taken before joining, and
a left join is an inner join plus the unmatched rows. One-row results (a maximum, a count) come in
as scalar subqueries, not as joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.numbering import adjacent, ordered_slices, with_adjacent, with_row_index
from tablewright.sources.scratch import write_scratch


def inner_join_using_chain(fact: DataFrame, steps: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Join through link tables and dimensions, each step on one shared key. Link tables must be distinct."""
    for table, key in steps:
        fact = fact.join(table, key)
    return fact


def inner_join_on(a: DataFrame, b: DataFrame, lk: str, rk: str) -> DataFrame:
    return a.join(b, a[lk] == b[rk])


def inner_join_comma(a: DataFrame, b: DataFrame, lk: str, rk: str, pred: Column | None = None) -> DataFrame:
    """Tables listed side by side and matched by WHERE: an inner equi-join with a filter."""
    joined = a.join(b, a[lk] == b[rk])
    return joined if pred is None else joined.filter(pred)


def key_set(df: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct values of ``key`` under another name: a hot value shrinks to one row per map task."""
    return df.select(F.col(key).alias(name)).distinct()


def left_outer_join(a: DataFrame, b: DataFrame, lk: str, rk: str) -> DataFrame:
    """All rows of ``a``, with their matches or NULLs. Column names of the two sides must differ.

    Rows with a NULL key go straight to the unmatched ones; both joins then shuffle the same rows of
    ``a``, and that shuffle runs once.
    """
    known = a.filter(a[lk].isNotNull())
    matched = known.join(b, known[lk] == b[rk])
    keys = key_set(b, rk, "_rk")
    unmatched = known.join(keys, known[lk] == keys["_rk"], "left_anti").unionByName(a.filter(a[lk].isNull()))
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in b.schema.fields}
    return matched.unionByName(unmatched.withColumns(nulls))


def full_outer_ledger(inc: DataFrame, out: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Income and outcome side by side; each side holds one row per key."""
    return inc.join(out, list(keys), "full_outer")


def full_outer_daily_totals(
    inc: DataFrame, out: DataFrame, keys: Sequence[str], inc_col: str = "inc", out_col: str = "out"
) -> DataFrame:
    """Sums per key of two many-row ledgers. Each side is summed first, so rows never multiply."""
    inc_sums = inc.groupBy(*keys).agg(F.sum(inc_col).alias(inc_col))
    out_sums = out.groupBy(*keys).agg(F.sum(out_col).alias(out_col))
    return inc_sums.join(out_sums, list(keys), "full_outer")


def semi_join_in(a: DataFrame, b: DataFrame, lk: str, rk: str) -> DataFrame:
    keys = key_set(b, rk, "_rk")
    return a.join(keys, a[lk] == keys["_rk"], "left_semi")


def semi_join_nested(a: DataFrame, link: DataFrame, dim: DataFrame, keys: tuple[str, str], names: Column) -> DataFrame:
    """Rows of ``a`` linked to a dimension row that meets ``names``; keys = (a-link, link-dim)."""
    a_key, dim_key = keys
    wanted = link.join(dim.filter(names).select(dim_key).distinct(), dim_key, "left_semi")
    return a.join(wanted.select(a_key).distinct(), a_key, "left_semi")


def semi_join_then_join(a: DataFrame, link: DataFrame, keys: tuple[str, str], wanted: DataFrame) -> DataFrame:
    """Join ``a`` to the link rows whose other key is wanted, then drop the repeats."""
    a_key, other = keys
    linked = link.join(wanted.select(other).distinct(), other, "left_semi").select(a_key).distinct()
    return a.join(linked, a_key).distinct()


def semi_join_intersection(a: DataFrame, b: DataFrame, owner: str) -> DataFrame:
    """Owners present in both inputs."""
    return a.select(owner).distinct().join(b.select(owner).distinct(), owner, "left_semi")


def anti_join_null_filter(a: DataFrame, b: DataFrame, lk: str, rk: str) -> DataFrame:
    """Rows of ``a`` never matched in ``b``."""
    keys = key_set(b, rk, "_rk")
    return a.join(keys, a[lk] == keys["_rk"], "left_anti")


def anti_join_not_in(a: DataFrame, b: DataFrame, lk: str, rk: str) -> DataFrame:
    """NOT IN with its NULL rules, as a shuffled anti join.

    SQL NOT IN would broadcast the whole right side. Here two counts of the right side decide what
    NULLs mean: any NULL there leaves no rows; a NULL on the left stays only if the right is empty.
    """
    right = b.agg(F.struct(F.count("*").alias("rows"), F.count(rk).alias("known"))).scalar()
    unmatched = anti_join_null_filter(a, b, lk, rk)
    return unmatched.filter((right["rows"] == right["known"]) & (F.col(lk).isNotNull() | (right["rows"] == 0)))


def anti_join_conditional_count(a: DataFrame, b: DataFrame, lk: str, rk: str, active: Column) -> DataFrame:
    """Rows of ``a`` with no active match: an anti join on the active rows."""
    return anti_join_null_filter(a, b.filter(active), lk, rk)


def not_exists_guard(df: DataFrame, key: str, v=1) -> DataFrame:
    """One row holding ``v`` if no row has that key, else no row."""
    found = df.filter(F.col(key) == v).limit(1).agg(F.count("*").alias("n"))
    return found.filter(F.col("n") == 0).select(F.lit(v).cast(df.schema[key].dataType).alias("empty_key"))


def exists_flag(df: DataFrame, pred: Column, out: str = "error_exists") -> DataFrame:
    """One row: 1 if any row meets ``pred``, else 0. The scan stops at the first hit."""
    return df.filter(pred).limit(1).agg(F.count("*").alias(out))


def self_join_pairs(df: DataFrame, id_col: str, same_cols: Sequence[str]) -> DataFrame:
    """Rows that equal another row in ``same_cols``, without listing each pair.

    n equal rows make n(n-1)/2 pairs, so pairs are given by group: every member comes with the
    smallest id of its group, the number of members and the number of pairs. Two ids form a pair
    exactly when they share the group columns.
    """
    groups = (
        df.groupBy(*same_cols)
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("members"))
        .filter(F.col("members") > 1)
        .withColumn("pairs", (F.col("members") * (F.col("members") - 1) / 2).cast("bigint"))
    )
    return df.select(id_col, *same_cols).join(groups, list(same_cols)).select(
        id_col, *same_cols, "first_id", "members", "pairs"
    )


def cross_join_all_pairs(a: DataFrame, b: DataFrame, a_key: str, b_key: str, pred_b: Column | None = None) -> DataFrame:
    """Every row of ``a`` with the run of ``b`` open to it, as (first, last, count) of one range.

    The full product is the same for every row of ``a``; it is described, never produced.
    """
    kept = b if pred_b is None else b.filter(pred_b)
    ends = kept.agg(
        F.struct(F.min(b_key).alias("lo"), F.max(b_key).alias("hi"), F.count("*").alias("n"))
    ).scalar()
    return a.select(
        a_key,
        ends["lo"].alias("first_key"), ends["hi"].alias("last_key"), ends["n"].alias("pairs"),
    ).filter(F.col("pairs") > 0)


def cross_anti_pairs(
    a: DataFrame, b: DataFrame, used: DataFrame, a_key: str, b_key: str, pred_b: Column | None = None
) -> DataFrame:
    """Per row of ``a``, the keys of ``b`` never paired with it, as runs: a_key, from_key, to_key, pairs.

    A run stands for every kept key of ``b`` from ``from_key`` to ``to_key``, so each pair can be read off. Keys are
    numbered 0..n-1 in order; the unused ones form at most (used + 1) runs per row of ``a``, so the result grows with what was
    used and not with the product.
    """
    kept = (b if pred_b is None else b.filter(pred_b)).select(b_key).distinct()
    slices = with_row_index(ordered_slices(kept, [b_key]), [], [b_key], "pos")
    for step, name in ((-1, "key_before"), (1, "key_after")):
        slices = with_adjacent(slices, [], [b_key], {b_key: name}, step)
    # each key knows its neighbours, so that the ends of a run need no look-up
    placed = write_scratch(slices.select(b_key, "pos", "key_before", "key_after"), "placed")
    ends = placed.agg(F.struct(F.count("*").alias("n"), F.min(b_key).alias("first"), F.max(b_key).alias("last"))).scalar()

    taken = used.select(a_key, b_key).distinct().join(placed, b_key).select(a_key, "pos", "key_before", "key_after")
    # a closing mark at position n for everyone, so the run after the last used key is seen as well
    closing = a.select(a_key, ends["n"].alias("pos"), ends["last"].alias("key_before"), ends["last"].alias("key_after"))
    near = adjacent(taken.unionByName(closing), [a_key], ["pos"], {"pos": "prev_pos", "key_after": "key_from"})
    runs = near.withColumn("pairs", F.col("pos") - F.coalesce("prev_pos", F.lit(-1).cast("bigint")) - 1).filter("pairs > 0")
    from_key = F.when(F.col("prev_pos").isNull(), ends["first"]).otherwise(F.col("key_from"))
    return runs.select(a_key, from_key.alias("from_key"), F.col("key_before").alias("to_key"), "pairs")


def greater_than_all(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """The row whose value is above every other row's, if there is one.

    Only the two largest values matter. NULLs sort first here: against a NULL the comparison is
    never true, and a single row has nothing to lose against.
    """
    top = df.select(id_col, col).orderBy(F.col(col).desc_nulls_first()).limit(2)
    judged = top.agg(
        F.max_by(F.struct(id_col, col), F.struct(col)).alias("best"),
        F.count("*").alias("rows"), F.count(col).alias("known"),
        F.max(col).alias("hi"), F.min(col).alias("lo"),
    )
    alone = F.col("rows") == 1
    above = (F.col("known") == 2) & (F.col("hi") > F.col("lo"))
    return judged.filter(alone | above).select("best.*")


def less_than_all(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Rows of ``a`` below every value of ``b``: all rows if ``b`` is empty, none if it holds a NULL."""
    other = b.agg(
        F.struct(F.count("*").alias("rows"), F.count(col).alias("known"), F.min(col).alias("lowest"))
    ).scalar()
    below = (other["rows"] == other["known"]) & (F.col(col) < other["lowest"])
    return a.filter((other["rows"] == 0) | below)


def correlated_count(
    a: DataFrame, b: DataFrame, lk: str, rk: str, pred: Column | None = None, out: str = "taken"
) -> DataFrame:
    """Per row of ``a``, how many rows of ``b`` match; counted first, then joined."""
    matching = b if pred is None else b.filter(pred)
    counts = matching.groupBy(F.col(rk).alias("_rk")).agg(F.count("*").alias("_n"))
    return (
        a.join(counts, a[lk] == counts["_rk"], "left")
        .withColumn(out, F.coalesce("_n", F.lit(0)))
        .drop("_rk", "_n")
    )


def correlated_next_key(df: DataFrame, key: str) -> DataFrame:
    """Per key, the next larger key minus one; NULL for the largest."""
    keys = df.select(F.col(key).cast("bigint").alias(key)).distinct()
    near = with_adjacent(ordered_slices(keys, [key]), [], [key], {key: "_next"}, step=1)
    return near.select(key, (F.col("_next") - 1).alias("stop"))


def shifted_self_join(df: DataFrame, key: str) -> DataFrame:
    """key + 1 wherever that key is absent: the first free key after each run."""
    keys = df.select(F.col(key).cast("bigint").alias(key)).filter(F.col(key).isNotNull()).distinct()
    after = keys.select((F.col(key) + 1).alias("empty_key"))
    return after.join(keys, after["empty_key"] == keys[key], "left_anti")


def composite_key_join(df: DataFrame, person: str, date: str) -> DataFrame:
    """Rows of each person's earliest date."""
    first = df.groupBy(person).agg(F.min(date).alias(date))
    return df.join(first, [person, date])


def relational_division(link: DataFrame, item: str, owner: str, owners: Sequence) -> DataFrame:
    """Items linked to every one of the given owners."""
    wanted = list(dict.fromkeys(owners))
    return (
        link.filter(F.col(owner).isin(wanted))
        .groupBy(item).agg(F.count_distinct(owner).alias("_n"))
        .filter(F.col("_n") == len(wanted))
        .select(item)
    )


def left_join_zero_preserving_count(a: DataFrame, b: DataFrame, lk: str, rk: str, out: str = "matches") -> DataFrame:
    """Number of matches per row of ``a``, 0 kept."""
    return correlated_count(a, b, lk, rk, out=out)


def join_unmatched_parent_union(
    classes: DataFrame, ships: DataFrame, outcomes: DataFrame, key: str, ship_name: str, ship_class: str, outcome_ship: str
) -> DataFrame:
    """(class columns, name): every class with its ships, plus lead ships known only from outcomes.

    A lead ship bears the name of its class; it counts when it occurs in outcomes and not in ships.
    """
    fleet = ships.select(F.col(ship_name).alias("name"), F.col(ship_class).alias("_class"))
    listed = left_outer_join(classes, fleet, key, "_class").drop("_class")
    seen = outcomes.select(F.col(outcome_ship).alias("name")).distinct()
    unlisted = seen.join(fleet.select("name").distinct(), "name", "left_anti")
    leads = classes.join(unlisted, classes[key] == unlisted["name"]).distinct()
    return listed.unionByName(leads)
