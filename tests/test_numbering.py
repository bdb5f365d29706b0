"""Numbering, neighbours, lists and key jobs against plain Python, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import keys as ky
from tablewright.operators.lists import joined_text, ordered_list
from tablewright.operators.numbering import (
    SLICE, adjacent, explode_range, ordered_slices, running_sum, with_adjacent, with_row_index, with_running_sum,
)
from tablewright.operators.ranking import surrogate_keys


@pytest.fixture(scope="module")
def skewed():
    """(group, seq, value) rows; two thirds belong to one group, one group is NULL."""
    pick = random.Random(7)
    groups = ["hot"] * 400 + [pick.choice(["a", "b", "c", None]) for _ in range(200)]
    pick.shuffle(groups)
    return [(g, i, pick.randint(0, 5)) for i, g in enumerate(groups)]


def by_group(data):
    order = {}
    for g, i, v in sorted(data, key=lambda r: r[1]):
        order.setdefault(g, []).append((i, v))
    return order


def frame(spark, data):
    return spark.createDataFrame(data, "g string, i bigint, v bigint").repartition(5)


def test_hot_group_is_spread_over_slices(spark, skewed):
    slices = ordered_slices(frame(spark, skewed), ["g", "i"], slices=8)
    used = {r[0] for r in slices.filter("g = 'hot'").select(SLICE).distinct().collect()}
    assert len(used) > 3


def test_running_sum_and_index(spark, skewed, rows):
    slices = ordered_slices(frame(spark, skewed), ["g", "i"], slices=8)
    done = with_row_index(with_running_sum(slices, ["g"], ["i"], F.col("v"), "before"), ["g"], ["i"], "nth")
    want = []
    for g, members in by_group(skewed).items():
        total = 0
        for nth, (i, v) in enumerate(members):
            want.append((i, total, nth))
            total += v
    assert rows(done, "i", "before", "nth") == sorted(want)


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbours(spark, skewed, rows, step):
    slices = ordered_slices(frame(spark, skewed), ["g", "i"], slices=8)
    done = with_adjacent(slices, ["g"], ["i"], {"v": "near", "i": "near_i"}, step)
    want = []
    for members in by_group(skewed).values():
        for nth, (i, _) in enumerate(members):
            at = nth + step
            near = members[at] if 0 <= at < len(members) else (None, None)
            want.append((i, near[1], near[0]))
    assert rows(done, "i", "near", "near_i") == sorted(want, key=lambda r: r[0])


def test_one_group_holds_most_rows(spark, skewed, rows):
    df = frame(spark, skewed)
    sums, near = [], []
    for members in by_group(skewed).values():
        total, before = 0, None
        for i, v in members:
            sums.append((i, total))
            near.append((i, before))
            total, before = total + v, v
    assert rows(running_sum(df, ["g"], ["i"], F.col("v"), "before"), "i", "before") == sorted(sums)
    assert rows(adjacent(df, ["g"], ["i"], {"v": "prev"}), "i", "prev") == sorted(near, key=lambda r: r[0])


def test_global_order(spark, rows):
    data = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(k,) for k in data], "k bigint")
    done = with_row_index(ordered_slices(df, ["k"], slices=7), [], ["k"], "nth")
    assert rows(done, "nth", "k") == list(enumerate(sorted(data)))


def test_more_slices_than_rows(spark, rows):
    df = spark.createDataFrame([(2,), (1,)], "k bigint")
    done = with_adjacent(ordered_slices(df, ["k"], slices=20), [], ["k"], {"k": "prev"})
    assert rows(done, "k", "prev") == [(1, None), (2, 1)]


def test_explode_range_in_chunks(spark, rows):
    df = spark.createDataFrame([(1, 10), (20, 20)], "lo bigint, hi bigint")
    assert rows(explode_range(df, "lo", "hi", "k", chunk=3), "k") == [(k,) for k in [*range(1, 11), 20]]


@pytest.mark.parametrize("distinct", [False, True])
def test_lists_one_row_per_name(spark, rows, distinct):
    pick = random.Random(11)
    data = [("hot", pick.choice("abcdefgh")) for _ in range(60)] + [("x", "b"), ("x", "a"), ("x", "b"), ("y", None)]
    df = spark.createDataFrame(data, "k string, name string")
    done = ordered_list(df, ["k"], "name", distinct=distinct)
    want = []
    for key in ("hot", "x"):
        names = sorted(n for k, n in data if k == key)
        names = sorted(set(names)) if distinct else names
        want += [(key, pos, name) for pos, name in enumerate(names, 1)]
    assert rows(done, "k", "pos", "name") == sorted(want)
    if distinct:
        assert rows(joined_text(done, ["k"])) == [("hot", ", ".join("abcdefgh")), ("x", "a, b")]


def test_planning_a_list_runs_no_job_on_sizes(spark):
    """One group of all rows takes the same way as many small ones."""
    df = spark.range(5000).selectExpr("1 AS k", "id % 700 AS name")
    done = ordered_list(df, ["k"], "name")
    assert done.count() == 5000 and done.agg({"pos": "max"}).first()[0] == 5000


def key_frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "id bigint")


def test_worked_example_free_keys(spark, rows):
    df = key_frame(spark, [1, 3, 8])
    assert rows(ky.tf_free_key_ranges(df, "id")) == [(2, 2), (4, 7)]
    assert rows(ky.fn_free_keys_list(df, "id")) == [(1, 2), (2, 4), (3, 5), (4, 6), (5, 7)]


def test_worked_example_compaction(spark, rows):
    renamed, changed = ky.compact_table(key_frame(spark, [1, 3, 8]), "id")
    assert rows(renamed) == [(1,), (2,), (3,)]
    assert rows(changed) == [(1,)]


def test_keys_without_one(spark, rows):
    df = key_frame(spark, [4, 5])
    assert rows(ky.tf_free_key_ranges(df, "id")) == [(1, 3)]
    renamed, changed = ky.compact_table(df, "id")
    assert rows(renamed) == [(1,), (2,)] and rows(changed) == [(2,)]


def test_compaction_follows_the_loop(spark, rows):
    """Moving the largest key into the smallest gap, one at a time, gives the same moves."""
    keys = random.Random(5).sample(range(1, 200), 60)
    now, moves = set(keys), {k: k for k in keys}
    while True:
        gap = next((g for g in range(1, max(now)) if g not in now), None)
        if gap is None:
            break
        largest = max(now)
        now = (now - {largest}) | {gap}
        moves[largest] = gap
    assert rows(ky.proc_compact_keys(key_frame(spark, keys), "id")) == sorted(moves.items())


def test_keys_below_one_are_refused(spark):
    with pytest.raises(Exception, match="keys below 1"):
        ky.proc_compact_keys(key_frame(spark, [0, 2]), "id")


def test_surrogate_keys_keep_given_ones(spark, rows):
    new = spark.createDataFrame([(None, "b"), (0, "a"), (77, "c")], "id bigint, name string")
    done = surrogate_keys(new, key_frame(spark, [5, 9]), "id", ["name"])
    assert rows(done) == [(10, "a"), (11, "b"), (77, "c")]
    empty = key_frame(spark, [])
    assert rows(surrogate_keys(new.filter("id = 0"), empty, "id", ["name"])) == [(1, "a")]
