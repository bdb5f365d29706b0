"""Hard negatives against brute force: several cells, blocks and portions, copies, ties, odd vectors, large numbers; what the tree rules out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import hard_negatives as hn
from tablewright.llm.hard_negatives import Settings
from tests.oracle import compare, connect

SCHEMA = "vec_id bigint, embedding array<double>, label int, v int, ids string, a string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "clash", "clash") for i, v, c in rows], SCHEMA).repartition(3)


def brute(rows, every, positives=5, negatives=10, low=30, high=90):
    fine = {}
    for i, v, c in rows:
        if i is None or c is None or v is None or any(x is None or not math.isfinite(x * 256) for x in v):
            continue
        fine[i, c, tuple(math.floor(x * 256) for x in v)] = None
    out = []
    for i, c, v in fine:
        if i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, d) for j, d, w in fine if j != i]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2] == c][:positives]:
            fits = [r for r in scored if r[2] != c and low * ps <= 100 * r[0] <= high * ps]
            out += [(i, p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, every, **settings):
    return sorted(map(tuple, hn.mine(frame(spark, rows), F.col("id") % every == 0, settings=Settings(**settings)).collect()))


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (1001, None, 1), (1002, [0.1, None, 0.3], 1), (1003, [nan, 0.0, 0.0], 1), (1004, [inf, 0.0, 0.0], 2), (1005, [0.1, 0.2, 0.3], None),
        (None, [0.1, 0.2, 0.3], 1), (1010, [], 1), (1020, [0.0, 0.0, 0.0], 2), (1030, [0.5], 0), (1030, [0.5], 0),
    ]


def test_small_table_with_odd_rows(spark):
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(size=3).round(1).tolist(), int(pick.integers(3))) for i in range(80)] + odd_rows()
    rows += [(200 + i, rows[4][1], i % 3) for i in range(60)]  # copies with different labels
    rows += [(7, rows[7][1], rows[7][2])] * 2
    want = brute(rows, 10)
    assert len(want) > 100 and mined(spark, rows, 10) == want
    assert mined(spark, rows, 10, positives=2, negatives=3, low=10, high=60) == brute(rows, 10, 2, 3, 10, 60)


@pytest.mark.parametrize("clustered", [False, True])
def test_many_cells(spark, clustered):
    """Small cells, blocks, leaves and portions, so that routing and ranges matter."""
    pick = np.random.default_rng(5)
    x = pick.normal(size=(900, 12))
    if clustered:
        x = 3 * pick.normal(size=(12, 12))[pick.integers(0, 12, 900)] + 0.2 * x
    rows = [(i, v.tolist(), int(pick.integers(4))) for i, v in enumerate(x)]
    want = brute(rows, 9)
    assert len(want) > 1000
    assert mined(spark, rows, 9, cell_rows=64, leaf_rows=8, portion=16, fan_out=4) == want


def test_numbers_beyond_doubles(spark):
    """Inner products that no double holds exactly are compared exactly."""
    pick = np.random.default_rng(8)
    rows = [(i, (pick.integers(-(2**20), 2**20, 6) + 0.5).tolist(), i % 2) for i in range(60)]
    assert mined(spark, rows, 6) == brute(rows, 6)
    q, x = np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 1.0], [3.0, 5.0]])
    assert hn.products(q, x).tolist() == [[hn.MOST, 3 * 2**40 + 5]]


def test_empty_and_single(spark):
    assert mined(spark, odd_rows()[:6], 10) == []
    assert mined(spark, [(10, [1.0], 1)], 10) == []
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 1), (12, [0.5], 2)], 10) == [(10, 11, 1, 12, 65536, 32768)]


def test_ranges_rule_rows_out():
    """On clustered vectors a block makes few of all products, and none that matters is left out."""
    pick = np.random.default_rng(9)
    x = np.floor(40 * pick.normal(size=(40, 24))[pick.integers(0, 40, 4000)] + pick.normal(size=(4000, 24)))
    labels, first = pick.integers(0, 4, 4000), np.arange(4000)
    top = (x * x).sum(axis=1).max()
    q, own = x[:50], labels[:50]
    lows, highs = np.full((50, 1), hn.LEAST), np.full((50, 1), hn.MOST)
    of, _, row, score, made = hn.search_block(x, labels, first, q, own, lows, highs, True, 6, top, Settings(leaf_rows=64))
    assert made < 0.35 * 50 * 4000
    for i in range(50):
        best = sorted(((-int(q[i] @ x[r]), r) for r in range(4000) if labels[r] == own[i]))[:6]
        assert sorted(zip((-score[of == i]).tolist(), row[of == i].tolist())) == best


def test_query_agrees_with_sql_at_two_sizes(spark):
    from tablewright.llm.queries import ORACLES, QUERIES

    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert compare(QUERIES["op11_hard_negatives"](spark, folder), connect(folder), ORACLES["op11_hard_negatives"]) == []
