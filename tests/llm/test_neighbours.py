"""Nearest neighbours against brute force, with copies, ties and unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import neighbours as nb


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, rank int").repartition(3)


def brute(rows, k):
    """query to [(id, score)], from the usable rows."""
    fine = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and None not in v]
    fine = [(i, v) for i, v in fine if np.isfinite(v).all() and v.any()]
    sizes = [len(v) for _, v in fine]
    width = min(sizes, key=lambda n: (-sizes.count(n), n))
    fine = [(i, v) for i, v in fine if len(v) == width]
    out = {}
    for q, x in fine:
        if q % 5 == 0:
            each = sorted(((-float((v * x).sum()), i) for i, v in fine if i != q))
            out[q] = [(i, -s) for s, i in each[:k]]
    return out


def check(got, want, exact=True):
    by_query = {}
    for r in got:
        by_query.setdefault(r.query, []).append((r["rank"], r.id, r.score))
    hits = total = 0
    for q, near in want.items():
        mine = sorted(by_query.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(near)
        hits += len({m[1] for m in mine} & {i for i, _ in near})
        total += len(near)
        if exact:
            assert [(m[1], pytest.approx(m[2], abs=1e-12)) for m in mine] == near
    assert set(by_query) <= set(want)
    return hits / max(1, total)


def test_small_tables_are_exact(spark):
    pick = np.random.default_rng(1)
    rows = [(i, pick.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # copies: ties go to the smaller id
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (204, [float("nan")] * 6), (205, [float("inf")] * 6), (206, [1.0, 2.0]), (None, [1.0] * 6)]
    s = nb.Settings(k=7)
    got = nb.nearest(frame(spark, rows), F.col("id") % 5 == 0, settings=s).collect()
    check(got, {q: [(i, pytest.approx(x, abs=1e-12)) for i, x in near] for q, near in brute(rows, 7).items()}, exact=False)
    want = brute(rows, 7)
    for q, near in want.items():
        mine = sorted((r["rank"], r.id) for r in got if r.query == q)
        assert [i for _, i in mine] == [i for i, _ in near]


def test_few_and_no_candidates(spark):
    assert nb.nearest(frame(spark, [(1, None)]), F.col("id") % 5 == 0).collect() == []
    got = nb.nearest(frame(spark, [(5, [1.0, 0.0]), (6, [1.0, 1.0]), (7, [0.5, 0.0])]), F.col("id") % 5 == 0).collect()
    assert sorted((r["rank"], r.id, r.score) for r in got) == [(1, 6, 1.0), (2, 7, 0.5)]
    assert nb.nearest(frame(spark, [(5, [1.0])]), F.col("id") % 5 == 0).collect() == []


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_many_cells(spark, clustered):
    """Small cells, blocks and portions, so that routing and stopping matter; norms differ."""
    pick = np.random.default_rng(2)
    x = pick.normal(size=(1500, 24)) * pick.uniform(0.5, 2, size=(1500, 1))
    if clustered:
        x = pick.normal(size=(15, 24))[pick.integers(0, 15, 1500)] + 0.15 * x
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    s = nb.Settings(k=10, cell_rows=100, leaf_rows=16, portion=16)
    got = nb.nearest(frame(spark, rows), F.col("id") % 5 == 0, settings=s).collect()
    assert check(got, brute(rows, 10), exact=False) >= 0.95


def test_chi_square_tail():
    assert nb.chi2_tail(np.array([0.0]), 8)[0] == 1.0
    # tabulated: the upper 5 % and 1 % of eight degrees
    assert nb.chi2_tail(np.array([15.5073, 20.0902]), 8) == pytest.approx([0.05, 0.01], abs=1e-4)


def test_stopping_leaves_most_rows_unverified():
    """50,000 random unit vectors, block by block with the bound carried on: share verified below 0.3, recall above 0.9."""
    pick = np.random.default_rng(4)
    x = pick.normal(size=(50_000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    s = nb.Settings()
    directions = pick.normal(size=(65, s.dimensions))
    top = (x * x).sum(axis=1).max()
    px = x @ directions[:64] + np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None] * directions[64]
    q, n = x[:40], 40
    bound, found, verified = np.full(n, np.inf), [[] for _ in range(n)], 0
    for at in range(0, len(x), 8192):
        of, row, score, made = nb.search_block(x[at:at + 8192], px[at:at + 8192], q, q @ directions[:64], top, bound, s)
        verified += made
        for i, r, v in zip(of.tolist(), row.tolist(), score.tolist()):
            found[i].append((-v, r + at))
        for i in range(n):
            found[i] = sorted(found[i])[: s.k + 1]
            bound[i] = 1 + top + 2 * found[i][-1][0]
    hits = 0
    for i in range(n):
        true = np.argsort(-(x @ q[i]), kind="stable")[: s.k + 1]
        hits += len(set(true.tolist()) & {r for _, r in found[i]})
    assert verified < 0.3 * n * len(x) and hits >= 0.9 * n * (s.k + 1)


def test_stopping_value_is_the_quantile():
    assert nb.chi2_bound(0.05, 8) == pytest.approx(15.5073, abs=1e-3) and nb.chi2_bound(0.01, 8) == pytest.approx(20.0902, abs=1e-3)
