"""Mixing against a plain computation: targets, exact quotas, disjoint draws, the tree's distribution, reruns, odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.llm import mixing
from tablewright.llm.mixing import Settings


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """source to target, sharing again what is over until no target is above ``most`` times its source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        each = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if each[s] > most * sizes[s]]
        if not over:
            return out | each
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def sample(n=700, seed=1):
    pick = random.Random(seed)
    names = ["a", "Z", "é", "\U0001f600", "", "b b", "", None]
    rows = []
    for i in range(n):
        source = "hot" if pick.random() < 0.4 else pick.choice(names)
        rows.append((i, " ".join("w" * pick.randrange(1, 5) for _ in range(pick.choice([0, 1, 5, 30, 200]))), source))
    rows += [(None, "a null key", "a"), (5000, None, "Z"), (5001, "", "nothing"), (5002, "x\ty\x1cz   ", "b b")]
    return rows + [(6000, "the same row again", "hot")] * 90


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id bigint, text string, source string, size string, no int, n int").repartition(3)

    return make


def test_targets_and_words_taken(spark, table):
    rows = sample()
    mixed = mixing.mix(table(rows), settings=Settings(block_rows=16, shard_words=700)).cache()
    got = mixing.report(mixed).collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((i, words(t)) for i, t, _ in rows if i is not None)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    want = targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in mixed.collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert len(r.drawn) <= 2 and sorted(d["round"] for d in r.drawn) == list(range(len(r.drawn)))
        taken[r.source] += r.size * len(r.drawn)
        largest[r.source] = max(largest[r.source], r.size)
    for s, target in want.items():
        assert abs(taken[s] - target) <= largest[s] / 2
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)


def test_shards(spark, table):
    """Blocks are dealt whole and exactly, rows are in some shuffled order, and another run gives the same mix."""
    rows = sample()
    s = Settings(block_rows=8, shard_words=900)
    mixed = mixing.mix(table(rows), settings=s).cache()
    out = mixing.shard_rows(mixed).collect()
    again = mixing.shard_rows(mixing.mix(table(rows[::-1]).coalesce(1), settings=s)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)
    assert Counter((r.id, r.nth, r.source, r.size) for r in out) == Counter(
        {(r.id, r.nth, r.source, r.size): len(r.drawn) for r in mixed.collect() if len(r.drawn)}
    )
    by_shard = Counter(r.shard for r in out)
    assert len(by_shard) > 5 and sorted(by_shard) == list(range(len(by_shard)))
    for shard, n in by_shard.items():
        assert sorted(r.place for r in out if r.shard == shard) == list(range(1, n + 1))
    in_order = [r.id for r in sorted(out, key=lambda r: (r.shard, r.place)) if r.id is not None]
    assert sum(a < b for a, b in zip(in_order, in_order[1:])) < 0.6 * len(in_order)


@pytest.mark.parametrize("shards", [1, 2, 5, 13])
def test_quotas_are_met_exactly(spark, shards):
    counts = {0: 40, 1: 1, 3: 7, 4: 90}
    quotas = spark.createDataFrame(list(counts.items()), "no bigint, n bigint")
    dealt = mixing.split_quotas(quotas, shards, 138, 3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in dealt:
        by_source[r.no] += r.n
        by_shard[r.shard] += r.n
        assert r.n > 0
    assert by_source == counts
    assert by_shard == {i: 138 * (i + 1) // shards - 138 * i // shards for i in range(shards)}


def test_the_split_is_hypergeometric(spark):
    """Mean and variance of one source's count in the first of four shards, over many seeds."""
    quotas = spark.createDataFrame([(0, 12), (1, 20), (2, 8)], "no bigint, n bigint").coalesce(1).cache()
    draws = []
    frames = [mixing.split_quotas(quotas, 4, 40, seed).where("shard = 0 and no = 1") for seed in range(150)]
    for at in range(0, 150, 50):
        union = frames[at]
        for f in frames[at + 1:at + 50]:
            union = union.unionByName(f)
        found = [r.n for r in union.collect()]
        draws += found + [0] * (50 - len(found))
    mean = sum(draws) / len(draws)
    variance = sum((x - mean) ** 2 for x in draws) / len(draws)
    # 10 of 40 pairs, 20 of them of this source: mean 5, variance 10 * 1/2 * 1/2 * 30/39
    assert abs(mean - 5) < 0.4 and abs(variance - 75 / 39) < 0.7


def test_no_words_one_source_and_no_rows(spark, table):
    got = mixing.report(mixing.mix(table([(1, "", "a"), (2, None, "b")]))).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    got = mixing.report(mixing.mix(table([(i, "one two", "only") for i in range(40)]))).collect()
    assert sum(r.taken for r in got) == 120 and {r.target for r in got} == {120.0}
    assert mixing.report(mixing.mix(table([(1, "a", "a")]).limit(0))).collect() == []


def test_other_weights_and_shares(spark, table):
    rows = sample(200, 4)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    for weights, share, most in (((1,), (1, 4), 1), ((5, 2), (9, 2), 3), ((1,), (4, 1), 2)):
        mixed = mixing.mix(table(rows), settings=Settings(weights=weights, share=share, most=most)).collect()
        want = targets(dict(sizes), weights, share[0] / share[1], most)
        assert all(r.target == pytest.approx(want[r.source], rel=1e-9) for r in mixed)


def test_plan_has_no_python(spark):
    from tablewright.llm.queries import QUERIES

    plan = QUERIES["op12_mix_sources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))
