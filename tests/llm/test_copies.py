"""SimHash components, and what is kept of them, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import simhash
from tablewright.llm.components import components
from tests.llm.conftest import EDGES


def fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(nodes, linked):
    """Smallest member of each node's component."""
    label, todo = {}, set(nodes)
    for n in sorted(nodes):
        if n in todo:
            todo.discard(n)
            reach = [n]
            for a in reach:
                near = {b for b in todo if linked(a, b)}
                todo -= near
                reach += near
            label.update(dict.fromkeys(reach, n))
    return label


@pytest.mark.parametrize("distance,node_rows", [(2, 2048), (2, 256), (3, 256)])
def test_links_of_dense_codes(spark, distance, node_rows):
    """Codes around one centre that share most blocks, so that nodes overflow and are factored again, and some far from it."""
    pick = random.Random(distance * node_rows)
    codes = {0, 2**64 - 1, *(pick.getrandbits(64) for _ in range(20))}
    centre = pick.getrandbits(64)
    for _ in range(700):
        codes.add(centre ^ sum(1 << b for b in pick.sample(range(3, 23), pick.randrange(3, 7))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    fps = spark.createDataFrame([(0, c) for c in signed] + [(1, signed[0])], "tag int, fp bigint")
    links = simhash.near_links(fps, distance, node_rows).cache()
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all((a ^ b).bit_count() > 0 for a, b in pairs)
    want = reachable(codes, lambda a, b: (a ^ b).bit_count() <= distance)
    linked = set(pairs) | {(b, a) for a, b in pairs}
    assert reachable(codes, lambda a, b: (a, b) in linked) == want


def test_search_finds_what_all_pairs_find():
    pick = np.random.default_rng(3)
    codes = np.unique(pick.integers(0, 2**12, 300).astype(np.uint64))
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    node = np.sort(pick.integers(0, 3, len(codes)))
    root = simhash.search_nodes(node, codes, 1)
    want = reachable(range(len(codes)), lambda a, b: node[a] == node[b] and int(codes[a] ^ codes[b]).bit_count() <= 1)
    assert root.tolist() == [want[i] for i in range(len(codes))]


def test_components_of_a_chain_a_star_and_pairs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (200, 201), (None, 3)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_near_duplicates_by_brute_force(spark, docs):
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(EDGES)
    for group in range(6):
        words = pick.choices(vocabulary, k=150)
        for copy in range(8):
            other = list(words)
            for _ in range(copy // 3):
                other[pick.randrange(150)] = pick.choice(vocabulary)
            rows.append((100 + 10 * group + copy, " ".join(other)))
    codes = [fingerprint(t) for _, t in rows]
    label = reachable(sorted(set(codes)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), c in zip(rows, codes):
        if i is not None:
            least[label[c]] = min(i, least.get(label[c], i))
    got = simhash.near_duplicates(docs(rows)).collect()
    have = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr)
    assert have == sorted(((i, c, least.get(label[c])) for (i, _), c in zip(rows, codes)), key=repr)
    assert simhash.near_duplicates(docs([]).limit(0)).collect() == []


def test_one_of_each_group_stays(spark, docs):
    pick = random.Random(9)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = [*EDGES, (None, None), (None, ""), (None, "w0"), (None, "w0")]
    for group in range(12):
        words = pick.choices(vocabulary, k=200)
        for copy in range(6):
            other = list(words)
            for at in pick.sample(range(200), copy // 3):
                other[at] = pick.choice(vocabulary)
            # other case and blanks
            rows.append((100 + 10 * group + copy // 2, "\n ".join(other) if copy == 4 else " ".join(other).upper() if copy == 3 else " ".join(other)))
    codes = [fingerprint(t) for _, t in rows]
    label = reachable(sorted(set(codes)), lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for (i, t), c in zip(rows, codes):
        groups.setdefault(label[c], []).append((i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()))
    source = docs(rows)
    kept = simhash.keep_one(source)
    assert kept.columns == source.columns
    got = [(r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()) for r in kept.collect()]
    assert sorted(got) == sorted(min(g) for g in groups.values()) and len(groups) < 40
    assert simhash.keep_one(docs([]).limit(0)).count() == 0


def test_clashing_names_keep_their_values(spark):
    names = ["row", "id", "digest", "digest_", "times", "k", "t", "fp", "component_id"]
    table = spark.createDataFrame([(1, "a b", *names), (2, "A  b", *names), (3, "c", *names), (3, "c", *names)], ["doc_id", "text", *names])
    assert sorted(map(tuple, simhash.keep_one(table).collect())) == [(1, "a b", *names), (3, "c", *names)]


def test_fingerprints_in_spark(spark, docs):
    got = simhash.with_fingerprint(docs(EDGES), "text").select("text", F.hex("fp")).collect()
    assert all(int(r[1], 16) == fingerprint(r[0]) for r in got)
