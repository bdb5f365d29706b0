"""Periodic runs against brute force: every period of every text, whole rows of the query, portions, colliding names."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tablewright.llm import runs
from tablewright.llm.queries import looped
from tests.llm.conftest import EDGES


def brute(words, least=24, times=3):
    """(start, length, period) of all maximal stretches of smallest period, straight from the definition."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)  # periods come in ascending order: the smallest stays
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def samples():
    pick = random.Random(13)
    for _ in range(150):
        kind, out = pick.randrange(4), []
        if kind == 0:
            out = [pick.choice("ab") for _ in range(pick.randrange(200))]
        else:
            while len(out) < 40 * kind:
                part = [pick.choice("abc" if kind < 3 else "abcdefgh") for _ in range(pick.randrange(1, 20))]
                out += part * pick.randrange(1, 8)
                if pick.random() < 0.3:
                    out += out[-pick.randrange(1, 40):] * 2
        yield [w.encode() for w in out]
    yield [b"w"] * 3000
    yield [b"a"] * 500 + [b"b"] + [b"a"] * 900 + [b"c"] + [b"a"] * 700
    yield [str(i % 7).encode() for i in range(24)] + [b"x"] + [b"y"] * 23
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 1500:
        fib = fib[1], fib[1] + fib[0]
    yield fib[1]


def test_runs_of_all_periods():
    texts = list(samples())
    got = runs.runs_of(texts)
    for words, found in zip(texts, got):
        assert [tuple(r) for r in found.tolist()] == brute(words)
    assert sum(map(len, got)) > 100
    for words, found in zip(texts, runs.runs_of(texts, least=5, times=4)):
        assert [tuple(r) for r in found.tolist()] == brute(words, 5, 4)
    with pytest.raises(ValueError):
        runs.runs_of(texts, times=2)


@pytest.mark.parametrize("step, bits", [(1, 64), (7, 64), (64, 64), (1000, 8), (50, 8)])
def test_portions_and_colliding_names(step, bits):
    """Words one by one or in portions, with names so narrow that different words collide."""
    for words in list(samples())[::9]:
        ids = np.array([int.from_bytes(w, "big") for w in words], dtype=np.int64)
        catchers = runs.Catchers(len(ids), len(ids), bits=bits)
        for at in range(0, len(ids), step):
            catchers.append(ids[at:at + step])
        assert [tuple(r) for r in catchers.runs().tolist()] == brute(words)


def test_online_reports_run_while_words_come():
    catchers = runs.Catchers(100, 100)
    for i in range(60):
        catchers.append(np.array([i % 5]))
        want = [[0, i + 1, 5]] if i + 1 >= 24 else []
        assert catchers.runs().tolist() == want
    catchers.append(np.array([9, 9, 9]))
    assert catchers.runs().tolist() == [[0, 60, 5]]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest(),
    )


def test_query_rows(spark, docs):
    pick = random.Random(5)
    rows = [*EDGES, (11, "a\x1cb " * 30), (12, "\x85 x   " * 40), (13, "one two\tthree\r\n" * 9)]
    rows += [(i, " ".join(pick.choice("abcdefg") * pick.randrange(1, 3) for _ in range(pick.randrange(120)))) for i in range(100, 220)]
    got = runs.report(runs.find_runs(looped(docs(rows)))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t) for i, t in rows), key=repr)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_real_texts_and_empty_table(spark, docs):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = runs.report(runs.find_runs(looped(source))).collect()
    want = {r.doc_id: expected(r.doc_id, r.text) for r in source.collect() if len((r.text or "").split()) < 1200}
    assert len(want) > 100 and all(tuple(r) == want[r.doc_id] for r in got if r.doc_id in want)
    assert runs.report(runs.find_runs(docs([]).limit(0))).collect() == []


def test_general_output_and_clashing_columns(spark):
    rows = [(7, "say " * 30 + "it", "a", "b", "c")]
    table = spark.createDataFrame(rows, "k bigint, t string, runs string, collapsed string, n_words string")
    (row,) = runs.find_runs(table, key="k", text="t").collect()
    assert (row.k, row.n_words, row.collapsed, [tuple(r) for r in row.runs]) == (7, 31, "say it", [(0, 30, 1)])
