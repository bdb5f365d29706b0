"""Token counts and byte-level BPE against the libraries, and merging against a plain loop."""

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import byte_bpe, token_counts
from tablewright.llm.merging import PairTable, merge_all
from tests.llm.conftest import EDGES

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def pieces():
    return token_counts.PieceModel.from_file(P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.RankModel.from_file(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})


def one_pair_at_a_time(symbols, ranks):
    symbols = list(symbols)
    while True:
        best = min(((ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks), default=None)
        if best is None:
            return symbols
        i = best[1]
        symbols[i:i + 2] = [ranks[symbols[i], symbols[i + 1]][1]]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=14), min_size=1, max_size=6))
def test_merging_any_table(seed, sequences):
    """Ranks in any order, ties included, also where a merge makes a pair of a lower rank than its own."""
    pick = random.Random(seed)
    ranks, symbols = {}, list(range(4))
    for product in range(4, 14):
        ranks[pick.choice(symbols), pick.choice(symbols)] = (pick.randrange(6), product)
        symbols.append(product)
    left, right = zip(*ranks)
    table = PairTable(left, right, [r for r, _ in ranks.values()], [p for _, p in ranks.values()], 20)
    flat, lengths = merge_all(np.concatenate([np.array(s) for s in sequences]), np.array([len(s) for s in sequences]), table)
    got = np.split(flat, np.cumsum(lengths)[:-1])
    for have, s in zip(got, sequences):
        want = one_pair_at_a_time(s, ranks)
        assert have.tolist() == want and table.one_by_one(s) == want


TEXTS = [t or "" for _, t in EDGES] + [
    "</s><s>[INST] <0x41> ▁▁x  y", "haha" * 300, " " * 77 + "z", "\n\n\t \n", "it's we'll 12345 'sab", "ab" * 400 + " " * 3, "\x00\x01",
]


def test_counts_like_the_library(spark, docs, pieces):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rows = [*EDGES, *enumerate(TEXTS, 100)]
    got = token_counts.count_tokens(docs(rows), pieces, limit=20).collect()
    want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 20) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk,overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (64, 16), (100, 99)])
def test_encoding_like_the_library(spark, docs, ranks, library, chunk, overlap):
    rows = [*EDGES, *enumerate(TEXTS, 100), (200, " ".join(f"w{i}  'll x" for i in range(300)))]
    source = docs(rows)
    encoded = byte_bpe.encode_texts(source, ranks, chunk=chunk, overlap=overlap)
    told = byte_bpe.encoding_digests(source, ranks, chunk=chunk, overlap=overlap)
    want = []
    for i, t in rows:
        raw = np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes()
        want.append((i, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, told.collect()), key=repr) == sorted(want, key=repr)
    back = byte_bpe.decode_ids(encoded, ranks).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows)


def test_empty_tables(spark, docs, pieces, ranks):
    none = docs([]).limit(0)
    assert token_counts.count_tokens(none, pieces).collect() == []
    assert byte_bpe.encoding_digests(none, ranks).collect() == []
