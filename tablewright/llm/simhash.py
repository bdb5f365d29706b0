"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints that differ in at most d bits agree on two of d + 2 blocks of bits, so the index has an upper node for
each pair of blocks and each shared pattern of theirs. A node with more members than fit a task is factored again in the same way by
its other bits until it fits; after three levels at most a few hundred patterns are left to differ, so this always ends
and nothing is capped. Within a node the members are sorted by Gray rank, which puts fingerprints next to each other that differ
in few bits. Runs of consecutive members are factored into inner nodes (the bits they all share); pairs of inner nodes whose shared bits
already differ in more than d places are pruned with all their members, the rest is opened down to the members.
What a node found leaves it as a spanning forest, not as pairs, and `components` puts the nodes together.

Edge cases: NULL, empty and blank texts have fingerprint zero, which is linked like any other; fewer words than a shingle
make one shingle of all; rows with a NULL doc_id are kept (component_id is NULL only if its whole component has no
doc_id); repeated rows each give their row; extra columns are left out; a table without rows gives no rows. `keep_one` keeps all
columns, and of a group the row with the smallest doc_id (rows without doc_id come last, then by digest of the text), of rows equal in both one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import free_names, text_column, write_scratch
from tablewright.llm.components import components

#: Members of an index node that one task takes at once; larger nodes are factored further.
NODE_ROWS = 2_048
#: Members of an inner node, and of a node above those.
FAN = 8
#: Pairs held in memory while a node is searched.
PAIRS_AT_ONCE = 1 << 17

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in more than half of the 64-bit hashes, as an unsigned number; zero for none."""
    if not len(hashes):
        return 0
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, c], minlength=256) @ _BYTE_BITS for c in range(8)])
    return sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist())


def shingle_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by a space; of all words, if they are fewer."""
    import xxhash

    if not words:
        return np.empty(0, dtype=np.uint64)
    hash64, line = xxhash.xxh64_intdigest, b" ".join(words)
    size = min(size, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    found = [hash64(line[a:b], seed) for a, b in zip(starts, ends[size - 1:].tolist())]
    return np.array(found, dtype=np.uint64)


def ascii_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; bytes.lower and bytes.split know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42, into: str = "fp") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint of each whole text."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([simhash(shingle_hashes(ascii_words(t), shingle, seed)) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return docs.withColumn(into, fingerprint(text_column(text)))


def gray_rank(column: str):
    """Place of a 64-bit code in Gray order, as a signed number that sorts like the unsigned one."""
    rank = F.col(column)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(2**63)))


def block_masks(within: int, distance: int) -> list[int]:
    """Cut the set bits of ``within`` into distance + 2 blocks; the masks of all pairs of blocks."""
    bits = [b for b in range(64) if within >> b & 1]
    n = distance + 2
    blocks = [sum(1 << b for b in bits[len(bits) * k // n: len(bits) * (k + 1) // n]) for k in range(n)]
    return [a | b for a, b in itertools.combinations(blocks, 2)]


def _bits(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


class _Level:
    """Nodes over runs of the level below: bits that all members share, and their values."""

    def __init__(self, mask, pattern, owner, first, last):
        self.mask, self.pattern, self.owner, self.first, self.last = mask, pattern, owner, first, last


def _factor(low: _Level) -> _Level:
    """Nodes above ``low``: runs of up to FAN neighbours of one owner."""
    n = len(low.owner)
    begins = np.concatenate(([True], low.owner[1:] != low.owner[:-1]))
    place = np.arange(n) - np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    first = np.flatnonzero(place % FAN == 0)
    ones = np.bitwise_and.reduceat(low.pattern, first)
    zeros = np.bitwise_and.reduceat(low.mask & ~low.pattern, first)
    return _Level(ones | zeros, ones, low.owner[first], first, np.append(first[1:], n))


def _open(pairs_a, pairs_b, level: _Level):
    """All pairs of children of pairs of nodes; a node with itself gives each pair of its children once, and each child with itself."""
    size_a, size_b = level.last[pairs_a] - level.first[pairs_a], level.last[pairs_b] - level.first[pairs_b]
    each = size_a * size_b
    of = np.repeat(np.arange(len(pairs_a)), each)
    k = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    a = level.first[pairs_a][of] + k // size_b[of]
    b = level.first[pairs_b][of] + k % size_b[of]
    keep = (pairs_a[of] != pairs_b[of]) | (a <= b)
    return a[keep], b[keep]


def _forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Lower the root of every linked member until all links agree."""
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def search_nodes(node: np.ndarray, codes: np.ndarray, distance: int) -> np.ndarray:
    """Smallest linked member (as a position) of each code.

    ``node`` numbers the index nodes in ascending order, ``codes`` are unsigned and in Gray order within a node.
    """
    n = len(codes)
    root = np.arange(n)
    full = np.uint64(2**64 - 1)
    levels = [_Level(np.full(n, full), codes, node, np.arange(n), np.arange(1, n + 1))]
    while len(levels[-1].owner) > len(np.unique(levels[-1].owner)):
        levels.append(_factor(levels[-1]))
    top = len(levels) - 1
    start = np.arange(len(levels[top].owner))

    def descend(a: np.ndarray, b: np.ndarray, depth: int) -> None:
        nonlocal root
        at = levels[depth]
        differ = _bits((at.pattern[a] ^ at.pattern[b]) & at.mask[a] & at.mask[b])
        near = differ <= distance
        a, b = a[near], b[near]
        if depth == 0:
            root = _forest(n, a, b, root)
            return
        step = max(1, PAIRS_AT_ONCE // (FAN * FAN))
        for k in range(0, len(a), step):
            descend(*_open(a[k:k + step], b[k:k + step], at), depth - 1)

    descend(start, start, top)
    return root


def _factored(level: DataFrame, distance: int) -> DataFrame:
    """(tag, fp, mask) to (tag, fp, mask, pattern): each code in every node below its own, by the bits its node does not share yet."""
    full = 2**64 - 1

    def run(batches):
        below: dict[int, np.ndarray] = {}
        for batch in batches:
            tag, fp, mask = (batch.column(c).to_numpy() for c in ("tag", "fp", "mask"))
            for m in np.unique(mask).tolist():
                if m not in below:
                    bits = m & full
                    below[m] = np.array([bits | b for b in block_masks(full & ~bits, distance)], dtype=np.uint64).view(np.int64)
                at, masks = np.flatnonzero(mask == m), below[m]
                codes = np.repeat(fp[at], len(masks))
                lower = np.tile(masks, len(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.repeat(tag[at], len(masks)), codes, lower, codes & lower)], names=["tag", "fp", "mask", "pattern"]
                )

    return level.select("tag", "fp", "mask").mapInArrow(run, "tag int, fp long, mask long, pattern long")


def _node_links(rows: DataFrame, distance: int) -> DataFrame:
    """Rows (tag, mask, pattern, fp, rank) of nodes that fit a task to links (tag, a, b)."""
    node = ("tag", "mask", "pattern")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def links(part: pa.Table):
            fp, names = part.column("fp").to_numpy(), [part.column(c).to_numpy() for c in node]
            new = np.concatenate(([False], np.any([x[1:] != x[:-1] for x in names], axis=0)))
            root = search_nodes(np.cumsum(new), fp.view(np.uint64), distance)
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (names[0][moved], fp[moved], fp[root[moved]])], names=["tag", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            # the last node may go on in the next batch; it has at most NODE_ROWS members
            ended = np.flatnonzero(np.any([(x := batch.column(c).to_numpy()) != x[-1] for c in node], axis=0))
            if len(ended):
                cut = int(ended[-1]) + 1
                yield links(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
                held = [batch.slice(cut)]
        if held:
            yield links(pa.Table.from_batches(held))

    ordered = rows.repartition(*node).sortWithinPartitions(*node, "rank")
    return ordered.select(*node, "fp").mapInArrow(run, "tag int, a long, b long")


def near_links(fps: DataFrame, distance: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (tag, a, b) that connect all distinct fingerprints (columns tag, fp) of one tag within ``distance`` bits of each other.

    Two fingerprints that near are connected by links, directly or through others that are as near to each other.
    """
    if node_rows < 256:
        raise ValueError("factoring ends at nodes of 256 patterns")
    node = ["tag", "mask", "pattern"]
    level = fps.select("tag", "fp").distinct().withColumn("mask", F.lit(0).cast("long"))
    found = None
    while True:
        rows = write_scratch(_factored(level, distance), "simhash-nodes")
        sizes = rows.groupBy(*node).count()
        fit = rows.join(sizes.where(F.col("count").between(2, node_rows)).drop("count"), node, "left_semi")
        links = _node_links(fit.withColumn("rank", gray_rank("fp")), distance)
        found = links if found is None else found.union(links)
        large = sizes.where(F.col("count") > node_rows).drop("count")
        if large.isEmpty():
            return found
        # two nodes may lead to one and the same node below
        level = rows.join(large, node, "left_semi").select("tag", "fp", "mask").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: key, fp (long), component_id: the smallest key among all texts that links lead to."""
    marked = write_scratch(with_fingerprint(docs.select(F.col(key).alias("k"), text_column(text).alias("t")), "t", shingle).select("k", "fp"), "simhash")
    codes = marked.groupBy("fp").agg(F.min("k").alias("least"))
    labels = components(near_links(codes.select(F.lit(0).alias("tag"), "fp"), distance).select("a", "b"))
    named = codes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # first the fingerprints get their component's id, one row each; only then the documents theirs
    ids = named.join(lowest, "component").select("fp", "component_id")
    return marked.join(ids, "fp", "left").select(F.col("k").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each group of texts whose fingerprints links lead to."""
    digest = F.md5(text_column(text).cast("binary"))
    row = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), digest.alias("digest"))
    found = write_scratch(near_duplicates(docs.select(row.alias("row"), F.col(text).alias("text")), "row", "text", shingle, distance), "simhash-groups")
    # rows that equal each other in both are counted here, so that only they need to be looked at as a whole
    kept = found.where(F.col("row") == F.col("component_id")).groupBy("row").agg(F.count("*").alias("times"))
    kept = write_scratch(kept.select("row.id", "row.digest", "times"), "simhash-kept")
    (own,) = free_names([*docs.columns, "id", "digest", "times"], "text_digest")

    def among(rows: DataFrame) -> DataFrame:
        # columns are named by their frame, so that no name of theirs can clash
        told = docs.withColumn(own, F.md5(text_column(text).cast("binary")))
        return told.join(rows, told[key].eqNullSafe(rows["id"]) & (told[own] == rows["digest"]), "left_semi")

    single = among(kept.where("times = 1")).drop(own)
    return single.union(among(kept.where("times > 1")).dropDuplicates([key, own]).drop(own))
