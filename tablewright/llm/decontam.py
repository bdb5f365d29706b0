"""Benchmark decontamination by greedy string tiling.

A seed is a run of ``least`` words, or a whole item that has fewer. The seeds of the benchmark are put into a bitmap of fixed size; one pass over the documents
keeps of each text the stretches whose seeds are in it (anything else can't be part of a tile). What is left is joined with the
benchmark by seed: pairs of text and item whose shared seeds could cover enough of the item are tiled. Tiling marks the
longest common run of words that is unmarked on both sides, again and again down to ``least`` words; running Karp-Rabin hashes find the
runs, and words are compared before a tile counts. The share of the item's words under tiles is its coverage, whatever the order in which its
pieces stand in the document.

Texts with the same stretches are tiled once, so groups of copies cost one tiling.

Edge cases: NULL and empty texts have no seeds; an item without words is never found, one of fewer than ``least`` words wherever it stands word for word; rows with a NULL
doc_id take part; repeated rows each give their rows, repeated items are items of their own; extra columns are left out; an empty
table on either side gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bitmap_of, free_names, groups_of, mix64, text_column, write_scratch

#: Shortest tile in words, and the share of an item's words that tiles must cover.
LEAST, COVERAGE = 5, 0.8
BASE = np.uint64(0x9E3779B97F4A7C15)

#: Byte table: A-Z in lower case, everything of ASCII but letters and digits to a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class _WordHashes(dict):
    """Hashes of words (never 0), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) or 1
        return value


def word_hashes(text: str, known: dict) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            out = out * BASE + words[k:k + n]
    return mix64(out)


def _open_windows(words: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``size`` unmarked words, and their hashes by a running hash over the whole."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    taken = np.concatenate(([0], np.cumsum(marked)))
    free = np.flatnonzero(taken[size:] == taken[:-size])
    with np.errstate(over="ignore"):
        # prefix sums of word * BASE**place; a window times BASE**(end of all - start) doesn't depend on where it stands
        power = np.cumprod(np.full(len(words), BASE, dtype=np.uint64))
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power, dtype=np.uint64)))
        window = (prefix[size:] - prefix[:-size]) * power[::-1][:n]
    return free, window[free]


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the text, words), longest first, leftmost in the item of equal ones. Word 0 of the text never matches."""
    both = max(len(item), len(text))
    # the same length on both sides makes the running hashes comparable
    a, b = np.zeros(both, np.uint64), np.zeros(both, np.uint64)
    a[: len(item)], b[: len(text)] = item, text
    mark_a, mark_b = np.ones(both, bool), np.ones(both, bool)
    mark_a[: len(item)], mark_b[: len(text)] = False, text == 0
    tiles: list[tuple[int, int, int]] = []

    def common(size: int):
        at_a, hash_a = _open_windows(a, mark_a, size)
        at_b, hash_b = _open_windows(b, mark_b, size)
        return at_a, hash_a, at_b, hash_b, np.intersect1d(hash_a, hash_b)

    most = min(len(item), len(text))
    while most >= least:
        low, high = least - 1, most
        # a common run of some length holds common runs of every smaller one
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[4]) else (low, middle - 1)
        if low < least:
            break
        most = low
        at_a, hash_a, at_b, hash_b, shared = common(low)
        where: dict[int, list[int]] = {}
        for place, code in zip(at_b[np.isin(hash_b, shared)].tolist(), hash_b[np.isin(hash_b, shared)].tolist()):
            where.setdefault(code, []).append(place)
        made = False
        for place, code in zip(at_a.tolist(), hash_a.tolist()):
            if mark_a[place:place + low].any():
                continue
            for other in where.get(code, ()):
                if not mark_b[other:other + low].any() and (a[place:place + low] == b[other:other + low]).all():
                    mark_a[place:place + low] = mark_b[other:other + low] = True
                    tiles.append((place, other, low))
                    made = True
                    break
        if not made:  # only hashes agreed
            most -= 1
    return tiles


def benchmark_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, words as hashes, seeds) of each row of the benchmark."""

    def run(batches):
        known = _WordHashes()
        for batch in batches:
            words = [word_hashes(t, known) for t in batch.column(1).to_pylist()]
            seeds = [window_hashes(w, min(LEAST, len(w))) if len(w) else w for w in words]
            lists = [pa.array([x.view(np.int64) for x in column], type=pa.list_(pa.int64())) for column in (words, seeds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["item", "words", "seeds"])

    plain = items.select(F.col(key).alias("item"), text_column(text).alias("t"))
    kind = plain.schema["item"].dataType.simpleString()
    numbered = plain.mapInArrow(run, f"item {kind}, words array<long>, seeds array<long>")
    # equal texts under one id would be one item; the content tells repeated ids with other texts apart
    return numbered.withColumn("content", F.xxhash64("words"))


def stretches(docs: DataFrame, seeds: DataFrame, sizes: list[int]) -> DataFrame:
    """Documents (keys, text) that may hold tiles: keys, words (hashes of the stretches that may, 0 between stretches) and seeds.

    ``sizes`` are the lengths of seeds in words that the benchmark has: ``LEAST``, and lengths of shorter items.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(seeds, "seed"))
    keys = docs.schema["keys"].dataType.simpleString()

    def run(batches):
        known = _WordHashes()
        for batch in batches:
            rows, texts, seed_lists = [], [], []
            for some in groups_of(enumerate(batch.column(1).to_pylist()), lambda x: len(x[1]) // 4 + LEAST, 200_000):
                # the texts of a group lie in one array, LEAST zeros between them: windows with a zero are no seeds
                hashes = [word_hashes(t, known) for _, t in some]
                gap = np.zeros(LEAST, dtype=np.uint64)
                flat = np.concatenate([x for h in hashes for x in (h, gap)])
                ends = np.cumsum([len(h) + LEAST for h in hashes])
                zero = np.concatenate(([0], np.cumsum(flat == 0)))
                starts, lengths, found = [], [], []
                for size in sizes:
                    codes = window_hashes(flat, size)
                    hit = np.flatnonzero(bitmap.value.holds(codes)) if len(codes) else np.empty(0, np.int64)
                    hit = hit[zero[hit + size] == zero[hit]]
                    starts.append(hit), lengths.append(np.full(len(hit), size)), found.append(codes[hit])
                starts, lengths, found = (np.concatenate(x) for x in (starts, lengths, found))
                owner = np.searchsorted(ends, starts, side="right")
                for k in np.unique(owner).tolist():
                    mine = owner == k
                    of = np.repeat(starts[mine], lengths[mine])
                    covered = np.unique(of + np.arange(len(of)) - np.repeat(np.cumsum(lengths[mine]) - lengths[mine], lengths[mine]))
                    # a zero where the next word of a stretch isn't the next word of the text
                    breaks = np.flatnonzero(np.diff(covered) > 1) + 1
                    rows.append(some[k][0])
                    texts.append(np.insert(flat[covered], breaks, 0).view(np.int64))
                    seed_lists.append(np.unique(found[mine]).view(np.int64))
            if rows:
                lists = [pa.array(column, type=pa.list_(pa.int64())) for column in (texts, seed_lists)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *lists], names=["keys", "words", "seeds"])

    return docs.mapInArrow(run, f"keys {keys}, words array<long>, seeds array<long>")


def contaminated(
    docs: DataFrame, items: DataFrame, key_columns: list[str], text: str = "text", item_key: str = "item_id", item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """Key columns, item, coverage, n_tiles: one row per document and benchmark item whose tiles cover enough of the item."""
    bench = write_scratch(benchmark_words(items, item_key, item_text), "benchmark")
    seeds = write_scratch(bench.select("item", "content", F.explode("seeds").alias("seed")).groupBy("seed", "item", "content").count(), "seeds")
    # at most LEAST of them
    sizes = sorted(r[0] for r in bench.where("size(words) > 0").select(F.least(F.size("words"), F.lit(LEAST))).distinct().collect())
    if not sizes:
        seeds, sizes = seeds.limit(0), [LEAST]
    # the keys go through as one column, so that their names can't clash
    plain = docs.select(F.struct(*key_columns).alias("keys"), text_column(text).alias("text"))
    found = write_scratch(stretches(plain, seeds, sizes).withColumn("stretch", F.sha2(F.array_join("words", ","), 256)), "stretches")
    # the same stretches in many documents are looked at once
    distinct = found.groupBy("stretch").agg(F.any_value("words").alias("words"), F.any_value("seeds").alias("seeds"))
    pairs = (
        distinct.select("stretch", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("stretch", "item", "content")
        .agg(F.sum("count").alias("n_seeds"))
    )
    # each shared seed covers at most LEAST words of the item
    sizes = bench.select("item", "content", F.col("words").alias("item_words")).distinct()
    likely = (
        pairs.withColumnsRenamed({"item": "pair_item", "content": "pair_content"})
        .join(sizes, F.col("pair_item").eqNullSafe(F.col("item")) & (F.col("pair_content") == F.col("content")))
        .where(F.col("n_seeds") * LEAST >= F.size("item_words") * F.lit(coverage)).select("stretch", "item", "item_words")
    )
    tiled = likely.join(distinct.select("stretch", "words"), "stretch")
    kind = tiled.schema["item"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in ("item_words", "words")}
            shares, counts = [], []
            for a, b in zip(*(columns[c] for c in ("item_words", "words"))):
                item, words = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b))
                tiles = greedy_tiles(item, words, min(LEAST, len(item)))
                shares.append(sum(t[2] for t in tiles) / len(item)), counts.append(len(tiles))
            yield pa.RecordBatch.from_arrays(
                [batch.column("stretch"), batch.column("item"), pa.array(shares, type=pa.float64()), pa.array(counts, type=pa.int64())],
                names=["stretch", "item", "coverage", "n_tiles"],
            )

    scored = tiled.select("stretch", "item", "item_words", "words").mapInArrow(run, f"stretch string, item {kind}, coverage double, n_tiles long")
    hits = scored.where(F.col("coverage") >= coverage)
    return found.select("keys", "stretch").join(hits, "stretch").select("keys.*", F.col("item").alias(item_key), "coverage", "n_tiles")


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns. Texts stand or fall as a whole, copies alike."""
    (name,) = free_names([*docs.columns, *items.columns, "coverage", "n_tiles"], "digest")
    keyed = docs.withColumn(name, F.sha2(text_column(text), 256))
    bad = contaminated(keyed, items, [name], text).select(name).distinct()
    return keyed.join(bad, name, "left_anti").select(*docs.columns)
