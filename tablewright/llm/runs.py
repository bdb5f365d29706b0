"""Periodic runs of words, found online by catchers over completed blocks of a power of two of words.

A stretch of words that repeats with period d is a chain of squares (two equal neighbouring halves of d words). For d from l = 2**k to
2l - 1 each such stretch of at least 3d words holds a whole aligned block of l words that comes again d words later. So the words are cut into
aligned blocks of every power of two, and as soon as a block is complete a *catcher* waits for it to come again between l and 2l - 1
words further on. Every appended word completes one suffix of l words for each k, and exactly one catcher of each size waits at that distance,
so a word costs one comparison of names per size. A name is a 64-bit hash put together from the names of both halves.

A block that comes again is a square's part: neighbouring blocks caught at one distance are chained, the chain's ends are moved outwards
word by word through doubling steps (left through words that stand already, right as words are appended: a stretch that reaches the end of
the words so far stays open), and stretches of one period with the same begin are one. Blocks inside a stretch that a smaller size found are
not followed again; by the periodicity lemma they can only be multiples of its period. Of stretches with the same ends the smallest period counts.
Stretches are compared word by word before they are kept, so a collision of hashes can cost time but neither add nor lose a run.

Words of many texts are appended one after the other with a word of its own between two texts; texts go together by size class, so short
texts have no large blocks. Nothing is shuffled: a text is one row, and memory is bounded by the words of a portion or the longest text.

Edge cases: a NULL text has no words and no runs, like an empty one; a text that consists of one run keeps its first period; repeated
rows and rows with a NULL key give a row each; other columns are left out, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import groups_of, mix64, sliced

#: A run has at least this many words and at least this many periods.
LEAST, TIMES = 24, 3

#: Words appended together. A longer text is a portion of its own.
PORTION = 1 << 20


class Catchers:
    """All stretches of words with a period, for words appended in portions of any size.

    ``capacity`` is the number of words to come and ``longest`` the most words a stretch can have; ``bits`` narrows names in tests.
    """

    def __init__(self, capacity: int, longest: int, times: int = TIMES, bits: int = 64):
        if times < 3:
            raise ValueError("with fewer than three periods a stretch need not hold a whole aligned block")
        self.times, self.n = times, 0
        self.mask = np.uint64((1 << bits) - 1)
        self.words = np.empty(capacity, dtype=np.int64)
        sizes = max(1, (max(longest, 1) // times).bit_length())
        #: names[k][j] names the 2**k words from j on; named[k] of them are known
        self.names = [np.empty(capacity, dtype=np.uint64) for _ in range(sizes)]
        self.named = [0] * sizes
        #: begin, end, period of each stretch kept so far
        self.found = np.empty((0, 3), dtype=np.int64)

    def append(self, words: np.ndarray) -> None:
        """Take further words: complete their suffixes, go on with open stretches, and ask the catchers of every size."""
        before, self.n = self.n, self.n + len(words)
        self.words[before:self.n] = words
        for k in range(len(self.names)):
            self._name(k)
        is_open = self.found[:, 1] == before
        if is_open.any():
            begin, end, period = self.found[is_open].T
            longer = np.column_stack((begin, self._right(end - period, period) + period, period))
            self.found = self.found[~is_open]
            self._merge(longer)
        for k in range(len(self.names)):
            self._ask(k, before)

    def _name(self, k: int) -> None:
        lo, hi = self.named[k], max(self.named[k], self.n - (1 << k) + 1)
        if k == 0:
            self.names[0][lo:hi] = mix64(self.words[lo:hi] + 1) & self.mask
        else:
            half = 1 << (k - 1)
            with np.errstate(over="ignore"):
                both = self.names[k - 1][lo:hi] * np.uint64(0x9E3779B97F4A7C15) + self.names[k - 1][lo + half:hi + half]
            self.names[k][lo:hi] = mix64(both) & self.mask
        self.named[k] = hi

    def _right(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far the words from ``at`` on equal those ``period`` further: the first place that differs or has no partner yet."""
        at = at.copy()
        for k in range(len(self.names) - 1, -1, -1):
            step, moved = 1 << k, np.arange(len(at))
            while len(moved):
                p = at[moved]
                moved, p = moved[p + period[moved] + step <= self.n], p[p + period[moved] + step <= self.n]
                same = self.names[k][p] == self.names[k][p + period[moved]]
                moved = moved[same]
                at[moved] += step
                if k < len(self.names) - 1:  # below the largest step, one is enough
                    break
        return at

    def _left(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far back the words before ``at`` equal those ``period`` further."""
        at = at.copy()
        for k in range(len(self.names) - 1, -1, -1):
            step, moved = 1 << k, np.arange(len(at))
            while len(moved):
                moved = moved[at[moved] >= step]
                p = at[moved] - step
                same = self.names[k][p] == self.names[k][p + period[moved]]
                moved = moved[same]
                at[moved] -= step
                if k < len(self.names) - 1:
                    break
        return at

    def _ask(self, k: int, before: int) -> None:
        """Suffixes of 2**k words that the new words complete, each against the one catcher at its distance."""
        size = 1 << k
        lo, hi = max(size, before - size + 1), self.n - size + 1
        if hi <= lo:
            return
        j = np.arange(lo, hi)
        block = ((j >> k) - 1) << k
        names = self.names[k]
        caught = np.nonzero(names[lo:hi] == names[block])[0]
        if not len(caught):
            return
        j, block = j[caught], block[caught]
        smaller = self.found[self.found[:, 2] < size]
        if len(smaller):
            smaller = smaller[np.argsort(smaller[:, 0], kind="stable")]
            reach = np.maximum.accumulate(smaller[:, 1])
            at = np.searchsorted(smaller[:, 0], block, side="right") - 1
            new = (at < 0) | (reach[np.maximum(at, 0)] < j + size)
            j, block = j[new], block[new]
            if not len(j):
                return
        period = j - block
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        starts = np.ones(len(block), dtype=bool)
        starts[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + size)
        first = np.nonzero(starts)[0]
        last = np.append(first[1:], len(block)) - 1
        period = period[first]
        begin = self._left(block[first], period)
        end = self._right(block[last] + size, period) + period
        self._merge(np.column_stack((begin, end, period)))

    def _lasting(self, rows: np.ndarray) -> np.ndarray:
        """Of (begin, end, period): a stretch that is over and too short will not grow any more."""
        return rows[(rows[:, 1] - rows[:, 0] >= self.times * rows[:, 2]) | (rows[:, 1] == self.n)]

    def _merge(self, new: np.ndarray) -> None:
        """Keep stretches, compared word by word: where names collided, the stretches between words that differ."""
        exact = []
        for begin, end, period in self._lasting(new).tolist():
            differs = np.nonzero(self.words[begin:end - period] != self.words[begin + period:end])[0] + begin
            exact += zip([begin, *(differs + 1).tolist()], [*(differs + period).tolist(), end], [period] * (len(differs) + 1))
        every = np.concatenate((self.found, self._lasting(np.array(exact, dtype=np.int64).reshape(-1, 3))))
        every = every[np.lexsort((-every[:, 1], every[:, 0], every[:, 2]))]
        first = np.ones(len(every), dtype=bool)
        first[1:] = (every[1:, [0, 2]] != every[:-1, [0, 2]]).any(axis=1)
        self.found = every[first]

    def runs(self, least: int = LEAST) -> np.ndarray:
        """(begin, length, period) of all runs so far, by begin, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for begin, end, period in self.found.tolist():
            if end - begin >= max(least, self.times * period):
                smallest[begin, end] = min(period, smallest.get((begin, end), period))
        rows = sorted((begin, end - begin, period) for (begin, end), period in smallest.items())
        return np.array(rows, dtype=np.int64).reshape(-1, 3)


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """The runs of each list of words: arrays of (start, length, period)."""
    out = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    by_class: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= least:
            by_class.setdefault(len(words).bit_length(), []).append(i)
    for members in by_class.values():
        for some in groups_of(members, lambda i: len(texts[i]) + 1, PORTION):
            sizes = np.array([len(texts[i]) for i in some])
            flat = np.empty(sizes.sum(), dtype=object)
            flat[:] = [w for i in some for w in texts[i]]
            ids = pd.factorize(flat)[0].astype(np.int64)
            # a word of its own after each text: no stretch goes over it
            begins = np.cumsum(sizes + 1) - (sizes + 1)
            placed = np.empty(len(ids) + len(some), dtype=np.int64)
            ends = begins + sizes
            placed[ends] = len(ids) + np.arange(len(some))
            inside = np.ones(len(placed), dtype=bool)
            inside[ends] = False
            placed[inside] = ids
            catchers = Catchers(len(placed), int(sizes.max()), times)
            for at in range(0, len(placed), PORTION):
                catchers.append(placed[at:at + PORTION])
            found = catchers.runs(least)
            of = np.searchsorted(begins, found[:, 0], side="right") - 1
            found[:, 0] -= begins[of]
            cuts = np.searchsorted(of, np.arange(len(some) + 1))
            for at, i in enumerate(some):
                out[i] = found[cuts[at]:cuts[at + 1]]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words with each run cut to its first period, joined by one space."""
    if len(runs):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.nonzero(np.cumsum(change[:-1]) == 0)[0]
        words = [words[i] for i in kept.tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row of ``docs``: key, n_words, runs (array of start, length, period; by start, then period), collapsed (text).

    Words are the stretches of a text without blanks (space and the five ASCII line and tab characters).
    """
    kind = docs.schema[key].dataType.simpleString()
    shape = "array<struct<start:bigint,length:bigint,period:bigint>>"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 256):
            # bytes.split cuts at exactly these blanks
            texts = [(t or b"").split() for t in batch.column(1).to_pylist()]
            each = runs_of(texts, least, times)
            flat = np.concatenate([*each, np.empty((0, 3), dtype=np.int64)])
            cuts = np.cumsum([0, *map(len, each)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(
                pa.array(cuts), pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(t) for t in texts], type=pa.int64()), listed.cast(run_type),
                    pa.array([collapsed(t, r) for t, r in zip(texts, each)], type=pa.binary()),
                ],
                names=["k", "n_words", "runs", "collapsed"],
            )

    found = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t")).mapInArrow(
        find, f"k {kind}, n_words bigint, runs {shape}, collapsed binary"
    )
    return found.select(F.col("k").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs to one summary row each: how many, the one repeated most often, digests of all runs and of the collapsed text."""
    # of equally repeated runs the first stays: the array is in order of start, then period
    most = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("most", most).select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("most.start").alias("start"),
        F.col("most.length").alias("length"),
        F.col("most.period").alias("period"),
        F.expr("most.length * 1000 div most.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
