"""Language-model scores with stupid backoff, as joins of count tables.

A word w after v scores c(vw) / c(v) where other texts have that pair, else ``backoff`` * c(w) / n. Counts are over the whole table; what
the text itself has of the pair is taken out of all three, so that no text is scored by its own pairs. A text's score is the mean
natural logarithm over its words; its first word follows a start symbol.

The vocabulary is open: every word has its own counts. The ``NAMED`` most frequent words have short ids and a count table of fixed size that goes to
every task; all other words are told by 63 bits of hash. Texts are coded in groups of about ``GROUP`` words, a row each, and pair counts travel packed,
a row per group and partition of pairs. Of pairs of two named words a group sends each partition its distinct pairs and how often it has them. A pair with
a rare word goes to the partition of that word (the second one, if both are rare), where the word's own count is known too: a rare word is sent once
by a group, followed by what stands beside it. The partition adds them up and sends the sums back in the same order, so a pair costs a few bytes
and its text is scored where it lies. Pairs of two of the ``frequent`` most frequent words, which most texts have, would make hot
partitions; they are counted on the map side and are few by their number of words. A pair with a rarer word is at most as frequent as that.
With a number as ``vocabulary`` only so many words keep their name and all others are one symbol.

Edge cases: NULL and empty texts have no words, n_words 0 and a NULL score; a text whose words no other text has is scored by
backed-off counts of at least one; rows with a NULL doc_id are scored; repeated rows each give their row and count as other texts
of each other; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import groups_of, mix64, text_column, write_scratch
from tablewright.llm.decontam import word_hashes

#: Stupid backoff's factor, and how many words keep their name (None: all).
BACKOFF, VOCABULARY = 0.4, None
#: Words with a short id, whose counts go to every task.
NAMED = 65_534
#: Words whose pairs with each other are counted on the map side.
FREQUENT = 512
#: Words of the texts that are coded together, and of pairs that one partition of pairs adds up.
GROUP, PART = 200_000, 1_000_000
#: Logarithms are summed in units of 1 / SCALE.
SCALE = 1 << 24
#: Ids of the start of a text and of a word without a short id; named words follow.
START, OTHER = 0, 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class _Ids(dict):
    """Ids of words, remembered up to a bound: short ones, or OTHER or the hash with its first bit set for rare words."""

    def __init__(self, vocabulary: dict[int, int], open_ended: bool):
        super().__init__()
        self.vocabulary, self.open_ended = vocabulary, open_ended

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        code = xxhash.xxh64_intdigest(word)
        value = self[word] = self.vocabulary.get(code, code | 1 << 63 if self.open_ended else OTHER)
        return value


def word_counts(texts: DataFrame) -> DataFrame:
    """(text) to (word, n): how often each word, as a hash, occurs in the table."""

    def run(batches):
        known = _Hashes()
        for batch in batches:
            for some in groups_of(batch.column(0).to_pylist(), lambda t: len(t) // 4 + 1, 1_000_000):
                words, n = np.unique(np.concatenate([word_hashes(t, known) for t in some]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def coded_texts(texts: DataFrame, vocabulary: dict[int, int], open_ended: bool) -> DataFrame:
    """(k, row, text) to one row per group of texts: g (the first row's number), ks, sizes in words, ids (two bytes a word), rare (eight bytes a rare word, in order).

    Rows of a group are numbered one after the other.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    kind = texts.schema["k"].dataType.simpleString()

    def run(batches):
        known = _Ids(shared.value, open_ended)
        for batch in batches:
            rows = batch.column(1).to_numpy()
            for some in groups_of(enumerate(batch.column(2).to_pylist()), lambda x: len(x[1]) // 4 + 1, GROUP):
                codes = [word_hashes(t, known) for _, t in some]
                flat = np.concatenate(codes)
                long = flat >= np.uint64(1 << 63)
                first = some[0][0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(rows[first])]), pa.array([batch.column(0).slice(first, len(some)).to_pylist()], type=pa.list_(batch.schema.field(0).type)),
                        pa.array([[len(c) for c in codes]], type=pa.list_(pa.int64())),
                        pa.array([np.where(long, np.uint64(OTHER), flat).astype("<u2").tobytes()], type=pa.binary()), pa.array([flat[long].astype("<u8").tobytes()], type=pa.binary()),
                    ],
                    names=["g", "ks", "sizes", "ids", "rare"],
                )

    return texts.select("k", "row", "text").mapInArrow(run, f"g long, ks array<{kind}>, sizes array<long>, ids binary, rare binary")


def _group_pairs(sizes: np.ndarray, ids: bytes, rare: bytes):
    """Distinct pairs of each text of a group: (text, v, w, n, names), sorted by text. From NAMED + 2 on a word's number is its place in ``names``, the group's rare words."""
    w = np.frombuffer(ids, dtype="<u2").astype(np.int64)
    names, place = np.unique(np.frombuffer(rare, dtype="<i8"), return_inverse=True)
    if len(names):
        w[w == OTHER] = NAMED + 2 + place
    of = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    v = np.concatenate(([START], w[:-1])) if len(w) else w
    v[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
    # pairs are numbered too, which makes one sortable number of (text, v, w) for any number of words
    pair, place = np.unique(v * (NAMED + 2 + len(names)) + w, return_inverse=True)
    code, n = np.unique(of * len(pair) + place, return_counts=True)
    many = max(1, len(pair))
    v, w = np.divmod(pair[code % many], NAMED + 2 + len(names))
    return code // many, v, w, n, names


def _groups(batches):
    """(row of the batch, pairs) of each group."""
    for batch in batches:
        at = [batch.schema.get_field_index(c) for c in ("sizes", "ids", "rare")]
        for i in range(batch.num_rows):
            yield batch, i, _group_pairs(batch.column(at[0])[i].values.to_numpy(), *(batch.column(c)[i].as_py() for c in at[1:]))


def _is_frequent(v: np.ndarray, w: np.ndarray, frequent: int) -> np.ndarray:
    return (v < frequent + 2) & (w < frequent + 2) & (v != OTHER) & (w != OTHER)


def _added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, the place of each code among them, and their sums of ``n``."""
    known, place = np.unique(codes, return_inverse=True)
    return known, place, np.bincount(place, weights=n, minlength=len(known)).astype(np.int64)


def _by_part(codes: np.ndarray, place: np.ndarray, sums: np.ndarray, part: np.ndarray):
    """Codes in the order of (part, code): codes, part of each, place of each pair, sums."""
    turn = np.argsort(part, kind="stable")
    back = np.empty(len(turn), dtype=np.int64)
    back[turn] = np.arange(len(turn))
    return codes[turn], part[turn], back[place], sums[turn]


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(parts)).astype(np.int64)


def _named_pairs(v: np.ndarray, w: np.ndarray, n: np.ndarray, frequent: int, parts: int):
    """Which pairs are of two named words that are not both frequent, and their codes by part."""
    both = (v < NAMED + 2) & (w < NAMED + 2) & ~_is_frequent(v, w, frequent)
    codes, place, sums = _added(v[both] << 16 | w[both], n[both])
    return both, *_by_part(codes, place, sums, _part_of(codes, parts))


def _rare_pairs(v: np.ndarray, w: np.ndarray, n: np.ndarray, names: np.ndarray, parts: int):
    """Which pairs have a rare word, and their codes (its place in ``names``, whether it comes second, the other word's number) by the part of that word."""
    second = w >= NAMED + 2
    some = second | (v >= NAMED + 2)
    v, w, second = v[some], w[some], second[some].astype(np.int64)
    word, other = np.where(second, w, v) - NAMED - 2, np.where(second, v, w)
    codes, place, sums = _added((word * 2 + second) * (NAMED + 2 + len(names)) + other, n[some])
    return some, *_by_part(codes, place, sums, _part_of(names, parts)[codes // (NAMED + 2 + len(names)) // 2])


def _rare_columns(codes: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    """Rare words, how many pairs each has, whether it comes second in them, the other words' ids, and the hashes of those that are rare."""
    side, other = np.divmod(codes, NAMED + 2 + len(names))
    words, many = np.unique(side // 2, return_counts=True)
    long = other >= NAMED + 2
    return [names[words], many, side % 2, np.where(long, OTHER, other), names[other[long] - NAMED - 2]]


def _word_counts(named: np.ndarray, names: np.ndarray, counts: np.ndarray, parts: int) -> np.ndarray:
    """Counts by a word's number in the group, from those of named words and those that the parts sent for ``names``."""
    c = np.zeros(NAMED + 2 + len(names), dtype=np.int64)
    c[: len(named)] = named
    c[NAMED + 2 + np.argsort(_part_of(names, parts), kind="stable")] = counts
    return c


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers as bytes, each in the narrowest type that holds it."""
    narrow = [c.view(np.uint64).astype(np.min_scalar_type(c.view(np.uint64).max()) if len(c) else np.uint8) for c in columns]
    head = np.array([len(c) << 4 | c.itemsize for c in narrow], dtype=np.uint64)
    return head.tobytes() + b"".join(c.tobytes() for c in narrow)


def _unpack(packed: bytes, columns: int) -> list[np.ndarray]:
    found, at = [], 8 * columns
    for head in np.frombuffer(packed, dtype=np.uint64, count=columns).tolist():
        n, size = divmod(head, 16)
        found.append(np.frombuffer(packed, dtype=f"u{size}", count=n, offset=at).astype(np.uint64).view(np.int64))
        at += n * size
    return found


def frequent_pairs(coded: DataFrame, frequent: int) -> dict[int, int]:
    """Counts over the whole table of the pairs of two frequent words: at most (frequent + 2)**2 of them."""

    def run(batches):
        held = np.zeros((frequent + 2) ** 2, dtype=np.int64)
        for _, _, (_, v, w, n, _) in _groups(batches):
            both = _is_frequent(v, w, frequent)
            np.add.at(held, v[both] * (frequent + 2) + w[both], n[both])
        at = np.flatnonzero(held)
        pair = at // (frequent + 2) << 16 | at % (frequent + 2)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(held[at])], names=["pair", "n"])

    rows = coded.select("sizes", "ids", "rare").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {r["pair"]: r["n"] for r in rows}


def packed_counts(coded: DataFrame, frequent: int, parts: int) -> DataFrame:
    """(g, counts): for each group, part by part, the counts over the whole table of its pairs of named words, of its rare words, and of their pairs, in the order the group sent them."""

    def send(batches):
        for batch, i, (_, v, w, n, names) in _groups(batches):
            _, codes, part, _, sums = _named_pairs(v, w, n, frequent, parts)
            _, rare, rare_part, _, rare_sums = _rare_pairs(v, w, n, names, parts)
            to = np.union1d(part, rare_part)
            if not len(to):
                continue
            spans = [zip(np.searchsorted(p, to).tolist(), np.searchsorted(p, to, "right").tolist()) for p in (part, rare_part)]
            sent = [_pack(codes[a:b], sums[a:b], *_rare_columns(rare[c:d], names), rare_sums[c:d]) for (a, b), (c, d) in zip(*spans)]
            g = batch.column(batch.schema.get_field_index("g"))[i].as_py()
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(to)), pa.array(to), pa.array(sent, type=pa.binary())], names=["g", "part", "sent"])

    def add_up(rows):
        messages = [_unpack(m, 8) for m in rows["sent"]]
        codes, n, words, many, second, other, others, rare_n = map(np.concatenate, zip(*messages))
        _, place, sums = _added(codes, n)
        names, word = np.unique(words, return_inverse=True)
        word = np.repeat(word, many)
        other[other == OTHER] = others
        known, other = np.unique(other, return_inverse=True)
        _, rare_place, rare_sums = _added((word * 2 + second) * len(known) + other, rare_n)
        # every place of a word is the second of one pair
        own = np.bincount(word, weights=rare_n * second, minlength=len(names)).astype(np.int64)
        answers = []
        for whole, which in ((sums[place], 0), (own[np.searchsorted(names, words)], 2), (rare_sums[rare_place], 7)):
            answers.append(np.split(whole, np.cumsum([len(m[which]) for m in messages])[:-1]))
        rows["n"] = [_pack(*a) for a in zip(*answers)]
        return rows[["g", "part", "n"]]

    sent = coded.select("g", "sizes", "ids", "rare").mapInArrow(send, "g long, part long, sent binary")
    # a task for each part, so that its share stays the same when the table grows
    counted = sent.repartition(parts, "part").groupBy("part").applyInPandas(add_up, "g long, part long, n binary")
    return counted.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("counts"))


def text_sums(coded: DataFrame, words: np.ndarray, pairs: dict[int, int], frequent: int, parts: int, backoff: float, total: int) -> DataFrame:
    """Groups with their counts to (k, n_words, s): the sum of the logarithms of each text's pairs."""
    codes = np.array(sorted(pairs), dtype=np.int64)
    tables = coded.sparkSession.sparkContext.broadcast((words, codes, np.array([pairs[p] for p in codes.tolist()], dtype=np.int64)))
    kind = coded.schema["ks"].dataType.elementType.simpleString()

    def run(batches):
        named, codes, counts = tables.value
        for batch, i, (at, v, w, n, names) in _groups(batches):
            ks, sizes, sent = (batch.column(batch.schema.get_field_index(c))[i] for c in ("ks", "sizes", "counts"))
            none = np.empty(0, dtype=np.int64)
            c_named, c_names, c_rare = (np.concatenate([none, *x]) for x in zip(*([none] * 3, *(_unpack(x["n"], 3) for x in sent.as_py() or []))))
            both = _is_frequent(v, w, frequent)
            packed, own, _, place, _ = _named_pairs(v, w, n, frequent, parts)
            some, rare, _, rare_place, _ = _rare_pairs(v, w, n, names, parts)
            if (len(c_named), len(c_names), len(c_rare)) != (len(own), len(names), len(rare)):
                raise ValueError("counts do not fit their group")
            c_vw = np.zeros(len(v), dtype=np.int64)
            c_vw[both] = counts[np.searchsorted(codes, v[both] << 16 | w[both])]
            c_vw[packed], c_vw[some] = c_named[place], c_rare[rare_place]
            c = _word_counts(named, names, c_names, parts)
            logs = np.rint(SCALE * n * log_score(c_vw, c[v], c[w], n, backoff, total))
            sums = np.bincount(at, weights=logs, minlength=len(sizes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ks.values, sizes.values, pa.array(sums)], names=["k", "n_words", "s"])

    return coded.select("ks", "sizes", "ids", "rare", "counts").mapInArrow(run, f"k {kind}, n_words long, s long")


def log_score(c_vw, c_v, c_w, n, backoff: float, total: int) -> np.ndarray:
    """Logarithm of the score of a pair of which the text itself has ``n``; those are taken out of all its counts."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(c_vw > n, np.log((c_vw - n) / (c_v - n)), np.log(backoff * np.maximum(c_w - n, 1) / total))


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", backoff: float = BACKOFF, vocabulary: int | None = VOCABULARY, frequent: int = FREQUENT
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, score."""
    if vocabulary is not None and vocabulary > NAMED:
        raise ValueError(f"a closed vocabulary has at most {NAMED} words")
    frequent = min(frequent, NAMED)
    texts = docs.select(F.col(key).alias("k"), text_column(text).alias("text"))
    counts = write_scratch(word_counts(texts), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(NAMED if vocabulary is None else vocabulary).collect()
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    # rows are numbered in the job that writes them, so that every later job sees the same numbers
    named = {r["word"] & (2**64 - 1): i + 2 for i, r in enumerate(top)}
    coded = write_scratch(coded_texts(texts.withColumn("row", F.monotonically_increasing_id()), named, vocabulary is None), "coded-texts")
    starts = coded.agg(F.sum(F.size(F.filter("sizes", lambda n: n > 0)))).first()[0] or 0
    sums = [starts, total - sum(r["n"] for r in top), *(r["n"] for r in top)]
    parts = max(1, -(-total // PART))
    known = coded.join(packed_counts(coded, frequent, parts), "g", "left")
    scores = text_sums(known, np.array(sums, dtype=np.int64), frequent_pairs(coded, frequent), frequent, parts, backoff, total)
    mean = F.col("s") / (F.lit(float(SCALE)) * F.col("n_words"))
    return scores.select(F.col("k").alias(key), "n_words", F.when(F.col("n_words") > 0, F.round(mean, 6)).alias("score"))
