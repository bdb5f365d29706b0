"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the table without a look at their labels are the unlabelled
set. With the class prior p the risk of a classifier g is

    p * mean over positives of loss(g, +1) + max(0, mean over unlabelled of loss(g, -1) - p * mean over positives of loss(g, -1))

The part in max(...) estimates the risk on the negatives; where it falls below zero the model has begun to fit noise, and the
step goes back along that part instead (logistic loss, Adam, numpy). Features are which words, beginnings and ends of words of
a bounded vocabulary occur in a whole text. Some members with their own start are trained and their mean taken.

What is bounded, and how: at most ``positives`` toxic texts (smallest hashes first), about ``unlabelled`` texts (all below a hash
threshold), and ``vocabulary`` features (those most out of proportion among the positives). Everything else covers all rows: the
prior is the share of toxic rows among all labelled rows of the training fold, and every document is scored by its whole text.

Edge cases: NULL and empty texts get the score of a text without any known word; rows with a NULL doc_id are scored, held_out is
false; labels that are NULL don't count, of repeated labels the highest counts; repeated rows each give their row; no toxic
label at all gives score 0 everywhere; extra columns are left out; a table without rows gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import text_column

WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    positives: int = 4_000
    unlabelled: int = 8_000
    vocabulary: int = 4_096
    least_texts: int = 4
    least_share: float = 0.02
    least_gain: float = 12.0
    members: int = 3
    steps: int = 300
    rate: float = 0.05
    #: pull of the weights to zero: 1 / positives, as a prior of fixed weight has, and at most this
    decay: float = 3e-3
    folds: int = 5


def parts_of(word: str) -> list[str]:
    """Features of a word: itself, its beginnings and its ends."""
    n = len(word)
    return [f"={word}", *(f"^{word[:k]}" for k in range(3, min(7, n) + 1)), *(f"{word[-k:]}$" for k in range(4, min(6, n) + 1))]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -np.inf

    def __post_init__(self):
        self.names = sorted(self.weights)
        self.values = np.array([self.weights[n] for n in self.names])
        self.place = {n: i for i, n in enumerate(self.names)}
        self.known: dict[str, tuple[int, ...]] = {}

    def features(self, text: str) -> list[int]:
        """Places of the model's features that occur in a text, ascending."""
        if len(self.known) > 100_000:
            self.known.clear()
        found: set[int] = set()
        known = self.known
        for word in set(WORDS.findall(text.lower())):
            at = known.get(word)
            if at is None:
                at = known[word] = tuple(self.place[p] for p in parts_of(word) if p in self.place)
            if at:
                found.update(at)
        return sorted(found)

    def score(self, text: str) -> float:
        if self.bias == -np.inf:
            return 0.0
        at = self.features(text)
        total = self.bias + (float(self.values[at].sum()) if at else 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fold(key: str, folds: int):
    """crc32 of the key as text, modulo the number of folds."""
    return F.crc32(F.col(key).cast("string")) % folds


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(kind, id, text) to (feature, p, u): in how many positive and unlabelled texts each feature occurs, counted per batch."""

    def run(batches):
        for batch in batches:
            counts = Counter(), Counter()
            for kind, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                counts[kind].update({p for w in set(WORDS.findall(text.lower())) for p in parts_of(w)})
            names = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array([c[n] for n in names], type=pa.int64()) for c in (counts[1], counts[0])]
            yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), *columns], names=["feature", "p", "u"])

    partial = sample.mapInArrow(run, "feature string, p long, u long")
    return partial.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _train(rows: list[np.ndarray], kinds: np.ndarray, n_words: int, prior: float, s: Settings, seed: int) -> tuple[np.ndarray, float]:
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.empty(0, dtype=np.int64)
    of = np.repeat(np.arange(len(rows)), lengths)
    is_p = kinds == 1
    n_p, n_u = max(1, is_p.sum()), max(1, (~is_p).sum())
    rng = np.random.default_rng(seed)
    decay = min(s.decay, 1 / n_p)
    w, b = rng.normal(0, 0.01, n_words), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for step in range(1, s.steps + 1):
        g = np.bincount(of, weights=w[flat], minlength=len(rows)) + b
        sig = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
        soft = np.logaddexp(0, g)
        negative = soft[~is_p].sum() / n_u - prior * soft[is_p].sum() / n_p
        # derivatives by g: of the positives' own loss, and of the estimated risk on the negatives
        towards = np.where(is_p, -prior * (1 - sig) / n_p, 0.0)
        back = np.where(is_p, -prior * sig / n_p, sig / n_u)
        d = towards + back if negative >= 0 else -back
        grad = np.append(np.bincount(flat, weights=d[of], minlength=n_words) + decay * w, d.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", settings: Settings = Settings()) -> Model:
    """A model from the labels of the training folds (fold 0 is never looked at) and unlabelled texts of ``docs``."""
    s = settings
    known = (
        labels.where((fold(key, s.folds) != 0) & F.col(label).isNotNull()).groupBy(F.col(key).alias("id"))
        .agg(F.max(label).alias("label"))
    )
    rates = known.agg(F.count("*").alias("n"), F.sum("label").alias("n_toxic")).first()
    if not rates["n_toxic"]:
        return Model()
    prior = min(0.9, max(1e-3, rates["n_toxic"] / rates["n"]))
    plain = docs.select(F.col(key).alias("id"), text_column(text).alias("text"))
    chosen = known.where("label = 1").select("id").orderBy(F.xxhash64("id"), "id").limit(s.positives)
    # at most ``positives`` ids, so the broadcast is bounded
    toxic = plain.join(F.broadcast(chosen), "id").select(F.lit(1).alias("kind"), F.col("id").cast("string").alias("id"), "text")
    n = max(1, docs.count())
    share = min(1.0, s.unlabelled / n)
    drawn = plain.where(F.pmod(F.xxhash64("id", F.lit("unlabelled")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    # the samples are bounded; they are kept so that the texts are fetched once
    sample = toxic.unionByName(drawn.select(F.lit(0).alias("kind"), F.col("id").cast("string").alias("id"), "text"))
    sample = sample.repartition(32).persist()
    try:
        sizes = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
        n_p, n_u = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
        # how much more often than among the unlabelled texts, as a log-likelihood gain over that rate
        due = (F.col("u") + 0.5) * F.lit(n_p / (n_u + 1))
        gain = F.col("p") * F.log(F.col("p") / due) - (F.col("p") - due)
        picked = (
            _feature_counts(sample).where((F.col("p") >= max(s.least_texts, s.least_share * n_p)) & (F.col("p") > due))
            .withColumn("gain", F.round(gain, 6)).where(F.col("gain") >= s.least_gain)
            .orderBy(F.desc("gain"), "feature").limit(s.vocabulary).collect()
        )
        words = sorted(r["feature"] for r in picked)
        blank = sample.sparkSession.sparkContext.broadcast(Model(dict.fromkeys(words, 0.0)))

        @F.pandas_udf("array<int>")
        def features(texts):
            return texts.map(blank.value.features)

        rows = sample.select("kind", "id", features("text").alias("at")).orderBy("kind", "id", "at").collect()
    finally:
        sample.unpersist()
    kinds = np.array([r["kind"] for r in rows])
    features = [np.array(r["at"], dtype=np.int64) for r in rows]
    trained = [_train(features, kinds, len(words), prior, s, seed) for seed in range(s.members)] if words else []
    if not trained:
        return Model({}, float(np.log(prior / (1 - prior))))
    weights = np.mean([w for w, _ in trained], axis=0)
    return Model(dict(zip(words, weights.tolist())), float(np.mean([b for _, b in trained])))


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(F.col(key).alias("k"), text_column(text).alias("t"))
    kind = plain.schema["k"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, type=pa.float64())], names=["k", "score"])

    scored = plain.mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)
    return scored.select(
        key, F.coalesce(fold(key, folds) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        return texts.map(lambda t: shared.value.score(t) < 0.5).astype(bool)

    return docs.where(clean(text_column(text)))
