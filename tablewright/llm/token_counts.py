"""Token counts by rank-synchronous array merging.

Texts fall into pre-tokens that no vocabulary entry spans. The pre-tokens a task has not met before are held as ragged
arrays of symbols and merged together (`merging`); a text's count is the sum over its pre-tokens. A task's table of known
pre-tokens is bounded and begun anew when full, so memory doesn't grow with the input.

Edge cases: NULL text counts as empty; an empty text has 0 bytes and 0 tokens; texts of any length are counted whole
(a pre-token of any length is merged exactly); repeated rows each give their row; extra columns are ignored by
`count_tokens`, which returns only the key and the figures; a table without rows gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import groups_of, text_column
from tablewright.llm.merging import PairTable, merge_all

#: The sign that stands for a space inside the vocabulary, and the score floor of entries that were never trained.
SPACE = "▁"
#: Pre-tokens a task remembers at most, and pre-tokens looked at together.
KNOWN, TOGETHER = 300_000, 200_000


class PieceModel:
    """What counting needs of a piece vocabulary: symbols, pairs and what a symbol costs in tokens."""

    def __init__(self, pieces: list[str], scores: list[float]):
        singles = {c for p in pieces for c in p}
        self.symbols = {s: i for i, s in enumerate(dict.fromkeys([*pieces, *sorted(singles)]))}
        known, n = set(pieces), len(self.symbols)
        order = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        rank = {p: order[s] for p, s in zip(pieces, scores)}
        left, right, ranks, product = [], [], [], []
        for p in pieces:
            for cut in range(1, len(p)):
                a, b = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), ranks.append(rank[p]), product.append(self.symbols[p])
        # letters outside the vocabulary: one symbol for each length in bytes, which is their cost
        points = np.arange(0x110000)
        self.point_symbol = (n + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int32)
        for c in singles:
            self.point_symbol[ord(c)] = self.symbols[c]
        self.cost = np.array([1 if s in known else len(s.encode()) for s in self.symbols] + [1, 2, 3, 4], dtype=np.int64)
        self.pairs = PairTable(left, right, ranks, product, n + 4)
        spaced = [p for p in pieces if re.search(f"[^{SPACE}]{SPACE}", p)]
        if spaced:
            raise ValueError(f"entries span a space, so words can't be counted apart: {spaced[:3]}")
        alone = "" if any("\n" in p for p in pieces if len(p) > 1) else "\n"
        self.pattern = f"{alone}+|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+"

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        ]
        return cls([sp.id_to_piece(i) for i in plain], [sp.get_score(i) for i in plain])

    def symbols_of(self, text: str) -> np.ndarray:
        """One symbol per code point."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return self.point_symbol[np.minimum(points, len(self.point_symbol) - 1)] if len(points) else np.empty(0, np.int32)


def _counter(model: PieceModel):
    find = re.compile(model.pattern).findall
    known: dict[str, int] = {}

    def words(text: str) -> list[str]:
        return find(SPACE + text.replace(" ", SPACE)) if text else []

    def count(texts: list[str]) -> list[int]:
        nonlocal known
        out = []
        for some in groups_of(texts, lambda t: len(t) // 4 + 1, TOGETHER):
            split = [words(t) for t in some]
            new = list(set().union(*split).difference(known))
            if new:
                if len(known) + len(new) > KNOWN:
                    known = {}
                    new = list(set().union(*split))
                sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
                merged, lengths = merge_all(model.symbols_of("".join(new)), sizes, model.pairs)
                sums = np.add.reduceat(model.cost[merged], np.cumsum(lengths) - lengths)
                known.update(zip(new, sums.tolist()))
            out += [sum(map(known.__getitem__, w)) for w in split]
        return out

    return count


def count_tokens(docs: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        count = _counter(shared.value)
        for batch in batches:
            texts = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count(texts.to_pylist()), type=pa.int64()), batch.column(2)],
                names=["k", "n_tokens", "n_bytes"],
            )

    plain = docs.select(F.col(key).alias("k"), text_column(text).alias("t"), F.octet_length(text_column(text)).cast("long").alias("b"))
    kind = plain.schema["k"].dataType.simpleString()
    counted = plain.mapInArrow(run, f"k {kind}, n_tokens long, n_bytes long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
