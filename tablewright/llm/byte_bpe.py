"""Byte-level BPE encoding and decoding with overlapping chunks.

Short texts are pre-tokenised in one piece. A long text is cut into chunks, each a row of its own that any executor can
take; a chunk reads on into its successor. Two neighbours agree on pre-tokens from the first boundary both have in their common
stretch (a pre-token depends only on where it starts), so the successor's part begins there. Where two chunks have
no common boundary (one pre-token spans the whole stretch), that text is pre-tokenised in one piece. Pre-tokens are then merged
(`merging`) and the ids put together in order. Decoding joins the bytes of the ids.

Edge cases: NULL text counts as empty (0 tokens, digests of nothing); repeated rows each give their row, long texts
that repeat are encoded once; extra columns of the input are left out; a table without rows gives no rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import groups_of, sliced, text_column
from tablewright.llm.merging import PairTable, merge_all

#: Texts above CHUNK code points are cut; neighbours share OVERLAP code points.
CHUNK, OVERLAP = 65_536, 2_048
KNOWN, TOGETHER = 200_000, 200_000


class RankModel:
    """A rank file as arrays: bytes of each id, start symbol of each byte, pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        left, right, product = [], [], []
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), product.append(rank)
        self.start = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.whole = ranks
        self.pairs = PairTable(left, right, product, product, len(self.bytes_of))

    @classmethod
    def from_file(cls, path: str, pattern: str) -> RankModel:
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            return cls({base64.b64decode(a): int(b) for a, b in lines}, pattern)


class Encoder:
    """Encodes within a task; remembers a bounded number of pre-tokens."""

    def __init__(self, model: RankModel):
        import regex

        self.model, self.split = model, regex.compile(model.pattern)
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > KNOWN:
            self.known = {}
            new = words
        todo, raws = [], []
        for w in new:
            raw = w.encode("utf-8", "surrogatepass")
            # a pre-token that is itself an entry is that entry
            if (rank := self.model.whole.get(raw)) is not None:
                self.known[w] = rank.to_bytes(4, "little")
            else:
                todo.append(w), raws.append(raw)
        if not todo:
            return
        start = self.model.start[np.frombuffer(b"".join(raws), dtype=np.uint8)]
        ids, lengths = merge_all(start, np.fromiter(map(len, raws), dtype=np.int64, count=len(raws)), self.model.pairs)
        raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(lengths) * 4).tolist()
        for w, begin, end in zip(todo, [0, *ends], ends):
            self.known[w] = raw[begin:end]

    def encode(self, texts: list[str]):
        """The ids of each text as little-endian bytes."""
        for some in groups_of(texts, lambda t: len(t) // 4 + 1, TOGETHER):
            split = [self.split.findall(t) for t in some]
            self.learn(set().union(*split))
            get = self.known.__getitem__
            for words in split:
                yield b"".join(map(get, words))

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.split.finditer(text)] + [len(text)]


def decode(ids: bytes, model: RankModel) -> bytes:
    return b"".join(map(model.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def common_start(mine: list[int], theirs: list[int]) -> int | None:
    """First place that is a boundary on both sides; both lists ascend and cover the same stretch."""
    both = set(mine).intersection(theirs)
    return min(both) if both else None


def chunk_rows(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, text) to one row per chunk: key, no, at (start), piece (the chunk with what it reads on). A text is gone through once."""

    def run(batches):
        for batch in sliced(batches, 16):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts = range(0, max(1, len(text)), chunk)
                for some in groups_of(enumerate(starts), lambda _: 1, 64):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(some), type=pa.string()),
                            pa.array([no for no, _ in some], type=pa.int32()),
                            pa.array([at for _, at in some], type=pa.int32()),
                            pa.array([text[at:at + chunk + overlap] for _, at in some], type=pa.string()),
                        ],
                        names=["key", "no", "at", "piece"],
                    )

    return texts.select("key", "text").mapInArrow(run, "key string, no int, at int, piece string")


def encode_long(texts: DataFrame, model: RankModel, chunk: int, overlap: int) -> DataFrame:
    """(key, text) of distinct long texts to (key, ids)."""
    if overlap >= chunk:
        raise ValueError("overlap must be below chunk")
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def edges(batches):
        """Boundaries in the stretch a chunk shares with its predecessor (head) and with its successor (tail)."""
        encoder = Encoder(shared.value)
        for batch in sliced(batches):
            head, tail = [], []
            for no, at, piece in zip(*(batch.column(c).to_pylist() for c in ("no", "at", "piece"))):
                found = encoder.boundaries(piece)
                # the end of a piece is no boundary of the text, and what stands before it may depend on what follows
                sure = [b for b in found if b <= len(piece) - 2]
                head.append([at + b for b in sure if b < overlap] if no else [])
                tail.append([at + b for b in sure if chunk <= b])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(head, type=pa.list_(pa.int32())), pa.array(tail, type=pa.list_(pa.int32()))],
                names=[*batch.schema.names, "head", "tail"],
            )

    # a repartition spreads the chunks of one text over the executors
    pieces = chunk_rows(texts, chunk, overlap).repartition("key", "no")
    known = pieces.mapInArrow(edges, "key string, no int, at int, piece string, head array<int>, tail array<int>")
    in_order = Window.partitionBy("key").orderBy("no")

    def stitch(tails, heads):
        return F.array_min(F.array_intersect(tails, heads))

    # places only; the pieces themselves don't go through this window
    marks = (
        known.select("key", "no", "at", "head", "tail")
        .withColumn("from", F.when(F.col("no") == 0, F.lit(0)).otherwise(stitch(F.lag("tail").over(in_order), F.col("head"))))
        .withColumn("last", F.lead("no").over(in_order).isNull())
        .withColumn("to", F.lead("from").over(in_order))
        .select("key", "no", "from", "to", "last")
    )
    # a text of which two neighbours share no boundary is done in one piece
    whole = marks.where(F.col("from").isNull()).select("key").distinct()
    cut = marks.join(whole, "key", "left_anti").join(pieces.select("key", "no", "at", "piece"), ["key", "no"])
    part = F.when(F.col("last"), F.substring("piece", F.col("from") - F.col("at") + 1, F.lit(chunk + overlap))).otherwise(
        F.substring("piece", F.col("from") - F.col("at") + 1, F.col("to") - F.col("from"))
    )
    rows = cut.select("key", "no", part.alias("text")).unionByName(
        texts.join(whole, "key", "left_semi").select("key", F.lit(0).alias("no"), "text")
    )

    def encode(batches):
        encoder = Encoder(shared.value)
        for batch in sliced(batches):
            ids = list(encoder.encode(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, type=pa.binary())], names=["key", "no", "ids"])

    # a row holds all ids of one text, as its text was one row
    pieces_of = F.sort_array(F.collect_list(F.struct("no", "ids")))
    return (
        rows.mapInArrow(encode, "key string, no int, ids binary").groupBy("key").agg(pieces_of.alias("parts"))
        .select("key", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
    )


def _as_ids(column, ids: list[bytes], _model) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([column, pa.array(ids, type=pa.binary())], names=["k", "ids"])


def _as_digests(column, ids: list[bytes], model: RankModel) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            column,
            pa.array([len(raw) // 4 for raw in ids], type=pa.int64()),
            pa.array([hashlib.sha256(raw).hexdigest() for raw in ids], type=pa.string()),
            pa.array([hashlib.sha256(decode(raw, model)).hexdigest() for raw in ids], type=pa.string()),
        ],
        names=["k", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def _encoded(docs: DataFrame, model: RankModel, key: str, text: str, chunk: int, overlap: int, finish, columns: str) -> DataFrame:
    """Encodings of all rows, finished where they are made: a task never has two Python stages, and so two sets of workers, at once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(F.col(key).alias("k"), text_column(text).alias("text"))
    schema = f"k {plain.schema['k'].dataType.simpleString()}, {columns}"

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in sliced(batches):
            yield finish(batch.column(0), list(encoder.encode(batch.column(1).to_pylist())), shared.value)

    def take(batches):
        for batch in sliced(batches):
            yield finish(batch.column(0), batch.column(1).to_pylist(), shared.value)

    short = plain.where(F.length("text") <= chunk).mapInArrow(run, schema)
    long = plain.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    encoded = encode_long(long.groupBy("key").agg(F.any_value("text").alias("text")), model, chunk, overlap)
    whole = long.select("k", "key").join(encoded, "key").select("k", "ids").mapInArrow(take, schema)
    return short.unionByName(whole).withColumnRenamed("k", key)


def encode_texts(
    docs: DataFrame, model: RankModel, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per row of ``docs``: key, ids (binary, little-endian unsigned 32-bit each)."""
    return _encoded(docs, model, key, text, chunk, overlap, _as_ids, "ids binary")


def encoding_digests(
    docs: DataFrame, model: RankModel, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The same encodings told by digest: key, n_tokens, ids_sha256, decoded_sha256 (of the bytes the ids decode to)."""
    return _encoded(docs, model, key, text, chunk, overlap, _as_digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_ids(encoded: DataFrame, model: RankModel, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded bytes (binary) of its ids as column ``into``."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("binary")
    def joined(column):
        return column.map(lambda raw: decode(raw, shared.value))

    return encoded.withColumn(into, joined(F.col(ids)))
