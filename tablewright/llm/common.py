"""Helpers shared by the operators: tables, code-point safe text, fixed-size membership bitmaps, broadcast files."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.scratch import write_scratch

__all__ = ["Bitmap", "bitmap_of", "free_names", "groups_of", "mix64", "ship", "sliced", "table", "text_column", "write_scratch"]

_shipped: set[str] = set()


#: Bits of a membership bitmap: 2**26 bits are 8 MB, whatever the number of keys put in.
BITMAP_BITS = 26


#: Rows of an Arrow batch, where the session has Spark's own default.
ARROW_ROWS = 2_048


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as `spark-submit --py-files` would)."""
    # whole texts go to Python: fewer of them at a time keep a task's memory small
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tablewright-ship-"), "tablewright.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_column(name: str = "text"):
    """The text, an empty one for NULL."""
    return F.coalesce(F.col(name), F.lit(""))


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each lengthened until no column has it (names are compared in lower case, as Spark does)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix64(keys: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys evenly (a multiply and xor-shift finaliser)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        return x


class Bitmap:
    """Which of 2**bits slots are taken. A key that was put in always answers yes; others answer yes by chance."""

    def __init__(self, words: np.ndarray, bits: int = BITMAP_BITS):
        self.words, self.bits = words, bits

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], dtype=np.int64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.astype(np.int64).view(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def bitmap_of(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> Bitmap:
    """A bitmap of a column of 64-bit hashes.

    Spark sets the bits (`bit_or` per 64-bit word, combined on the map side); the driver receives at most
    2**(bits - 6) words, 16 MB by default, however many keys there are. A fuller bitmap only lets more rows
    through to the exact join that always follows.
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        keys.where(F.col(column).isNotNull())
        .select(F.shiftrightunsigned(slot, 6).cast("int").alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("taken"))
        .toPandas()
    )
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    if len(rows):
        words[rows["word"].to_numpy()] = rows["taken"].to_numpy(dtype=np.int64).view(np.uint64)
    return Bitmap(words, bits)


def sliced(batches, rows: int = 1_024):
    """Arrow batches in smaller ones, so that a task holds the texts of few rows as Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def groups_of(items: Iterable, size_of, most: int) -> Iterable[list]:
    """Consecutive lists of items whose sizes add up to about ``most``; one large item makes a list of its own."""
    held, total = [], 0
    for item in items:
        held.append(item)
        total += size_of(item)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held
