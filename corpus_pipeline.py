"""A corpus from documents to token ids: toxic texts go, of SimHash near-duplicates one stays, benchmark texts go, personal data is covered, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each stage's result as Parquet to the shared scratch
folder and reads it again for the next. Rows with NULL text or doc_id and repeated rows go through all stages by the rules of the
operators' docstrings; extra columns of documents are kept up to the last stage, which returns digests of the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import byte_bpe, decontam, pii, simhash, toxicity
from tablewright.llm.common import ship, table
from tablewright.session import prepare
from tablewright.sources.scratch import scratch_path


def _ready(spark: SparkSession) -> None:
    ship(spark)
    prepare(spark)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier rejects go."""
    _ready(spark)
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (shingles of three words, at most two bits apart): of each group the document with the smallest doc_id stays."""
    _ready(spark)
    return simhash.keep_one(docs, shingle=3, distance=2)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a benchmark item go."""
    _ready(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def private_covered(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: spans are covered, documents stay."""
    _ready(spark)
    return pii.sanitise(docs, length="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token counts and digests of ids and decoded bytes."""
    import public_tokenizers

    _ready(spark)
    model = byte_bpe.RankModel.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.encoding_digests(docs, model)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", benchmark_out),
    ("pii", private_covered),
    ("byte_bpe", encoded),
]

#: SQL can express neither the trained classifier nor the encoding; tests/llm checks every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
