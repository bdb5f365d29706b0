"""(total, given, rest) kept by a running query.

State after micro-batch N is the folder batch=N, written whole from batch=N-1 and the batch's own sum.
A replayed batch writes the same folder again, so nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.files import child_names, exists
from tablewright.streaming.feeds import run_available

_BATCH = "batch="
COLUMNS = ("total", "given")


def latest_totals(spark: SparkSession, state_dir: str) -> DataFrame:
    done = [
        int(name.removeprefix(_BATCH)) for name in child_names(spark, state_dir)
        if name.startswith(_BATCH) and exists(spark, f"{state_dir}/{name}/_SUCCESS")
    ]
    if not done:
        raise FileNotFoundError(f"no state in {state_dir}")
    state = spark.read.parquet(f"{state_dir}/{_BATCH}{max(done)}")
    return state.withColumn("rest", F.col("total") - F.col("given"))


def stream_totals(changes: DataFrame, total: Column, given: Column, state_dir: str, checkpoint: str) -> DataFrame:
    """Add ``total`` and ``given`` of every change row; returns the totals after all available input."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        sums = batch.agg(
            F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total"),
            F.coalesce(F.sum(given), F.lit(0)).cast("bigint").alias("given"),
        )
        if batch_id > 0:
            before = batch.sparkSession.read.parquet(f"{state_dir}/{_BATCH}{batch_id - 1}")
            sums = sums.unionByName(before).agg(*[F.sum(c).alias(c) for c in COLUMNS])
        sums.write.mode("overwrite").parquet(f"{state_dir}/{_BATCH}{batch_id}")

    run_available(changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    return latest_totals(changes.sparkSession, state_dir)
