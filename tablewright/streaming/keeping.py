"""Summary tables kept by a running query: one runner for all jobs of `operators.changes`.

States are named tables. Those after micro-batch N lie in the folder batch=N, written whole from the states in batch=N-1 and the
batch's own changes; the states to start from are batch=-1. A replayed batch reads the same states and writes the same folder
again, so no change counts twice. Once a batch is finished, the folders before the one it read are dropped, as a query only ever
replays its last batch; the states to start from stay. For large tables see `streaming.keyed`, which writes what a batch changes and not the whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.files import child_names, drop, exists
from tablewright.streaming.feeds import run_available

_BATCH = "batch="
States = Mapping[str, DataFrame]


def _write(states: States, folder: str) -> None:
    for name, df in states.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def _read(spark: SparkSession, folder: str, like: States) -> dict[str, DataFrame]:
    return {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in like.items()}


def latest_states(spark: SparkSession, state_dir: str, like: States) -> dict[str, DataFrame]:
    """The states of the last batch of which all tables are finished."""
    numbers = sorted((int(n.removeprefix(_BATCH)) for n in child_names(spark, state_dir) if n.startswith(_BATCH)), reverse=True)
    for number in numbers:
        folder = f"{state_dir}/{_BATCH}{number}"
        if all(exists(spark, f"{folder}/{name}/_SUCCESS") for name in like):
            return _read(spark, folder, like)
    raise FileNotFoundError(f"no state in {state_dir}")


def keep(feed: DataFrame, states: States, step: Callable[[dict[str, DataFrame], DataFrame], States], state_dir: str, checkpoint: str) -> dict[str, DataFrame]:
    """Take all changes the stream ``feed`` has into the states; ``step`` gives the next states from the present ones and a batch."""
    spark = feed.sparkSession
    if not exists(spark, f"{state_dir}/{_BATCH}-1"):
        _write(states, f"{state_dir}/{_BATCH}-1")

    def apply(batch: DataFrame, batch_id: int) -> None:
        present = _read(batch.sparkSession, f"{state_dir}/{_BATCH}{batch_id - 1}", states)
        # a batch is read by several tables of a step, its source files once
        batch = batch.persist()
        try:
            _write(step(present, batch), f"{state_dir}/{_BATCH}{batch_id}")
            for name in child_names(batch.sparkSession, state_dir):
                if name.startswith(_BATCH) and 0 <= int(name.removeprefix(_BATCH)) < batch_id - 1:
                    drop(batch.sparkSession, f"{state_dir}/{name}")
        finally:
            batch.unpersist()

    run_available(feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    return latest_states(spark, state_dir, states)
