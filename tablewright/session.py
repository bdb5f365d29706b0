"""Session builder used by tests and the bench. On a cluster the caller brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: Shuffled bytes for one task; rows that it sorts or groups take some thirty times that in memory.
TASK_BYTES = 8 << 20


def prepare(spark: SparkSession, input_bytes: int | None = None) -> None:
    """Runtime settings the jobs count on: split hot join keys even where that costs another shuffle.

    `build_session` has them; on a session of your own call this once, as the registered queries do. With the size of the tables
    exchanges begin with enough partitions for it, and adaptive execution joins them up to ``TASK_BYTES``, so that a task's share is the same for
    tables of every size.
    """
    if input_bytes is not None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // (TASK_BYTES // 2)))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(4 * TASK_BYTES))
        # before an exchange of more than 200 partitions a task holds all rows of its split
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def build_session(
    app: str = "tablewright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
