"""Scratch tables that cut lineage.

A job that needs stable row positions writes its rows once to the shared folder named by
``spark.checkpoint.dir`` and reads them back, so a lost executor re-reads files and never
renumbers rows. The folder is taken from the session; only a local session that names none
gets a temporary one, anywhere else a missing setting is an error. `scratch_scope` drops what a job wrote in one call.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        # the folder set through SparkContext.setCheckpointDir, if any
        option = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = option.get() if option.isDefined() else None
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tablewright-")
    return _local_dirs[context.applicationId]


_scope: contextvars.ContextVar[str] = contextvars.ContextVar("scratch_scope", default="tablewright")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{_scope.get()}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables written inside lie in a folder of their own, which is dropped at the end.

    Results must be written or collected before the scope ends, as they may read those tables.
    """
    name = f"tablewright/run-{uuid.uuid4().hex}"
    token = _scope.set(name)
    try:
        yield f"{shared_dir(spark)}/{name}"
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table, with its schema given so no footer is sampled."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
