"""Snapshots laid out by key, so that joins and groupings on that key read what belongs together and move nothing.

Rows lie in a fixed number of buckets by hash of the key, sorted inside a bucket, and optionally in folders by further columns (a year), which filters on
these columns prune. Two snapshots with the same key type and number of buckets join without an exchange, bucket by bucket, whatever their size. The layout is in
the files; what a session needs to know about it is told again wherever the folder is read (`read_bucketed`), so no shared catalog is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablewright.sources.files import exists


def _name(path: str) -> str:
    return "snapshot_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, folders: Sequence[str] = ()) -> DataFrame:
    """Write a snapshot by key to a new folder, in one file per bucket (and folder); fails if it is there already.

    Rows are brought to their bucket by one exchange here, so that a bucket is not cut into as many files as there are tasks.
    """
    spark = df.sparkSession
    if exists(spark, path):
        raise FileExistsError(f"snapshot {path} exists")
    # the same hash and number as the buckets', so a task holds one bucket
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(*folders) if folders else writer).saveAsTable(_name(path))
    return spark.table(_name(path))


def read_bucketed(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int, folders: Sequence[str] = ()) -> DataFrame:
    """A snapshot that `write_bucketed` wrote, also in another session: with the layout told to this one."""
    name = _name(path)
    if not exists(spark, f"{path}/_SUCCESS"):
        raise FileNotFoundError(f"no finished snapshot at {path}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        inside = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in folders)})" if folders else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {inside} CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if folders:
            spark.catalog.recoverPartitions(name)
    return spark.table(name)
