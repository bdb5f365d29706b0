"""Snapshot tables: create, reload, refresh, and compaction of small files.

A snapshot is a folder of numbered versions. A reload writes the next version and readers take the
newest one whose write finished, so a reader never sees a half-written table and a lost executor
costs a retried task, not the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.sources.files import child_names, exists

_VERSION = "version="


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """Every row and column of a Parquet table."""
    return spark.read.parquet(path)


def latest_version(spark: SparkSession, path: str) -> int | None:
    numbers = [
        int(name.removeprefix(_VERSION)) for name in child_names(spark, path) if name.startswith(_VERSION)
    ]
    finished = (n for n in sorted(numbers, reverse=True) if exists(spark, f"{path}/{_VERSION}{n}/_SUCCESS"))
    return next(finished, None)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    version = latest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no snapshot at {path}")
    return spark.read.parquet(f"{path}/{_VERSION}{version}")


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_snapshot(df: DataFrame, schema: StructType, path: str) -> DataFrame:
    """Create a typed table and fill it; fails if the table is there already."""
    spark = df.sparkSession
    if latest_version(spark, path) is not None:
        raise FileExistsError(f"snapshot {path} exists")
    cast_to(df, schema).write.mode("errorifexists").parquet(f"{path}/{_VERSION}1")
    return read_snapshot(spark, path)


def reload_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole content. ``df`` may itself read the current version. Of two reloads at once the later one fails."""
    spark = df.sparkSession
    schema = read_snapshot(spark, path).schema
    version = latest_version(spark, path) + 1
    cast_to(df, schema).write.mode("errorifexists").parquet(f"{path}/{_VERSION}{version}")
    return read_snapshot(spark, path)


def create_or_refresh_stats(stats: DataFrame, path: str) -> DataFrame:
    """Create the statistics table when it is missing, else refresh its values."""
    if latest_version(stats.sparkSession, path) is None:
        return write_snapshot(stats, stats.schema, path)
    return reload_snapshot(stats, path)


def refresh_stats_strict(stats: DataFrame, path: str) -> DataFrame:
    """Refresh the statistics table; it must exist."""
    if latest_version(stats.sparkSession, path) is None:
        raise FileNotFoundError(f"the statistics table {path} is missing")
    return reload_snapshot(stats, path)


def fn_stats_delta(stats: DataFrame, path: str, col: str = "total") -> DataFrame:
    """Refresh the one-row statistics table and return its new value minus the old one."""
    old = read_snapshot(stats.sparkSession, path).select(col).scalar()
    return refresh_stats_strict(stats, path).select((F.col(col) - old).alias("delta"))


def named_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def schema_bound_view(df: DataFrame, required: StructType, name: str) -> DataFrame:
    """A named view that fails early when a base column is missing or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name} {f.dataType.simpleString()}" for f in required.fields if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"view {name} needs columns: {', '.join(wrong)}")
    return named_view(df.select(*required.names), name)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows_count) for each table, in one job."""
    counts = [
        df.agg(F.count("*").alias("rows_count")).select(F.lit(name).alias("table_name"), "rows_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def row_counts_of_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, rows_count) of Parquet tables, from the footers of their files: no row group is opened.

    The second version of the Parquet source takes the count over; it is asked for in a session of its own, so the caller's settings stay. Sums of
    one row per file are not worth planning anew, so that session does without adaptive execution.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.adaptive.enabled", "false")
    counts = table_row_counts({name: own.read.parquet(path) for name, path in paths.items()})
    # files without a row group bring no count
    return counts.groupBy("table_name").agg(F.coalesce(F.sum("rows_count"), F.lit(0)).alias("rows_count"))


def small_file_stats(spark: SparkSession, path: str, small_bytes: int) -> DataFrame:
    """One row: number of files, of small files, and their bytes. Files are listed, none is opened."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        .select(F.col("length").alias("size"))
    )
    small = F.col("size") < small_bytes
    return files.agg(
        F.count("*").alias("files"),
        F.count(F.when(small, 1)).alias("small_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(small, F.col("size"))), F.lit(0)).alias("small_file_bytes"),
    )


def compact_dataset(
    spark: SparkSession,
    path: str,
    out: str,
    small_bytes: int,
    target_bytes: int = 256 * 1024 * 1024,
    lo: float = 5.0,
    hi: float = 30.0,
) -> str:
    """Decide by the share of small files and write the result to ``out``, unless the dataset is left as it is.

    Below ``lo`` percent the dataset is left alone; up to ``hi`` only the rows of small files are
    merged, the others pass through without a shuffle; above that everything is rewritten. Returns
    'leave', 'merge' or 'rewrite'.
    """
    stats = small_file_stats(spark, path, small_bytes).first()
    share = 100.0 * stats["small_files"] / stats["files"] if stats["files"] else 0.0
    if share < lo:
        return "leave"
    rows = spark.read.parquet(path)
    if share > hi:
        rows.repartition(max(1, -(-stats["bytes"] // target_bytes))).write.parquet(out)
        return "rewrite"
    is_small = F.col("_metadata.file_size") < small_bytes
    merged = rows.filter(is_small).repartition(max(1, -(-stats["small_file_bytes"] // target_bytes)))
    rows.filter(~is_small).unionByName(merged).write.parquet(out)
    return "merge"
