"""Streams over file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.sources.files import is_file


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Files of a Parquet table as a stream. ``path`` is a folder, or a single file of one."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run_available(writer) -> None:
    """Start a query, let it take all input there is, and wait for its end."""
    started = writer.trigger(availableNow=True).start()
    try:
        started.awaitTermination()
    finally:
        started.stop()


def stream_text_filter(lines: DataFrame, col: str, word: str, out: str, checkpoint: str) -> None:
    """Append the lines that hold ``word`` to ``out``."""
    kept = lines.filter(F.col(col).contains(word))
    run_available(
        kept.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    )


def text_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines (column value) of the text files of a folder that grows: a query with a checkpoint takes only files it has not seen yet."""
    return spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch).text(folder)
