"""Nested JSON into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.operators.automata import CHUNK, scan_states
from tablewright.operators.numbering import SLICE, ordered_slices, with_running_sum

CORRUPT = "_corrupt"


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def scan_nested_json(spark: SparkSession, path: str, schema: StructType, one_document: bool = True) -> DataFrame:
    """Records of JSON files. ``one_document`` reads a whole-file array; else one record per line, which splits."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("multiLine", one_document)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def parse_nested_json(df: DataFrame, col: str, schema: StructType, out: str = "record") -> DataFrame:
    """Parse a text column; text that does not fit keeps its original in ``out._corrupt``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn(out, F.from_json(col, _with_corrupt(schema), options))


def _outside(text: Column) -> tuple[Column, Column]:
    """What of a text lies outside strings, and whether it ends inside one."""
    plain = F.regexp_replace(text, F.lit(r"(?s)\\."), F.lit(""))
    closed = F.regexp_replace(plain, F.lit('"[^"]*"'), F.lit(""))
    return F.substring_index(closed, '"', 1), F.contains(closed, F.lit('"'))


def scan_json_array(spark: SparkSession, path: str, schema: StructType, chunk: int = CHUNK) -> DataFrame:
    """Records of JSON files that are arrays of objects, whatever their layout; one large file is read by many tasks.

    Files are cut at every closing brace, which the text reader does by byte ranges. Whether a piece begins inside a string depends on all
    before it: a piece is a function of two states, and these compose (`operators.automata`). With that known, a running sum of the
    brackets outside strings gives the depth, and a record ends where the depth is that of the array again; pieces of a record are put together by its number,
    so it may lie across the border of two byte ranges. Text that is no object of an array comes as a corrupt record. A record must fit a row.
    """
    whole = spark.read.option("lineSep", "}").text(path)
    pieces = whole.select(
        # a path in every row would be most of it
        F.unhex(F.md5(F.col("_metadata.file_path"))).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value",
        F.lit(0).alias("start"),
    )

    def change(inside: bool) -> Column:
        """How a piece and its brace change depth and state: (state after, depth)."""
        text = F.concat(F.lit('"'), "value") if inside else F.col("value")
        out, ends_inside = _outside(text)
        opened = F.length(out) - F.length(F.translate(out, "[{", ""))
        shut = F.length(out) - F.length(F.translate(out, "]}", ""))
        return F.struct(ends_inside.cast("int").alias("to"), (opened - shut - F.when(ends_inside, 0).otherwise(1)).cast("long").alias("depth"))

    told = pieces.withColumn("plain", change(False)).withColumn("quoted", change(True))
    found = scan_states(
        told, ["file"], ["block", "nth"], 2, "start", lambda s, e: F.when(s == 0, e["plain"]["to"]).otherwise(e["quoted"]["to"]), "state", chunk=chunk
    )
    here = F.when(F.col("state") == 0, F.col("plain")).otherwise(F.col("quoted"))
    moved = found.select("file", "block", "nth", "value", here["depth"].alias("depth"), (here["to"] == 0).alias("outside"))
    slices = ordered_slices(moved, ["file", "block", "nth"])
    deep = with_running_sum(slices, ["file"], ["block", "nth"], F.col("depth"), "above")
    ends = F.when(F.col("outside") & (F.col("above") + F.col("depth") == 1), 1).otherwise(0)
    numbered = with_running_sum(deep.withColumn("ends", ends), ["file"], ["block", "nth"], F.col("ends"), "record").drop(SLICE)
    # the depth that a record ends at tells whether its last piece had a brace
    joined = numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "nth", "value"))), lambda p: p["value"]), "}").alias("text"),
        F.max("ends").alias("ended"),
    )
    text = F.regexp_replace("text", r"^[\s,\[\]]+", "")
    texts = joined.select(F.when(F.col("ended") == 1, F.concat(text, F.lit("}"))).otherwise(F.rtrim(text)).alias("text")).where("text <> ''")
    return parse_nested_json(texts, "text", schema).select("record.*")
