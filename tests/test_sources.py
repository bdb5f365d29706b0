"""Snapshots, compaction, JSON files, contacts, streams."""

import json
from unittest import mock

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablewright.sources import contacts, nested_json, scratch, snapshots
from tablewright.streaming import feeds, totals

STATS = StructType([StructField("total", LongType()), StructField("given", LongType())])


def stats(spark, total, given):
    return spark.createDataFrame([(total, given)], "given int, total int").select(
        F.col("given").alias("total"), F.col("total").alias("given")
    )


def test_snapshot_life(spark, rows, tmp_path):
    path = str(tmp_path / "stats")
    with pytest.raises(FileNotFoundError):
        snapshots.refresh_stats_strict(stats(spark, 1, 1), path)
    first = snapshots.write_snapshot(stats(spark, 5, 1), STATS, path)
    assert rows(first) == [(5, 1)] and first.schema["total"].dataType == LongType()
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(stats(spark, 5, 1), STATS, path)
    # a reload may read what it replaces
    again = snapshots.reload_snapshot(first.withColumn("total", F.col("total") + 1), path)
    assert rows(again) == [(6, 1)] == rows(snapshots.read_snapshot(spark, path))
    assert rows(snapshots.create_or_refresh_stats(stats(spark, 9, 0), path)) == [(9, 0)]


def test_unfinished_version_is_not_read(spark, rows, tmp_path):
    path = str(tmp_path / "stats")
    snapshots.write_snapshot(stats(spark, 5, 1), STATS, path)
    (tmp_path / "stats" / "version=2").mkdir()
    assert rows(snapshots.read_snapshot(spark, path)) == [(5, 1)]


def test_schema_bound_view(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    bound = snapshots.schema_bound_view(df, StructType([StructField("id", LongType())]), "v")
    assert bound.columns == ["id"] and spark.table("v").count() == 1
    for wrong in (StructField("other", LongType()), StructField("name", LongType())):
        with pytest.raises(ValueError):
            snapshots.schema_bound_view(df, StructType([wrong]), "v")


def test_row_counts_include_empty_tables(spark, rows):
    done = snapshots.table_row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(done) == [("a", 3), ("b", 0)]


@pytest.mark.parametrize("small,large,decision", [(0, 4, "leave"), (1, 9, "merge"), (3, 3, "rewrite")])
def test_compaction_bands(spark, rows, tmp_path, small, large, decision):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(small):
        spark.range(5).selectExpr("id", "'s' as kind").coalesce(1).write.mode("append").parquet(path)
    if large:
        spark.range(40_000 * large).selectExpr("id", "'l' as kind").repartition(large).write.mode("append").parquet(path)
    assert snapshots.compact_dataset(spark, path, out, small_bytes=20_000, target_bytes=10**9) == decision
    if decision != "leave":
        before, after = spark.read.parquet(path), spark.read.parquet(out)
        assert rows(after.groupBy("kind").agg(F.count("*"), F.sum("id"))) == rows(before.groupBy("kind").agg(F.count("*"), F.sum("id")))
        assert snapshots.small_file_stats(spark, out, 20_000).first()["small_files"] <= 1


def test_json_file_with_a_bad_record(spark, tmp_path):
    schema = StructType([StructField("name", StringType()), StructField("tags", ArrayType(StringType()))])
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps([{"name": "a", "tags": ["x"]}, {"name": "b", "tags": []}]))
    assert nested_json.scan_nested_json(spark, str(whole), schema).count() == 2
    lines = tmp_path / "lines.json"
    lines.write_text('{"name": "a", "tags": ["x"]}\n{bad\n')
    found = nested_json.scan_nested_json(spark, str(lines), schema, one_document=False).collect()
    assert [(r["name"], r[nested_json.CORRUPT]) for r in found] == [("a", None), (None, "{bad")]


def test_contacts_are_stable_and_well_formed(spark, rows):
    df = spark.range(200).withColumnRenamed("id", "k")
    once = rows(contacts.synth_contacts(df, "k", 1))
    assert once == rows(contacts.synth_contacts(df.repartition(7), "k", 1))
    assert once != rows(contacts.synth_contacts(df, "k", 2))
    for _, first, middle, last, mail, mobile, group in once:
        assert (len(first), len(middle), len(last)) == (6, 8, 10)
        assert mail.endswith("@mail.ru") and len(mobile) == 13 and 1 <= int(group.split()[1]) <= 20


def a_session(conf_dir=None, set_dir=None, master="yarn"):
    """A stand-in session: only what the folder lookup asks for."""
    session = mock.Mock()
    session.conf.get.return_value = conf_dir
    option = session.sparkContext._jsc.sc.return_value.getCheckpointDir.return_value
    option.isDefined.return_value = set_dir is not None
    option.get.return_value = set_dir
    session.sparkContext.master = master
    session.sparkContext.applicationId = "app"
    return session


def test_scratch_folder_comes_from_the_session():
    assert scratch.shared_dir(a_session("hdfs://shared/x/")) == "hdfs://shared/x"
    assert scratch.shared_dir(a_session(None, "hdfs://shared/y")) == "hdfs://shared/y"
    with pytest.raises(RuntimeError):
        scratch.shared_dir(a_session())
    assert "tablewright-" in scratch.shared_dir(a_session(master="local[2]"))


def write_events(spark, path, kinds):
    spark.createDataFrame([(k,) for k in kinds], "kind string").coalesce(1).write.mode("append").parquet(path)


def run_totals(spark, source, state, checkpoint):
    feed = feeds.table_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    given = F.when(F.col("kind") == "lend", 1).when(F.col("kind") == "back", -1).otherwise(0)
    return totals.stream_totals(feed, F.when(F.col("kind") == "new", 1).otherwise(0), given, state, checkpoint)


def test_stream_totals_over_restarts_and_replay(spark, rows, tmp_path):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "checkpoint"))
    write_events(spark, source, ["new", "new", "lend"])
    write_events(spark, source, ["lend", "back", "new"])
    assert rows(run_totals(spark, source, state, checkpoint)) == [(3, 1, 2)]
    write_events(spark, source, ["lend"])
    assert rows(run_totals(spark, source, state, checkpoint)) == [(3, 2, 1)]
    # nothing new: nothing changes
    assert rows(run_totals(spark, source, state, checkpoint)) == [(3, 2, 1)]
    # the last batch is replayed when its commit is lost
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (tmp_path / "checkpoint" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert rows(run_totals(spark, source, state, checkpoint)) == [(3, 2, 1)]


def test_stream_text_filter_appends(spark, rows, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("an error here\nfine\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    feeds.stream_text_filter(spark.readStream.text(str(source)), "value", "error", out, checkpoint)
    (source / "b.txt").write_text("error again\n")
    feeds.stream_text_filter(spark.readStream.text(str(source)), "value", "error", out, checkpoint)
    assert rows(spark.read.parquet(out)) == [("an error here",), ("error again",)]


def test_counts_come_from_footers(spark, rows, tmp_path):
    from tablewright.sources.snapshots import row_counts_of_files

    spark.range(1000).repartition(4).write.parquet(str(tmp_path / "many"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    found = row_counts_of_files(spark, {"many": str(tmp_path / "many"), "none": str(tmp_path / "none")})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2
    assert rows(found) == [("many", 1000), ("none", 0)]
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_text_folder_that_grows(spark, rows, tmp_path):
    """The second run of a query takes only the files that came after the first."""
    from tablewright.streaming import feeds

    def run():
        feeds.stream_text_filter(feeds.text_stream(spark, str(tmp_path / "in")), "value", "find", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        return rows(spark.read.parquet(str(tmp_path / "out")))

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("find me\nnot me\r\nand find\tme\n")
    assert run() == [("and find\tme",), ("find me",)]
    files = {p.name for p in (tmp_path / "out").glob("*.parquet")}
    (tmp_path / "in" / "b.log").write_text("find me\n\nfinder")
    assert run() == [("and find\tme",), ("find me",), ("find me",), ("finder",)]
    new = [str(p) for p in (tmp_path / "out").glob("*.parquet") if p.name not in files]
    assert rows(spark.read.parquet(*new)) == [("find me",), ("finder",)]
    assert len(run()) == 4
