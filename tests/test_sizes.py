"""Shares of a task that stay the same when tables grow."""

import pytest
from pyspark.sql import functions as F

from tablewright import session
from tablewright.operators import numbering
from tablewright.plans import maintaining, sourcing
from tablewright.sources.trial import Trial

SETTINGS = [
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
]


@pytest.fixture
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_exchanges_begin_with_partitions_for_the_tables_size(settings):
    few, many = 1 << 20, 1 << 30
    counts = []
    for size in (few, many):
        session.prepare(settings, size)
        counts.append(int(settings.conf.get(SETTINGS[0])))
    assert counts[0] == int(settings.conf.get("spark.sql.shuffle.partitions")) and counts[1] >= many // session.TASK_BYTES
    assert int(settings.conf.get(SETTINGS[1])) == session.TASK_BYTES


def test_slices_stay_small(settings, monkeypatch):
    """Of two tables the larger one has more slices and not larger ones."""
    monkeypatch.setattr(session, "TASK_BYTES", 1 << 18)
    largest = []
    for n in (100_000, 800_000):
        session.prepare(settings, 8 * n)
        slices = numbering.ordered_slices(settings.range(n).select("id", F.xxhash64("id").alias("v")), ["v"])
        largest.append(slices.groupBy(numbering.SLICE).count().agg(F.max("count")).first()[0])
    assert largest[1] < 2 * largest[0]


def test_a_feed_has_three_batches_of_many_files(spark, monkeypatch, tmp_path):
    for name in ("customer", "part", "orders", "lineitem"):
        spark.range(1000).write.parquet(str(tmp_path / f"{name}.parquet"))
    trial = Trial(spark, str(tmp_path))
    feed = spark.range(3000).select(F.col("id") % 500, "id").toDF("k", "v")
    for size in (1 << 30, 2_000):
        monkeypatch.setattr(maintaining, "FILE_BYTES", size)
        batches = []
        stream = maintaining._feed_stream(trial, feed, "k")
        maintaining.feeds.run_available(
            stream.writeStream.foreachBatch(lambda df, n: batches.append((len(df.select("k").distinct().collect()), df.count()))).option("checkpointLocation", str(tmp_path / f"c{size}"))
        )
        assert len(batches) == 3 and sum(k for k, _ in batches) == 500 and sum(n for _, n in batches) == 3000


def test_splits_stay_small(settings, monkeypatch, tmp_path):
    """A larger text is read by more tasks and not by tasks that hold more of it before an exchange."""
    settings.range(100_000).select(F.col("id").cast("string")).coalesce(1).write.text(str(tmp_path / "t"))
    key = "spark.sql.files.maxPartitionBytes"
    before = settings.conf.get(key)
    try:
        monkeypatch.setattr(session, "TASK_BYTES", 1 << 16)
        session.prepare(settings, 1 << 20)
        assert settings.read.text(str(tmp_path / "t")).rdd.getNumPartitions() >= 8
    finally:
        settings.conf.set(key, before)


def test_arrays_of_ten_thousand_whatever_the_ids(settings, monkeypatch, tmp_path):
    """Events with one and the same number, or none, still make arrays of a bounded size."""
    ids = F.when(F.col("id") < 25_000, F.lit(7))
    rows = settings.range(0, 45_000, 1, 1).select(ids.alias("event_id"), F.col("id").alias("user_id"), F.lit("buy").alias("event_type"), F.lit('{"k": 3}').alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(sourcing, "scratch_path", lambda spark, label: str(tmp_path / "arrays"))
    found = sourcing.scan_json_array(Trial(settings, str(tmp_path)))
    assert found.groupBy("event_id", "k", "note", "corrupt").count().count() == 2 and found.select("user_id").distinct().count() == 45_000
    assert settings.read.text(str(tmp_path / "arrays")).where("value like '[ {%'").count() == 5
