"""Keyed tables merged on read: random batches against a dict, replays, bytes written, what is dropped; net changes."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators import changes as ch
from tablewright.streaming import feeds, keyed

ROW = "struct<id:bigint,person:bigint,v:string>"
SCHEMA = StructType().add("id", "long").add("person", "long").add("v", "string")


def random_batches(pick, now, many, size):
    """Batches of changes in which keys change several times; ``now`` is changed along."""
    out, seq = [], 0
    for _ in range(many):
        batch = []
        for _ in range(size):
            key, seq = pick.randrange(40), seq + 1
            old = now.get(key)
            new = (key, pick.randrange(5), f"v{seq}") if old is None or pick.random() < 0.6 else None
            batch.append((seq, "insert" if old is None else "update" if new else "delete", old, new))
            now.pop(key) if new is None else now.__setitem__(key, new)
        out.append(batch)
    return out


def feed_of(spark, rows):
    return spark.createDataFrame(rows, f"seq bigint, op string, old {ROW}, new {ROW}")


@pytest.mark.parametrize("seed", [1, 2])
def test_several_changes_of_a_key(spark, rows, seed):
    pick = random.Random(seed)
    now = {k: (k, 1, "first") for k in range(0, 40, 3)}
    base = spark.createDataFrame(list(now.values()), SCHEMA)
    (batch,) = random_batches(pick, now, 1, 150)
    assert rows(ch.apply_changes(base, feed_of(spark, batch[::-1]).repartition(3), "id")) == sorted(now.values())


@pytest.mark.parametrize("wrong", [
    [(1, "insert", None, (1, 1, "a")), (2, "insert", None, (1, 1, "b"))], [(1, "delete", (1, 1, "a"), None), (2, "delete", (1, 1, "a"), None)],
])
def test_changes_that_cannot_follow_each_other(spark, wrong):
    base = spark.createDataFrame([], SCHEMA)
    with pytest.raises(Exception, match="do not follow each other for key 1"):
        ch.apply_changes(base, feed_of(spark, wrong), "id").collect()
    twice = feed_of(spark, [(1, "update", (1, 1, "a"), (1, 1, "b")), (2, "update", (1, 1, "b"), (1, 1, "c"))])
    with pytest.raises(Exception, match="do not follow each other"):
        ch.apply_changes(base, twice.drop("seq"), "id").collect()
    assert ch.apply_changes(base, twice, "id").first().v == "c"


def test_table_merged_on_read(spark, rows, tmp_path):
    """Every batch, merges in between, replayed batches, keys that go and come, buckets that run empty."""
    pick = random.Random(7)
    now = {k: (k, 1, "first") for k in range(0, 40, 2)}
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "id", SCHEMA, buckets=3, every=3).create(spark.createDataFrame(list(now.values()), SCHEMA))
    seq = 0
    for batch_id in range(8):
        batch = random_batches(pick, now, 1, 12)[0]
        if batch_id == 4:  # all go away
            batch += [(100, "delete", r, None) for r in now.values()]
            now.clear()
        net = ch.net_changes(feed_of(spark, [(seq + s, *r) for s, *r in batch]), "id")
        for _ in range(2 if batch_id in (2, 3, 5) else 1):
            table.apply(net, batch_id)
            assert rows(table.read(batch_id)) == sorted(now.values())
            table.merge(batch_id)
            assert rows(table.read()) == sorted(now.values())
        seq += 1000
    assert sorted(os.listdir(tmp_path / "t" / "manifest")) == ["upto=2", "upto=5"]
    assert sorted(n for n in os.listdir(tmp_path / "t" / "changes")) == [f"batch={n}" for n in range(3, 8)]


def written(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    many = spark.range(200_000).select("id", (F.col("id") % 100).alias("person"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "id", SCHEMA, buckets=16, every=2).create(many)
    base = written(tmp_path / "t")
    old, new = (F.struct("id", "person", v.alias("v")) for v in (F.col("v"), F.lit("x")))
    sizes = []
    for batch_id, n in enumerate((10, 1000)):
        feed = many.where(F.col("id") < n).select(F.lit(1).alias("seq"), F.lit("update").alias("op"), old.alias("old"), new.alias("new"))
        table.apply(ch.net_changes(feed, "id"), batch_id)
        sizes.append(written(tmp_path / "t" / "changes" / f"batch={batch_id}"))
    assert sizes[0] < base / 1000 and sizes[1] < base / 100
    net = ch.net_changes(many.where("id = 7").select(F.lit(2).alias("seq"), F.lit("update").alias("op"), new.alias("old"), old.alias("new")), "id")
    few = keyed.KeyedTable(spark, str(tmp_path / "few"), "id", SCHEMA, buckets=16, every=1).create(many)
    few.apply(net, 0)
    few.merge(0)
    # one of sixteen buckets is written anew
    assert written(tmp_path / "few" / "base" / "upto=0") < base / 10 and few.read().where("id = 7 and v <> 'x'").count() == 1
    assert few.read().count() == 200_000


def test_copy_follows_facts_and_people(spark, rows, tmp_path):
    pick = random.Random(11)
    facts, people = {k: (k, k % 5, "f") for k in range(30)}, {p: (p, f"P{p}") for p in range(6)}
    person = "struct<person:bigint,name:string>"
    batches = []
    for n in range(4):
        changes = [(*r, None, None) for r in random_batches(pick, facts, 1, 10)[0]]
        p = pick.randrange(6)
        old = people.get(p)
        new = None if old and n == 2 else (p, f"P{p}.{n}")
        changes.append((1, "person", None, None, old, new))
        people.pop(p) if new is None else people.__setitem__(p, new)
        batches.append(changes)
    shape = f"seq bigint, op string, old {ROW}, new {ROW}, old_person {person}, new_person {person}"
    for n, changes in enumerate(batches):
        spark.createDataFrame(changes, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    first = {k: (k, k % 5, "f") for k in range(30)}
    names = spark.createDataFrame([(p, f"P{p}") for p in range(6)], "person bigint, name string")

    def readable(rows, known):
        return rows.join(known, "person").select("id", "name", "v")

    base = spark.createDataFrame(list(first.values()), SCHEMA)
    tables = [
        keyed.KeyedTable(spark, str(tmp_path / folder), key, df.schema, buckets=3, every=2).create(df)
        for folder, key, df in (("facts", "id", base), ("people", "person", names), ("copy", "id", readable(base, names)))
    ]

    def step(batch, batch_id):
        net = ch.net_changes(batch.select("seq", "old", "new"), "id")
        persons = ch.net_changes(batch.select("seq", F.col("old_person").alias("old"), F.col("new_person").alias("new")), "person")
        keyed.keep_copy(*tables, "person", readable, batch_id, net, persons)

    stream = feeds.table_stream(spark, str(tmp_path / "feed"), StructType.fromDDL(shape), files_per_batch=1)
    for _ in range(2):  # the second run finds nothing new
        keyed.keep_tables(stream, tables, step, str(tmp_path / "checkpoint"))
        want = sorted((k, people[p][1], v) for k, p, v in facts.values() if p in people)
        assert rows(tables[2].read()) == want and rows(tables[0].read()) == sorted(facts.values())


def test_links_of_dropped_books(spark, rows):
    """Dropped books take their links along once, refuse late ones, and repeated events change nothing."""
    link = "struct<b:bigint,g:bigint>"
    links = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (3, 9)], "b bigint, g bigint")
    counts = spark.createDataFrame([(7, 2), (8, 1), (9, 1), (10, 0)], "g bigint, books bigint")
    lost = links.select("b").limit(0)
    batches = [
        [("drop", None, (1, None)), ("insert", None, (1, 9)), ("insert", None, (2, 10)), ("insert", None, (2, 10)), ("delete", (3, 9), None)],
        [("drop", None, (1, None)), ("insert", None, (1, 7)), ("delete", (3, 9), None), ("insert", None, (2, 7)), ("insert", None, (4, 9))],
    ]
    now = {(1, 7), (1, 8), (2, 7), (3, 9)}
    for n, batch in enumerate(batches):
        feed = spark.createDataFrame(batch, f"op string, old {link}, new {link}")
        added, removed, lost = ch.link_changes(links, feed, lost, "b")
        counts = ch.inc_link_count(counts, added, removed, "g")
        links = links.join(removed, ["b", "g"], "left_anti").unionByName(added)
        now = {(2, 7), (2, 10)} if n == 0 else {(2, 7), (2, 10), (4, 9)}
        assert rows(links) == sorted(now)
        assert rows(counts) == [(g, sum(1 for _, h in now if h == g)) for g in (7, 8, 9, 10)]


def test_a_large_bucket_is_written_by_several_tasks(spark, rows, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        given = spark.range(0, 100_000, 1, 8).select("id", F.xxhash64("id").alias("v"))
        table = keyed.KeyedTable(spark, str(tmp_path / "wide"), "id", given.schema, buckets=1).create(given)
    finally:
        spark.conf.set(size, before)
    assert len(table.read().inputFiles()) > 4
    assert table.read().agg(F.count("*"), F.count_distinct("id"), F.sum(F.col("v") % 1009)).first() == given.agg(F.count("*"), F.count_distinct("id"), F.sum(F.col("v") % 1009)).first()
