"""Latest start per person as a stateful stream: random feeds against recomputation, restarts, what a batch writes."""

import datetime as dtm
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tablewright.streaming import feeds, keyed, visits

ROW = "struct<id:bigint,person:bigint,start:date>"
FEED = f"seq bigint, op string, old {ROW}, new {ROW}"


def a_loan(pick, key):
    person = None if pick.random() < 0.05 else 1 if pick.random() < 0.5 else pick.randrange(2, 6)
    return (key, person, dtm.date(2020, 1, 1) + dtm.timedelta(days=pick.randrange(25)))


@pytest.mark.parametrize("seed", [1])
def test_latest_start_under_changes_and_restarts(spark, rows, tmp_path, seed):
    pick = random.Random(seed)
    loans = {k: a_loan(pick, k) for k in range(40)}
    base = spark.createDataFrame(list(loans.values()), "id bigint, person bigint, start date")
    people = spark.createDataFrame([(p,) for p in range(1, 9)], "person bigint")
    latest = people.join(base.groupBy("person").agg(F.max("start").alias("last_visit")), "person", "left")
    schema = StructType([StructField("person", LongType()), StructField("last_visit", DateType())])
    table = keyed.KeyedTable(spark, str(tmp_path / "visits"), "person", schema, buckets=2, every=2).create(latest)
    for n in range(4):
        feed = []
        for k in pick.sample(sorted(loans), 15):
            new = a_loan(pick, k) if pick.random() < 0.4 else None
            feed.append((k, "update" if new else "delete", loans.pop(k), new))
            if new:
                loans[k] = new
        for k in range(100 * (n + 1), 100 * (n + 1) + 6):
            loans[k] = a_loan(pick, k)
            feed.append((k, "insert", None, loans[k]))
        spark.createDataFrame(feed, FEED).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        if n % 2:  # two files at a time, each time from the checkpoint of the run before
            stream = feeds.table_stream(spark, str(tmp_path / "feed"), spark.createDataFrame([], FEED).schema, files_per_batch=1)
            got = visits.stream_last_visit(stream, base, table, "person", "start", str(tmp_path / "checkpoint"))
            want = {p: max((s for _, q, s in loans.values() if q == p), default=None) for p in range(1, 9)}
            assert rows(got) == sorted(want.items())


def test_people_share_a_state_and_one_value_is_read_and_written_per_batch():
    class Handle:
        """A state store that counts its calls."""

        def __init__(self):
            self.value, self.calls = None, 0

        def getValueState(self, *_):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def clear(self):
            self.calls += 1
            self.value = None

    store, made = Handle(), visits._processor("bigint")
    made.init(store)
    made.handleInitialState((0,), {"persons": [1, 1, 2], "days": [5, 6, 7], "counts": [1, 2, 1]}, None)
    moves = [(1, 6, -1), (1, 6, -1), (2, 7, -1), (3, 4, 1), (3, 9, 1), (1, 5, 1)]
    got = list(made.handleInputRows((0,), iter([dict(zip(("person", "day", "sign"), m)) for m in moves]), None))
    assert sorted((r["person"], r["last"]) for r in got) == [(1, 5), (2, None), (3, 9)]
    assert sorted(zip(*store.value)) == [(1, 5, 2), (3, 4, 1), (3, 9, 1)] and store.calls == 3
    gone = [{"person": p, "day": d, "sign": -1} for p, d in ((1, 5), (1, 5), (3, 4), (3, 9))]
    assert sorted((r["person"], r["last"]) for r in made.handleInputRows((0,), iter(gone), None)) == [(1, None), (3, None)] and store.value is None
