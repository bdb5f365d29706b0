"""State machines over ordered events against plain loops: mixed batches under a limit, status flows, one-pass verdicts."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import automata
from tablewright.operators import contracts as ct
from tablewright.operators import rules as rl
from tablewright.operators.automata import scan_states

ROW = "struct<id:bigint,person:bigint,active:boolean>"


def judged_by_hand(stored, feed, limit):
    """seq of the rejected changes, one change after the other."""
    held, out = dict(stored), []
    for seq, op, old, new in sorted(feed, key=lambda r: r[0]):
        if op != "delete" and held.get(new[1], 0) >= limit:
            out.append(seq)
            continue
        if old and old[2]:
            held[old[1]] = max(0, held.get(old[1], 0) - 1)
        if new and new[2]:
            held[new[1]] = held.get(new[1], 0) + 1
    return sorted(out)


def mixed(pick, n, people, owners=True):
    feed = []
    for seq in range(n):
        op = pick.choice(["insert", "insert", "update", "delete"])
        who, flag = pick.choice(people), pick.random() < 0.7
        row = (seq, who, flag)
        if op == "insert":
            feed.append((seq, op, None, row))
        elif op == "delete":
            feed.append((seq, op, row, None))
        else:
            to = pick.choice(people) if owners and pick.random() < 0.4 else who
            feed.append((seq, op, row, (seq, to, pick.random() < 0.5)))
    return feed


@pytest.mark.parametrize("seed, chunk, owners", [(1, 4, False), (2, 5, True), (3, 128, True)])
def test_mixed_batches_under_a_limit(spark, seed, chunk, owners):
    """Stored loans below, at and above the limit; one hot person; loans passed on; chunks so small that tables of tables are needed."""
    pick = random.Random(seed)
    people = [1, 1, 1, 1, 1, 1, 2, 3, 4, None]
    stored = {1: 2, 2: 9, 3: 4, 4: 0, None: 3}
    feed = mixed(pick, 220, people, owners)
    loans = [(1000 + i, p, True) for p, n in stored.items() for i in range(n)] + [(2000, 4, False)]
    got = rl.rule_max_active_feed(
        spark.createDataFrame(feed, f"seq bigint, op string, old {ROW}, new {ROW}").repartition(3),
        spark.createDataFrame(loans, "id bigint, person bigint, active boolean"), "person", lambda r: r["active"], limit=4, chunk=chunk,
    )
    rows = got.collect()
    assert got.columns == ["seq", "op", "old", "new", "broken"] and len(rows) == len(feed)
    assert sorted(r.seq for r in rows if r.broken) == judged_by_hand(stored, feed, 4)
    assert {x for r in rows for x in r.broken} == {"max_active"}


def test_a_place_that_is_freed_is_taken(spark):
    feed = [(1, "insert", None, (1, 7, True)), (2, "delete", (9, 7, True), None), (3, "insert", None, (3, 7, True)), (4, "insert", None, (4, 7, True))]
    table = spark.createDataFrame(feed, f"seq bigint, op string, old {ROW}, new {ROW}")
    loans = spark.createDataFrame([(8, 7, True), (9, 7, True)], "id bigint, person bigint, active boolean")
    got = rl.rule_max_active_feed(table, loans, "person", lambda r: r["active"], limit=2).collect()
    assert sorted((r.seq, r.broken) for r in got) == [(1, ["max_active"]), (2, []), (3, []), (4, ["max_active"])]
    assert rl.rule_max_active_feed(table.limit(0), loans, "person", lambda r: r["active"]).collect() == []


def test_scan_over_many_levels(spark):
    """A hot key of 700 events in chunks of 3: six levels of tables."""
    pick = random.Random(4)
    events = [(1, i, pick.randrange(5)) for i in range(700)] + [(None, 1, 3), (None, 0, 4), (2, 5, 1)]
    start = {1: 2, None: 0, 2: 1}
    df = spark.createDataFrame([(*e, start[e[0]]) for e in events], "k bigint, at bigint, x int, start int").repartition(4)
    got = scan_states(df, ["k"], ["at"], 5, "start", lambda s, e: (s * 2 + e["x"]) % 5, "found", chunk=3).collect()
    want = []
    for k, s in start.items():
        for _, at, x in sorted(e for e in events if e[0] == k):
            want.append((k, at, x, start[k], s))
            s = (s * 2 + x) % 5
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


ALLOWED = [(None, "assigned"), ("assigned", "accepted"), ("accepted", "done"), ("done", "accepted"), ("done", "completed"), ("completed", "removed")]


@pytest.mark.parametrize("chunk", [4, 128])
def test_a_wrong_step_does_not_move_on(spark, rows, chunk):
    pick = random.Random(6)
    names = ["assigned", "accepted", "done", "completed", "removed", "lost", None]
    data = [(pick.choice([1, 1, 1, 2, 3]), i, pick.choice(names)) for i in range(160)] + [(9, 1, "done")]
    want = []
    for key in {d[0] for d in data}:
        now, steps, wrong = None, 0, 0
        for _, _, to in sorted((d for d in data if d[0] == key), key=lambda d: d[1]):
            steps += 1
            if (now, to) in ALLOWED:
                now = to
            else:
                wrong += 1
        want.append((key, steps, wrong, now))
    df = spark.createDataFrame(data, "task bigint, at bigint, state string").repartition(3)
    assert rows(ct.status_flow_machine(df, "task", ["at"], "state", ALLOWED, chunk=chunk)) == sorted(want)
    # judged from the step before, as the pairwise audit does, a wrong step hides what follows
    small = spark.createDataFrame([(1, 1, "assigned"), (1, 2, "removed"), (1, 3, "accepted")], "task bigint, at bigint, state string")
    assert rows(ct.status_flow_machine(small, "task", ["at"], "state", ALLOWED)) == [(1, 3, 1, "accepted")]
    assert rows(ct.status_flow_audit(small, "task", ["at"], "state", ALLOWED)) == [(1, 3, 2)]


def test_valid_and_rejected_in_one_pass(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "Ann L."), (2, "x"), (3, "Bob B."), (4, None)], "id bigint, name string")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(name):
        calls.add(1)
        return name

    flagged = rl.flag_rules(df.withColumn("name", seen("name")), {"short": F.length("name") < 3, "none": F.col("name").isNull()})
    valid, rejected, counts = rl.split_once(flagged, str(tmp_path / "out"))
    assert counts == {"valid": 2, "rejected": 2} and valid.columns == ["id", "name"]
    assert rows(valid) == [(1, "Ann L."), (3, "Bob B.")] and rows(rejected) == [(2, "x", ["short"]), (4, None, ["none"])]
    assert calls.value == 4
    plan = rejected._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_verdict" in plan and "valid" in plan
    none = rl.split_once(flagged.limit(0))
    assert none[2] == {"valid": 0, "rejected": 0} and none[0].count() == 0 and none[1].count() == 0


def test_no_join_brings_a_group_into_one_task(spark, monkeypatch):
    """Events of groups of several chunks, of one full chunk and of less meet their states by chunk, never by group alone."""
    keys, plain = [], automata._matched
    monkeypatch.setattr(automata, "_matched", lambda left, right, on, how: keys.append((tuple(on), "_events" in left.columns)) or plain(left, right, on, how))
    sizes = {"a": 23, "b": 4, "c": 3, None: 9}
    events = spark.createDataFrame([(g, i, i % 3) for g, n in sizes.items() for i in range(n)], "g string, i int, v int").withColumn("start", F.lit(1))
    found = scan_states(events, ["g"], ["i"], 3, "start", lambda s, e: (s + e["v"]) % 3, "state", chunk=4).collect()
    want = [(g, i, (1 + sum(k % 3 for k in range(i))) % 3) for g, n in sizes.items() for i in range(n)]
    assert sorted(((r.g, r.i, r.state) for r in found), key=repr) == sorted(want, key=repr)
    assert keys and all("_chunk" in on for on, wide in keys if wide)
