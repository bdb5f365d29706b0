"""State after each random batch equals full recomputation; rules and corrections on a feed."""

import datetime as dtm
import os
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes as ch
from tablewright.operators import rules as rl
from tablewright.sources import scratch
from tablewright.streaming import feeds, keeping

LOAN = "struct<id:bigint,person:bigint,book:bigint,start:date,finish:date,active:boolean>"
FEED = f"seq bigint, op string, old {LOAN}, new {LOAN}"
TABLE = "id bigint, person bigint, book bigint, start date, finish date, active boolean"
PEOPLE = list(range(1, 6))


def a_loan(pick, key):
    start = dtm.date(2020, 1, 1) + dtm.timedelta(days=pick.randrange(300))
    return (key, pick.choice(PEOPLE), pick.randrange(1, 8), start, start + dtm.timedelta(days=pick.randrange(40)), pick.random() < 0.5)


def batches(seed, count=2):
    """Starting loans and batches of changes, with the loans after each batch."""
    pick = random.Random(seed)
    loans = {k: a_loan(pick, k) for k in range(30)}
    begin, out, seq = list(loans.values()), [], 0
    for n in range(count):
        feed = []
        for k in pick.sample(sorted(loans), 12):
            new = a_loan(pick, k) if pick.random() < 0.6 else None
            feed.append((seq, "update" if new else "delete", loans.pop(k), new))
            if new:
                loans[k] = new
            seq += 1
        for k in range(100 * (n + 1), 100 * (n + 1) + 5):
            loans[k] = a_loan(pick, k)
            feed.append((seq, "insert", None, loans[k]))
            seq += 1
        out.append((feed, list(loans.values())))
    return begin, out


def people(spark):
    return spark.createDataFrame([(p,) for p in PEOPLE], "person bigint")


def visits(spark, loans):
    latest = loans.groupBy("person").agg(F.max("start").alias("last_visit"))
    return people(spark).join(latest, "person", "left")


def actives(spark, loans):
    counts = loans.filter("active").groupBy("person").agg(F.count("*").alias("books"))
    return people(spark).join(counts, "person", "left").select("person", F.coalesce("books", F.lit(0)).alias("books"))


def sums(loans):
    return loans.selectExpr(
        "5L as persons", "count_if(active) as active", "count_if(not active) as inactive",
        "coalesce(sum(if(active, 0, datediff(finish, start))), 0L) as days",
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_states_equal_recomputation(spark, rows, seed):
    begin, steps = batches(seed)
    loans = spark.createDataFrame(begin, TABLE)
    books = spark.createDataFrame([(b, b * 2) for b in range(1, 8)], "book bigint, copies bigint")
    no_books = spark.createDataFrame([], "op string, old struct<book:bigint,copies:bigint>, new struct<book:bigint,copies:bigint>")
    nobody = spark.createDataFrame([], "op string, old struct<p:bigint>, new struct<p:bigint>")
    names = people(spark).withColumn("name", F.concat(F.lit("P"), F.col("person")))

    def readable(facts):
        return facts.join(names, "person").select("id", "name", "book", "start", "active")

    def totals(df):
        total = books.agg(F.sum("copies")).scalar()
        return df.agg(F.count(F.when(F.col("active"), 1)).alias("given")).select(
            total.alias("total"), "given", (total - F.col("given")).alias("rest")
        )

    state = {
        "visit": visits(spark, loans), "active": actives(spark, loans), "sums": sums(loans),
        "totals": totals(loans), "copy": readable(loans),
    }
    for feed_rows, after_rows in steps:
        feed = spark.createDataFrame(feed_rows, FEED)
        after = spark.createDataFrame(after_rows, TABLE)
        assert rows(ch.apply_changes(loans, feed, "id")) == rows(after)
        active = F.col("active")
        state = {
            "visit": ch.inc_last_visit(state["visit"], feed, after, "person", "start"),
            "active": ch.inc_active_count(state["active"], feed, "person", active),
            "sums": ch.inc_averages(state["sums"], nobody, feed, active, "start", "finish"),
            "totals": ch.inc_library_totals(state["totals"], no_books, feed, after, "book", "copies", "book", active),
            "copy": ch.inc_denormalised_copy(
                state["copy"], feed, after, spark.createDataFrame([], "person bigint"), "id", "person", readable
            ),
        }
        want = {
            "visit": visits(spark, after), "active": actives(spark, after), "sums": sums(after),
            "totals": totals(after), "copy": readable(after),
        }
        for name, df in state.items():
            cols = sorted(want[name].columns)
            assert rows(df, *cols) == rows(want[name], *cols), name
        # state as stored between batches
        state = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in state.items()}
        loans = after


@pytest.mark.parametrize("old,new,deltas", [
    ((1, True), (1, False), {1: -1}), ((1, False), (1, True), {1: 1}), ((1, True), (2, True), {1: -1, 2: 1}),
    ((1, True), (2, False), {1: -1}), ((1, False), (2, True), {2: 1}), ((1, False), (2, False), {}),
    (None, (1, True), {1: 1}), ((1, True), None, {1: -1}),
])
def test_active_count_transitions(spark, rows, old, new, deltas):
    kind = "struct<person:bigint,active:boolean>"
    op = "insert" if old is None else "delete" if new is None else "update"
    feed = spark.createDataFrame([(op, old, new)], f"op string, old {kind}, new {kind}")
    state = spark.createDataFrame([(1, 5), (2, 5)], "person bigint, books bigint")
    done = ch.inc_active_count(state, feed, "person", F.col("active"))
    assert rows(done) == [(p, 5 + deltas.get(p, 0)) for p in (1, 2)]


def test_deleted_book_takes_its_loans_and_genres(spark, rows):
    kind = "struct<book:bigint,copies:bigint>"
    books = spark.createDataFrame([("delete", (1, 4), None), ("insert", None, (3, 2))], f"op string, old {kind}, new {kind}")
    loans = spark.createDataFrame([(1, 1, 1, None, None, True), (2, 1, 2, None, None, True)], TABLE)
    no_loans = spark.createDataFrame([], FEED)
    state = spark.createDataFrame([(10, 2, 8)], "total bigint, given bigint, rest bigint")
    done = ch.inc_library_totals(state, books, no_loans, loans, "book", "copies", "book", F.col("active"))
    assert rows(done) == [(8, 1, 7)]

    links = spark.createDataFrame([(1, 7), (1, 8), (2, 7)], "book bigint, g bigint")
    no_links = spark.createDataFrame([], "op string, old struct<book:bigint,g:bigint>, new struct<book:bigint,g:bigint>")
    counts = spark.createDataFrame([(7, 2), (8, 1), (9, 0)], "g bigint, books bigint")
    gone = books.filter("op = 'delete'").select("old.book")
    assert rows(ch.inc_genre_count(counts, no_links, gone, links, "g", "book")) == [(7, 1), (8, 0), (9, 0)]


def test_renamed_person_is_rebuilt(spark, rows):
    facts = spark.createDataFrame([(1, 1), (2, 2)], "id bigint, person bigint")
    state = spark.createDataFrame([(1, "old"), (2, "kept")], "id bigint, name string")
    names = spark.createDataFrame([(1, "new"), (2, "other")], "person bigint, name string")
    nothing = spark.createDataFrame([], "op string, old struct<id:bigint,person:bigint>, new struct<id:bigint,person:bigint>")
    renamed = spark.createDataFrame([(1,)], "person bigint")
    done = ch.inc_denormalised_copy(
        state, nothing, facts, renamed, "id", "person", lambda f: f.join(names, "person").select("id", "name")
    )
    assert rows(done) == [(1, "new"), (2, "kept")]


def test_row_by_row_limit(spark, rows):
    """The running sum accepts exactly what checking row after row accepts."""
    pick = random.Random(9)
    stored = [(p, "Y") for p in PEOPLE for _ in range(pick.randrange(5))]
    batch = [(i, 1 if pick.random() < 0.5 else pick.choice(PEOPLE), pick.choice("YN")) for i in range(60)]
    held = {p: sum(1 for q, _ in stored if q == p) for p in PEOPLE}
    accepted = []
    for seq, person, state in batch:
        if held[person] < 4:
            accepted.append((seq,))
            held[person] += state == "Y"
    done = rl.rule_max_active(
        spark.createDataFrame(batch, "seq bigint, person bigint, state string"),
        spark.createDataFrame(stored, "person bigint, state string"),
        "person", "seq", F.col("state") == "Y", F.lit(True), limit=4,
    )
    assert rows(rl.split(done)[0], "seq") == accepted


def test_corrections_then_rules(spark, rows):
    df = spark.createDataFrame([("Ann Lee",), ("Bob B.",), ("",)], "name string")
    fixed = rl.fix_trailing_dot(df, "name")
    assert rows(fixed) == [
        (".", "Value [] was automatically changed to [.]"),
        ("Ann Lee.", "Value [Ann Lee] was automatically changed to [Ann Lee.]"), ("Bob B.", None),
    ]
    late = spark.sql("SELECT DATE'2020-01-01' AS s, DATE'2019-01-01' AS f UNION ALL SELECT DATE'2020-01-01', DATE'2030-01-01'")
    as_of = F.lit("2020-12-31").cast("date")
    done = rl.fix_finish_date(late, "s", "f", as_of)
    assert rows(done, "f", "message") == [
        (dtm.date(2021, 2, 28), "Value [2019-01-01] was automatically changed to [2021-02-28]"), (dtm.date(2030, 1, 1), None)
    ]
    assert rl.split(rl.rule_dates(done, "s", "f", F.lit(True), as_of))[1].count() == 0


def test_reactivation_and_age(spark, rows):
    feed = spark.createDataFrame([("N", "Y"), ("Y", "N"), ("N", "N")], "a string, b string")
    flagged = rl.rule_no_reactivation(feed, F.col("a") == "Y", F.col("b") == "Y")
    assert rows(rl.split(flagged)[1], "a", "b") == [("N", "Y")]
    years = spark.createDataFrame([(1920,), (1919,)], "y int")
    flagged = rl.rule_year_window(years, F.col("y"), F.lit("2020-05-05").cast("date"))
    assert rows(rl.split(flagged)[1], "y") == [(1919,)]


def test_replayed_batches_change_nothing(spark, rows, tmp_path):
    """The same stream from a new checkpoint: every batch writes the state it wrote before."""
    row = "struct<id:bigint,v:bigint>"
    feed = spark.createDataFrame(
        [("insert", None, (i, i)) for i in range(20)] + [("update", (100, 1), (100, 5)), ("delete", (101, 1), None)], f"op string, old {row}, new {row}"
    )
    feed.repartition(4).write.parquet(str(tmp_path / "feed"))
    base = spark.createDataFrame([(100, 1), (101, 1)], "id bigint, v bigint")

    def step(now, batch):
        return {"rows": ch.apply_changes(now["rows"], batch, "id")}

    found = []
    for checkpoint in ("one", "one", "two"):
        stream = feeds.table_stream(spark, str(tmp_path / "feed"), feed.schema, files_per_batch=1)
        kept = keeping.keep(stream, {"rows": base}, step, str(tmp_path / "state"), str(tmp_path / checkpoint))
        found.append(rows(kept["rows"]))
    assert found[0] == found[1] == found[2] == [*((i, i) for i in range(20)), (100, 5)]


def test_scratch_of_a_scope_is_dropped(spark):
    with scratch.scratch_scope(spark) as folder:
        table = scratch.write_scratch(spark.range(5), "t")
        assert table.count() == 5 and table.inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
