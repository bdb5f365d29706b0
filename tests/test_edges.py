"""Hand-made edge rows: NULLs, empty sides, ties, rule borders."""

import datetime as dtm

import pytest
from pyspark.sql import functions as F

from tablewright.functions import dates as dt
from tablewright.functions import text as tx
from tablewright.operators import aggregates as ag
from tablewright.operators import contracts as ct
from tablewright.operators import filters as flt
from tablewright.operators import joins as jn
from tablewright.operators import modify as md
from tablewright.operators import ranking as rk
from tablewright.operators import rules as rl
from tablewright.operators import sets as st
from tablewright.operators import text_jobs as tj


def ids(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


@pytest.mark.parametrize("left,right,kept", [
    ([1, 2], [1, None], []),
    ([1, 2], [1], [2]),
    ([1, None], [1], []),
    ([1, None], [], [None, 1]),
    ([None], [None], []),
])
def test_not_in_null_rules(spark, rows, left, right, kept):
    done = jn.anti_join_not_in(ids(spark, left), ids(spark, right, "r"), "k", "r")
    assert rows(done) == [(k,) for k in kept]
    ids(spark, left).createOrReplaceTempView("l")
    ids(spark, right, "r").createOrReplaceTempView("r")
    assert rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT r FROM r)")) == [(k,) for k in kept]


@pytest.mark.parametrize("values,winner", [
    ([(1, 5)], [(1, 5)]), ([(1, None)], [(1, None)]), ([(1, 5), (2, 5), (3, 3)], []),
    ([(1, 5), (2, 4)], [(1, 5)]), ([(1, 5), (2, None)], []), ([], []),
])
def test_greater_than_all(spark, rows, values, winner):
    df = spark.createDataFrame(values, "id bigint, v bigint")
    assert rows(jn.greater_than_all(df, "id", "v")) == winner


@pytest.mark.parametrize("other,kept", [([], [1, 9]), ([5, 7], [1]), ([5, None], []), ([1], [])])
def test_less_than_all(spark, rows, other, kept):
    assert rows(jn.less_than_all(ids(spark, [1, 9]), ids(spark, other), "k")) == [(k,) for k in kept]


def test_ties(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 3)], "id bigint, v bigint")
    assert rows(rk.rank_unique_winner(df, "v")) == []
    assert rows(rk.rank_ties_first(df, "v")) == [(1, 5), (2, 5)] == rows(rk.max_rows_all_ties(df, "v"))
    assert rows(rk.top_1(df, "v", "id")) == [(1, 5)]
    ranked = df.selectExpr("*", "rank() over (order by v desc) as r").filter("r = 1").drop("r")
    assert rows(ranked) == rows(rk.rank_ties_first(df, "v"))


def test_left_outer_join_keeps_repeats_and_nulls(spark, rows):
    a = ids(spark, [1, 1, 2, None], "a")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "b bigint, name string")
    built_in = a.join(b, a["a"] == b["b"], "left")
    assert rows(jn.left_outer_join(a, b, "a", "b")) == rows(built_in)


def test_cross_anti_pairs_brute_force(spark, rows):
    a, b = ids(spark, [1, 2, 3], "a"), ids(spark, [10, 20, 30, 40], "b")
    used = spark.createDataFrame([(1, 10), (1, 10), (1, 30), (2, 40), (2, 99)], "a bigint, b bigint")
    done = jn.cross_anti_pairs(a, b, used, "a", "b")
    assert rows(done) == [(1, 20, 20, 1), (1, 40, 40, 1), (2, 10, 30, 3), (3, 10, 40, 4)]


def test_cross_join_with_an_empty_side(spark, rows):
    assert rows(jn.cross_join_all_pairs(ids(spark, [1], "a"), ids(spark, [], "b"), "a", "b")) == []


def test_self_join_pairs_counts_every_pair(spark, rows):
    df = spark.createDataFrame([(i, i % 3, 1) for i in range(8)], "id bigint, s bigint, r bigint")
    done = jn.self_join_pairs(df, "id", ["s", "r"])
    a, b = df.alias("a"), df.alias("b")
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.r") == F.col("b.r")) & (F.col("a.id") > F.col("b.id")))
    assert done.select("first_id", "pairs").distinct().agg(F.sum("pairs")).first()[0] == pairs.count()


def test_relational_division_ignores_repeats(spark, rows):
    link = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (2, 8)], "b bigint, a bigint")
    assert rows(jn.relational_division(link, "b", "a", [7, 8, 8])) == [(2,)]


def test_guard_and_flag(spark, rows):
    assert rows(jn.not_exists_guard(ids(spark, [2, 3]), "k", 1)) == [(1,)]
    assert rows(jn.not_exists_guard(ids(spark, [1]), "k", 1)) == []
    assert rows(jn.exists_flag(ids(spark, [2]), F.col("k") > 5)) == [(0,)]


def test_unmatched_parents(spark, rows):
    classes = spark.createDataFrame([("Yamato", 18), ("Bismarck", 15), ("Kongo", 14)], "class string, bore int")
    ships = spark.createDataFrame([("Musashi", "Yamato"), ("Kongo", "Kongo")], "name string, class_of string")
    outcomes = spark.createDataFrame([("Bismarck",), ("Bismarck",), ("Kongo",), ("Hood",)], "ship string")
    done = jn.join_unmatched_parent_union(classes, ships, outcomes, "class", "name", "class_of", "ship")
    assert rows(done, "class", "name") == [
        ("Bismarck", None), ("Bismarck", "Bismarck"), ("Kongo", "Kongo"), ("Yamato", "Musashi")
    ]


@pytest.mark.parametrize("values,median", [([1, 2, 3], 2.0), ([1, 2, 3, 4], 2.5), ([5], 5.0)])
def test_median_of_counts(spark, rows, values, median):
    df = spark.createDataFrame([(k,) for k, n in enumerate(values) for _ in range(n)], "k bigint")
    assert rows(ag.median_of_counts(df, "k")) == [(median,)]


def test_totals_of_nothing(spark, rows):
    books = spark.createDataFrame([], "q int")
    loans = spark.createDataFrame([], "active boolean, start date, finish date")
    assert rows(ag.library_totals(books, loans, "q", F.col("active"))) == [(0, 0, 0)]
    assert rows(ag.ratio_averages(books, loans, F.col("active"), "start", "finish")) == [(None, None, None)]


def test_max_only(spark, rows):
    owners = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (3, 12)], "a bigint, b bigint")
    parts = spark.createDataFrame([(10, 1), (10, 2), (11, 1), (11, 2), (11, 3), (12, 1)], "b bigint, g bigint")
    assert rows(ag.max_of_group_counts(owners, parts, "a", "b")) == [(1, 3), (2, 3)]
    few = owners.filter("b <> 11 or a = 2")
    assert rows(ag.max_of_group_counts(few, parts, "a", "b", max_only=True)) == [(2, 3)]


@pytest.mark.parametrize("days,text", [(9, "9 OK"), (10, "10 NOTICE"), (30, "30 NOTICE"), (31, "31 WARNING")])
def test_duration_borders(spark, rows, days, text):
    df = spark.sql(f"SELECT DATE'2020-01-01' AS s, date_add(DATE'2020-01-01', {days}) AS f")
    assert rows(df.select(dt.fn_duration_status(F.col("s"), F.col("f")))) == [(text,)]


@pytest.mark.parametrize("start,end,verdict,broken", [
    ("2020-01-01", "2021-01-01", 1, []), ("2020-07-01", "2021-01-01", -1, [1]), ("2020-01-01", "2020-02-01", -2, [2]),
    ("2020-01-01", "2019-01-01", -3, [2, 3]), ("2020-07-01", "2020-05-01", -3, [1, 2, 3]),
])
def test_date_rules(spark, rows, start, end, verdict, broken):
    df = spark.sql(f"SELECT DATE'{start}' AS s, DATE'{end}' AS f")
    as_of, yes = F.lit("2020-06-01").cast("date"), F.lit(True)
    done = df.select(
        dt.fn_check_dates(F.col("s"), F.col("f"), yes, as_of), dt.fn_all_broken_dates(F.col("s"), F.col("f"), yes, as_of)
    )
    assert rows(done) == [(verdict, broken)]


@pytest.mark.parametrize("name,ok", [("Ivanov I.I.", 1), ("Иванов И.И.", 1), ("Ivanov", 0), ("A B", 0), ("Ivanov.", 0)])
def test_name_rule(spark, rows, name, ok):
    df = spark.createDataFrame([(name,)], "n string")
    assert rows(df.select(tx.fn_check_name(F.col("n")))) == [(ok,)]
    valid, rejected = rl.split(rl.rule_name_format(df, "n"))
    assert (valid.count(), rejected.count()) == (ok, 1 - ok)
    if not ok:
        with pytest.raises(ValueError):
            rl.require_valid(rl.rule_name_format(df, "n"))


def test_month_end_shift(spark, rows):
    df = spark.sql("SELECT DATE'2023-12-31' AS d")
    assert rows(md.update_shift_date(df, F.lit(True), "d", months=2)) == [(dtm.date(2024, 2, 29),)]


def test_null_predicates_modify_nothing(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "id bigint, v bigint")
    assert rows(md.delete_where(df, F.col("v") == 5)) == [(1, None)]
    assert rows(md.update_where(df, F.col("v") > 1, {"v": F.lit(0)})) == [(1, None), (2, 0)]


def test_update_from_join_both_modes(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, v bigint")
    src = spark.createDataFrame([(1, 99)], "id bigint, w bigint")
    assert rows(md.update_from_join(df, src, "id", {"v": "w"})) == [(1, 99), (2, None)]
    assert rows(md.update_from_join(df, src, "id", {"v": "w"}, keep_unmatched=True)) == [(1, 99), (2, 20)]


def test_view_edits_are_guarded(spark):
    base = spark.createDataFrame([(1, 5)], "id bigint, person bigint")
    edited = spark.createDataFrame([(2, "7")], "id bigint, person string")
    with pytest.raises(Exception, match="not allowed"):
        md.view_update_through(base, edited, {"person": F.col("new.person")}, "id").collect()
    with pytest.raises(Exception, match="digits"):
        typed = spark.createDataFrame([(None, "Bob")], "id bigint, person string")
        md.view_insert_through(base, typed, {}, "id", ["person"], {"digits": ~F.col("person").rlike("[^0-9]")}).collect()


def test_char_classes(spark, rows):
    df = spark.createDataFrame([("1298",), ("abC",), ("12a",), ("a-b",), ("",), (None,)], "m string")
    assert rows(flt.filter_char_class(df, "m")) == [("",), ("1298",), ("abC",)]


def test_between_spellings_agree(spark, rows):
    df = ids(spark, [1, 2, 3, 4, None])
    assert rows(flt.filter_between(df, "k", 2, 3)) == rows(flt.filter_between(df, "k", 2, 3, spelled_out=True)) == [(2,), (3,)]


def test_set_operations_drop_repeats(spark, rows):
    a, b = ids(spark, [1, 1, 2, 2, None, None]), ids(spark, [2, 3])
    assert rows(st.except_distinct(a, b)) == [(None,), (1,)]
    assert rows(st.intersect_distinct(a, b)) == [(2,)]


def test_age_bands(spark, rows):
    df = spark.createDataFrame([(a,) for a in ("17", "18", "61", "-5", "drf", "2a", "60")], "a string")
    assert rows(tj.age_band_counts(df, "a")) == [("0-17", 1), ("18-59", 1), ("not a number", 2), ("other", 2), ("over 60", 1)]


def test_words(spark, rows):
    df = spark.createDataFrame([("Salas Shalas alanala",)], "t string")
    assert rows(tj.palindrome_words(df, "t")) == [("alanala", 1), ("salas", 1)]
    word = spark.createDataFrame([("w", "Use-case")], "k string, t string")
    assert rows(tj.letter_structure(word, "t", "k")) == [("w", 4, 3)]


def test_json_contract(spark, rows):
    bodies = ['{bad', '{}', '{"k": null}', '{"k": ""}', '{"k": "v", "l": 1}', '[1, 2]']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    report = dict((r[0], r[1:]) for r in rows(ct.json_contract_report(df, ct.contract_rules("body", ["k"], {"k": "v"}))))
    assert report["is_json"] == (5, 1) and report["has_fields"] == (3, 3)
    assert report["not_null"] == (2, 4) and report["not_empty"] == (1, 5) and report["equals_k"] == (1, 5)


def test_json_schema(spark, rows):
    bodies = ['{bad', '{"n": "a", "f": ["x"]}', '{"n": "a", "f": []}', '{"n": 1, "f": [1]}', '{"f": ["x", 2]}', '[1]', '{"n": null, "f": null}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    done = {r[0]: r[1] for r in ct.json_schema_check(df, "body", {"n": "string", "f": "array<string>"}).collect()}
    assert done == {
        bodies[0]: ["not an object"], bodies[1]: [], bodies[2]: [], bodies[3]: ["n", "f"], bodies[4]: ["n", "f"],
        bodies[5]: ["not an object"], bodies[6]: ["n", "f"],
    }


def test_json_exact_body(spark, rows):
    expected = {"meta": {"status": 200, "errors": []}, "data": "Task successfully removed"}
    bodies = {
        '{"data":"Task successfully removed", "meta": {"errors": [ ], "status":200}}': True,
        '{"meta": {"status": 200, "errors": []}, "data": "Task"}': False,
        '{"meta": {"status": 200, "errors": []}, "data": "Task successfully removed", "x": 1}': False,
        '{"meta": {"status": 200}, "data": "Task successfully removed"}': False,
        '{bad': False,
    }
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r[0]: r[1] for r in ct.json_exact_body(df, "body", expected).collect()} == bodies


def test_status_flow(spark, rows):
    data = [(1, 1, "assigned"), (1, 2, "accepted"), (1, 3, "done"), (2, 1, "accepted"), (2, 2, "done"), (2, 3, "accepted")]
    df = spark.createDataFrame(data, "task bigint, at bigint, state string")
    allowed = [(None, "assigned"), ("assigned", "accepted"), ("accepted", "done")]
    assert rows(ct.status_flow_audit(df, "task", ["at"], "state", allowed)) == [(1, 3, 0), (2, 3, 2)]


def test_html_values(spark, rows):
    html = '<input title="Select (Ann Lee)" value="41"><input value="7" title="x"><inputs value="9"><input>'
    df = spark.createDataFrame([(1, html)], "id bigint, html string")
    assert rows(ct.html_attr_extract(df, "html", "input", "value", ["id"])) == [(1, 0, "41"), (1, 1, "7")]
    named = ct.html_attr_extract(df, "html", "input", "value", ["id"], match=("title", "Select (Ann Lee)"))
    assert rows(named) == [(1, 0, "41")]


def test_html_as_people_write_it(spark, rows):
    html = (
        "<a href='x'><A HREF=\"y\"><a title=\"a>b\" href=\"w\"><!-- <a href=\"no\"> --><a href=z><a title='href=\"t\"'>"
        "<script>s = '<a href=\"no\">'</script><abbr href=\"no\"><a\nhref = \"n\" href=\"second\">"
    )
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "id bigint, html string")
    found = ct.html_attr_extract(df, "html", "a", "href", ["id"])
    assert rows(found, "id", "position", "value") == [(1, 0, "x"), (1, 1, "y"), (1, 2, "w"), (1, 3, "z"), (1, 5, "n")]
    long = "<a " + "x=\"1\" " * 20_000 + 'href="end">'
    assert rows(ct.html_attr_extract(spark.createDataFrame([(1, long)], "id bigint, html string"), "html", "a", "href", ["id"])) == [(1, 0, "end")]


def test_two_lists_of_groups_that_both_have(spark, rows):
    one = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (None, "d")], "k bigint, x string")
    two = spark.createDataFrame([(1, "g"), (3, "h"), (None, "i")], "k bigint, y string")
    done = ag.concat_distinct_two(one, two, ["k"], ("x", "xs"), ("y", "ys"))
    assert rows(done, "k", "list", "pos", "name") == [
        (None, "xs", 1, "d"), (None, "ys", 1, "i"), (1, "xs", 1, "a"), (1, "xs", 2, "b"), (1, "ys", 1, "g")
    ]


def test_first_dates_that_are_null(spark, rows):
    df = spark.createDataFrame([(1, 10, None), (1, 11, "2020-01-01"), (2, 20, None), (3, 30, "2020-01-02"), (3, 31, "2020-01-01")], "k bigint, id bigint, d string")
    ranked = rk.rank_over_grouped_dates(df, "k", "d", "id")
    assert rows(ranked, "k", "id") == [(1, 10), (2, 20), (3, 31)]
    assert rows(ranked, "k", "id") == rows(rk.row_number_first_per_key(df, "k", ["d", "id"]), "k", "id")


@pytest.mark.parametrize("job", ["update", "upsert", "view"])
def test_repeated_keys_are_refused(spark, job):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id bigint, name string")
    done = {
        "update": lambda: md.update_from_join(base, twice, "id", {"name": "name"}),
        "upsert": lambda: md.upsert_rename_duplicate(base, twice, "id", "name"),
        "view": lambda: md.view_update_through(base, twice, {"name": F.col("new.name")}, "id"),
    }[job]()
    with pytest.raises(Exception, match="repeats"):
        done.collect()


def test_distinct_parts_by_bitmap(spark, rows):
    owners = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 9)], "o bigint, i bigint")
    parts = spark.createDataFrame([(1, 5), (1, 40_000), (2, 5), (2, 7), (2, 100_000)], "i bigint, p bigint")
    assert rows(ag.distinct_pairs_count(owners, parts, "o", "i", "p", 1)) == [(1, 4), (2, 3)]


def test_limit_counts_earlier_accepted_rows(spark, rows):
    stored = spark.createDataFrame([(1, "Y")] * 9 + [(2, "Y")] * 10, "person bigint, state string")
    batch = spark.createDataFrame(
        [(1, 1, "Y", True), (1, 2, "Y", True), (1, 3, "N", True), (2, 4, "N", True), (2, 5, "Y", False), (3, 6, "Y", True)],
        "person bigint, seq bigint, state string, ins boolean",
    )
    done = rl.rule_max_active(batch, stored, "person", "seq", F.col("state") == "Y", F.col("ins"))
    assert rows(rl.split(done)[0], "seq") == [(1,), (6,)]


def test_distinct_parts_travel_as_words(spark, rows):
    """Far numbers, negative ones, NULLs and both ends of a word; no column of an exchange is a map of some thousand bytes."""
    owners = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3), (None, 1), (4, None)], "o bigint, i bigint")
    parts = spark.createDataFrame([(1, 0), (1, 63), (1, 64), (1, -1), (2, -1), (2, 2**40), (2, None), (3, None), (None, 7)], "i bigint, p bigint")
    done = ag.distinct_pairs_count(owners, parts, "o", "i", "p", -1)
    assert rows(done) == [(None, 4), (1, 5), (2, 4), (3, 0)]
    assert "bitmap" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_groups_with_both_lists_are_found_by_hash_aggregates(spark, rows, monkeypatch):
    one = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "k string, x bigint")
    two = spark.createDataFrame([("a", 3), ("c", 3), (None, 3)], "k string, y bigint")
    seen = []
    whole = ag.ordered_list
    monkeypatch.setattr(ag, "ordered_list", lambda df, *a, **b: seen.append(df) or whole(df, *a, **b))
    done = ag.concat_distinct_two(one, two, ["k"], ("x", "xs"), ("y", "ys"))
    assert rows(done) == [(None, "xs", 1, 2), (None, "ys", 1, 3), ("a", "xs", 1, 1), ("a", "ys", 1, 3)]
    assert "min(list" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
