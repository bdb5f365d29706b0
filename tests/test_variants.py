"""Several spellings of one question give one answer."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggregates as ag
from tablewright.operators import joins as jn
from tablewright.operators import ranking as rk
from tablewright.plans.catalog import REGISTRY
from tablewright.sources.trial import AS_OF, Trial

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Trial(spark, SF)


def same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_largest(t):
    part = t.part.select("p_partkey", "p_size")
    assert same(rk.max_rows_all_ties(part, "p_size"), rk.rank_ties_first(part, "p_size"))


def test_unique_winner(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    assert same(jn.greater_than_all(orders, "o_orderkey", "o_totalprice"), rk.rank_unique_winner(orders, "o_totalprice"))


def test_first_order_three_ways(spark):
    ways = ["row_number_first_per_key", "rank_over_grouped_dates", "first_row_per_key_joins"]
    found = [REGISTRY[w].run(spark, SF) for w in ways]
    assert same(found[0], found[1]) and same(found[0], found[2])


def test_most_popular(t):
    counts = jn.left_join_zero_preserving_count(t.supplier.select("s_suppkey"), t.lineitem, "s_suppkey", "l_suppkey", "rows")
    best = rk.rank_over_aggregate(t.lineitem.select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey")
    assert same(rk.max_rows_all_ties(counts, "rows"), best)


def test_copies_left(t, spark):
    counted = jn.correlated_count(
        t.part.select("p_partkey", "p_name", "p_size"), t.lineitem, "p_partkey", "l_partkey", F.col("l_linestatus") == "O"
    ).select("p_partkey", "p_name", (F.col("p_size") - F.col("taken")).alias("real_count"))
    assert same(counted, REGISTRY["project_arithmetic"].run(spark, SF))
    t.part.createOrReplaceTempView("part")
    t.lineitem.createOrReplaceTempView("lineitem")
    correlated = spark.sql("""
        SELECT p_partkey, p_name, p_size - (SELECT count(*) FROM lineitem
          WHERE l_partkey = p_partkey AND l_linestatus = 'O') AS real_count FROM part""")
    assert same(counted, correlated)


def test_open_or_closed_as_union(t):
    as_of = F.lit(AS_OF).cast("date")
    due, active = F.col("finish") <= as_of, F.col("active")
    agreed = t.loans.filter((due & ~active) | (~due & active)).select(F.datediff("finish", "start").alias("d"))
    other = t.loans.filter((due & active) | (~due & ~active)).select(F.datediff(as_of, F.col("start")).alias("d"))
    one = ag.avg_days_open_or_closed(t.loans, "start", "finish", active, as_of).first()[0]
    assert one == pytest.approx(ag.avg_over_union_all([agreed, other], "d").first()[0])


def test_ledger_as_left_and_right_join(t, spark):
    full = REGISTRY["full_outer_ledger"].run(spark, SF)
    inc = t.ledger_rows("purchase", "inc").groupBy("point", "day").agg(F.round(F.sum("inc"), 2).alias("inc"))
    out = t.ledger_rows("error", "out").groupBy("point", "day").agg(F.round(F.sum("out"), 2).alias("out"))
    both = inc.join(out, ["point", "day"], "left").unionByName(inc.join(out, ["point", "day"], "right")).distinct()
    assert same(full, both)


def test_semi_join_and_in(t, spark):
    nested = REGISTRY["semi_join_nested"].run(spark, SF)
    named = t.authors.filter(F.col("a_name").isin("Supplier#000000002", "Supplier#000000005")).select("a_id")
    joined = jn.semi_join_then_join(t.books.select("b_id", "b_name"), t.book_authors, ("b_id", "a_id"), named)
    assert same(nested, joined)


def test_never_used_three_ways(t, spark):
    orders = t.orders.select("o_orderkey")
    anti = jn.anti_join_null_filter(orders, t.lineitem, "o_orderkey", "l_orderkey")
    assert same(anti, jn.anti_join_not_in(orders, t.lineitem, "o_orderkey", "l_orderkey"))
    assert same(anti, jn.anti_join_conditional_count(orders, t.lineitem, "o_orderkey", "l_orderkey", F.lit(True)))
