"""Queries: ranks, first rows, sorts, extremes."""

from pyspark.sql import functions as F

from tablewright.operators import ranking as rk
from tablewright.operators.joins import left_outer_join
from tablewright.plans.aggregation import list_sql
from tablewright.plans.joining import LOANS
from tablewright.plans.registry import query


@query("SELECT p_partkey, p_name, p_size FROM (SELECT *, rank() OVER (ORDER BY p_size DESC) AS r FROM part) WHERE r = 1")
def rank_ties_first(t):
    return rk.rank_ties_first(t.part.select("p_partkey", "p_name", "p_size"), "p_size")


@query("""
SELECT s_suppkey, s_name, rows FROM (
  SELECT s_suppkey, s_name, count(l_suppkey) AS rows, rank() OVER (ORDER BY count(l_suppkey) DESC) AS r
  FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name) WHERE r = 1
""")
def rank_over_aggregate(t):
    # known keys only, as the join below asks for: so the counts and their maximum share one shuffle
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey")).filter(F.col("s_suppkey").isNotNull())
    best = rk.rank_over_aggregate(lines, "s_suppkey")
    return t.supplier.select("s_suppkey", "s_name").join(best, "s_suppkey")


@query("""
WITH ranked AS (SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS r FROM orders)
SELECT o_orderkey, o_totalprice FROM ranked WHERE r = 1 AND (SELECT count(*) FROM ranked WHERE r = 1) = 1
""")
def rank_unique_winner(t):
    return rk.rank_unique_winner(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


FIRST_ORDERS = """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""


def _short_orders(t):
    return t.dated_orders.select("o_custkey", "o_orderkey", "o_orderdate")


@query(FIRST_ORDERS)
def row_number_first_per_key(t):
    return rk.row_number_first_per_key(_short_orders(t), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(FIRST_ORDERS)
def rank_over_grouped_dates(t):
    return rk.rank_over_grouped_dates(_short_orders(t), "o_custkey", "o_orderdate", "o_orderkey")


@query("""
SELECT CAST((SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name) AS BIGINT) AS s_suppkey,
  c_name AS s_name, c_nationkey AS s_nationkey FROM customer
""")
def surrogate_keys(t):
    new = t.customer.select(
        F.lit(None).cast("bigint").alias("s_suppkey"),
        F.col("c_name").alias("s_name"), F.col("c_nationkey").alias("s_nationkey"),
    )
    return rk.surrogate_keys(new, t.supplier, "s_suppkey", ["s_name"])


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size")
def sort_asc(t):
    return rk.sort_asc(t.part.select("p_partkey", "p_size"), "p_size", ["p_partkey"])


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name DESC")
def sort_desc(t):
    return rk.sort_desc(t.part.select("p_partkey", "p_name"), "p_name", ["p_partkey"])


@query("""
SELECT c_custkey, c_name, CAST(o_orderdate AS DATE) AS o_orderdate
FROM customer LEFT JOIN orders ON o_custkey = c_custkey ORDER BY c_custkey, o_orderdate
""")
def sort_multi_key(t):
    visits = left_outer_join(t.customer, t.dated_orders, "c_custkey", "o_custkey")
    return rk.sort_multi_key(visits.select("c_custkey", "c_name", "o_orderdate"), ["c_custkey", "o_orderdate"])


@query("SELECT p_partkey, p_name, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 1")
def top_1(t):
    return rk.top_1(t.part.select("p_partkey", "p_name", "p_size"), "p_size", "p_partkey")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey = (SELECT o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
""")
def top_1_lookup(t):
    return rk.top_1_lookup(
        t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey",
        ["o_orderdate", "o_orderkey"], desc=True,
    )


@query("""
WITH n AS (SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey)
SELECT o_custkey, rows FROM n WHERE rows = (SELECT max(rows) FROM n)
""")
def max_rows_all_ties(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("rows"))
    return rk.max_rows_all_ties(counts, "rows")


@query(f"""
WITH {LOANS}, d AS (SELECT DISTINCT person, finish - start AS days FROM loans WHERE NOT active AND finish >= start)
SELECT c_custkey, c_name, days FROM d JOIN customer ON person = c_custkey WHERE days = (SELECT min(days) FROM d)
""")
def min_rows_all_ties(t):
    spans = t.loans.select(
        F.col("person").alias("c_custkey"), F.datediff("finish", "start").cast("bigint").alias("days"), "active"
    ).filter(~F.col("active") & (F.col("days") >= 0) & F.col("c_custkey").isNotNull())
    # least per person first: rows and overall minimum then come from the same shuffle
    per_person = spans.groupBy("c_custkey").agg(F.min("days").alias("days"))
    least = rk.min_rows_all_ties(per_person, "days")
    return t.customer.select("c_custkey", "c_name").join(least, "c_custkey")


@query(FIRST_ORDERS)
def first_row_per_key_joins(t):
    return rk.first_row_per_key_joins(_short_orders(t), "o_custkey", "o_orderdate", "o_orderkey")


@query(f"""
WITH {LOANS}, x AS (SELECT person, p_name FROM loans JOIN part ON book = p_partkey
  WHERE (person, start) IN (SELECT person, min(start) FROM loans GROUP BY person))
{list_sql('x', 'person', 'p_name')}
""")
def first_visit_list(t):
    taken = t.loans.select("person", "start", F.col("book").alias("b_id"))
    return rk.first_visit_list(taken, "person", "start", "b_id", t.books, "b_name")


@query("""
WITH pc AS (SELECT * FROM part WHERE p_type = 'PROMO'),
 least AS (SELECT * FROM pc WHERE p_size = (SELECT min(p_size) FROM pc))
SELECT DISTINCT l_suppkey AS maker FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM least WHERE p_retailprice = (SELECT max(p_retailprice) FROM least))
""")
def extreme_of_extreme(t):
    models = t.kind("PROMO").withColumnRenamed("p_partkey", "model")
    return rk.extreme_of_extreme(models, "p_size", "p_retailprice", t.makers, "model", "maker")
