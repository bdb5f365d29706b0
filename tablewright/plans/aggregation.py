"""Queries: aggregates and ordered lists."""

from pyspark.sql import functions as F

from tablewright.operators import aggregates as ag
from tablewright.operators import lists as ls
from tablewright.plans.joining import LINKS, LOANS
from tablewright.plans.registry import query
from tablewright.sources.trial import AS_OF


def is_open():
    return F.col("o_orderstatus") == "O"


@query("SELECT count(*) AS total FROM part")
def count_rows(t):
    return ag.count_rows(t.part)


@query("SELECT count(o_custkey) AS in_use FROM orders WHERE o_orderstatus = 'O'")
def count_filtered(t):
    return ag.count_filtered(t.orders, "o_custkey", is_open())


@query("SELECT count(DISTINCT l_partkey) AS in_use FROM lineitem WHERE l_linestatus = 'O'")
def count_distinct_filtered(t):
    return ag.count_distinct_filtered(t.lineitem, "l_partkey", F.col("l_linestatus") == "O")


@query("""
SELECT CAST(sum(p_size) AS BIGINT) AS sum, min(p_size) AS min, max(p_size) AS max, round(avg(p_size), 6) AS avg FROM part
""")
def multi_aggregate(t):
    return ag.multi_aggregate(t.part, "p_size").withColumn("avg", F.round("avg", 6))


@query("SELECT round(avg(p_size), 6) AS average FROM part WHERE p_retailprice > 1000")
def scalar_average(t):
    return ag.scalar_average(t.part, "p_size", F.col("p_retailprice") > 1000).select(
        F.round("average", 6).alias("average")
    )


@query("SELECT CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders")
def min_max_dates(t):
    return ag.min_max_dates(t.dated_orders, "o_orderdate")


@query("SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey")
def group_count(t):
    return ag.group_count(t.orders, "o_custkey")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1")
def group_by_year(t):
    return ag.group_by_year(t.orders, "o_orderdate")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_custkey) AS persons FROM orders GROUP BY 1")
def group_by_year_distinct(t):
    return ag.group_by_year_distinct(t.orders, "o_orderdate", "o_custkey")


@query("""
SELECT 'Not returned' AS status, count(*) AS rows FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'Returned', count(*) FROM orders WHERE o_orderstatus <> 'O'
""")
def group_by_case(t):
    return ag.group_by_case(t.orders, is_open(), "Not returned", "Returned")


@query("""
SELECT maker, round(avg(p_size), 6) AS average
FROM (SELECT DISTINCT l_suppkey AS maker, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey
WHERE p_type = 'SMALL' GROUP BY maker
""")
def group_avg_joined(t):
    small = t.kind("SMALL").select(F.col("p_partkey").alias("model"), "p_size")
    return ag.group_avg_joined(t.makers, small, "model", "maker", "p_size").withColumn("average", F.round("average", 6))


@query("""
SELECT s_nationkey, max(l_extendedprice) AS highest FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_nationkey
""")
def group_max_joined(t):
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice")
    return ag.group_max_joined(t.supplier, lines, "s_suppkey", "s_nationkey", "l_extendedprice")


@query("SELECT p_size, round(avg(p_retailprice), 5) AS average FROM part WHERE p_size > 30 GROUP BY p_size")
def group_avg_filtered(t):
    return ag.group_avg_filtered(t.part, "p_size", "p_retailprice", 30).withColumn("average", F.round("average", 5))


@query(f"""
WITH {LINKS}
SELECT s_suppkey AS a_id, s_name AS a_name, CAST(sum(p_size) AS BIGINT) AS total
FROM supplier JOIN ba ON a_id = s_suppkey JOIN part ON b_id = p_partkey GROUP BY 1, 2
""")
def group_sum_m2m(t):
    return ag.group_sum_m2m(t.authors, t.book_authors, t.books, "a_id", "b_id", "b_quantity")


@query(f"""
WITH {LOANS}
SELECT c_custkey, c_name, count(*) AS rows FROM loans JOIN customer ON person = c_custkey
WHERE active AND finish < DATE '{AS_OF}' GROUP BY 1, 2
""")
def group_count_joined(t):
    overdue = t.loans.withColumnRenamed("person", "c_custkey")
    late = F.col("active") & (F.col("finish") < F.lit(AS_OF).cast("date"))
    return ag.group_count_joined(t.customer, overdue, "c_custkey", ["c_custkey", "c_name"], late)


@query("SELECT p_name, count(*) AS rows FROM part GROUP BY p_name HAVING count(*) >= 30")
def having_count(t):
    return ag.having_count(t.part, "p_name", 30)


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1)
""")
def in_groups_having(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return ag.in_groups_having(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey", F.col("size") == 1)


@query("""
SELECT round(avg(n), 6) AS average FROM
  (SELECT count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
""")
def avg_of_group_counts(t):
    average = ag.avg_of_group_counts(t.orders.filter(is_open()), "o_custkey", "o_orderpriority", distinct=True)
    return average.select(F.round("average", 6).alias("average"))


@query("""
SELECT round(avg(p_retailprice), 4) AS average
FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 1) JOIN part ON l_partkey = p_partkey
WHERE p_type IN ('PROMO', 'ECONOMY')
""")
def avg_over_union_all(t):
    by_first = t.makers.filter(F.col("maker") == 1).select(F.col("model").alias("p_partkey"))
    both = [t.kind(k).join(by_first, "p_partkey") for k in ("PROMO", "ECONOMY")]
    return ag.avg_over_union_all(both, "p_retailprice").select(F.round("average", 4).alias("average"))


@query(f"WITH {LOANS} SELECT round(avg(finish - start), 6) AS avg_days FROM loans WHERE NOT active AND finish >= start")
def avg_days_between(t):
    back = ~F.col("active") & (F.col("finish") >= F.col("start"))
    return ag.avg_days_between(t.loans, F.col("start"), F.col("finish"), back).select(
        F.round("avg_days", 6).alias("avg_days")
    )


@query(f"""
WITH {LOANS}, diffs AS (
  SELECT finish - start AS diff FROM loans
  WHERE (finish <= DATE '{AS_OF}' AND NOT active) OR (finish > DATE '{AS_OF}' AND active)
  UNION ALL
  SELECT DATE '{AS_OF}' - start FROM loans
  WHERE (finish <= DATE '{AS_OF}' AND active) OR (finish > DATE '{AS_OF}' AND NOT active))
SELECT round(avg(diff), 6) AS avg_days FROM diffs
""")
def avg_days_open_or_closed(t):
    mean = ag.avg_days_open_or_closed(t.loans, "start", "finish", F.col("active"), F.lit(AS_OF).cast("date"))
    return mean.select(F.round("avg_days", 6).alias("avg_days"))


@query("SELECT p_brand, CAST(avg(p_size ** 3 / 2) AS DECIMAL(12, 2)) AS mw FROM part GROUP BY p_brand")
def power_mean_decimal(t):
    return ag.power_mean_decimal(t.part, "p_brand", "p_size")


RATIOS = f"""
WITH {LOANS}
SELECT count(*) FILTER (WHERE active) / (SELECT count(*) FROM customer) AS books_taken,
  CAST(sum(finish - start) FILTER (WHERE NOT active) AS DOUBLE) / count(*) FILTER (WHERE NOT active) AS days_to_read,
  count(*) FILTER (WHERE NOT active) / (SELECT count(*) FROM customer) AS books_returned
FROM loans"""


@query(f"""
SELECT round(books_taken, 6) AS books_taken, round(days_to_read, 6) AS days_to_read,
  round(books_returned, 6) AS books_returned FROM ({RATIOS})
""")
def ratio_averages(t):
    ratios = ag.ratio_averages(t.customer, t.loans, F.col("active"), "start", "finish")
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


TOTALS = """
SELECT CAST(total AS BIGINT) AS total, given, CAST(total - given AS BIGINT) AS rest
FROM (SELECT sum(p_size) AS total FROM part), (SELECT count(*) AS given FROM lineitem WHERE l_linestatus = 'O')"""


@query(TOTALS)
def library_totals(t):
    return ag.library_totals(t.part, t.lineitem, "p_size", F.col("l_linestatus") == "O")


@query(f"""
WITH {LINKS}
SELECT a_id, max(n) AS most FROM
  (SELECT a_id, ba.b_id, count(*) AS n FROM ba JOIN bg ON ba.b_id = bg.b_id GROUP BY 1, 2 HAVING count(*) > 1)
GROUP BY a_id
""")
def max_of_group_counts(t):
    return ag.max_of_group_counts(t.book_authors, t.book_genres, "a_id", "b_id")


@query(f"""
WITH {LINKS}
SELECT a_id, count(DISTINCT g_id) AS items FROM ba JOIN bg ON ba.b_id = bg.b_id GROUP BY a_id HAVING count(DISTINCT g_id) > 1
""")
def distinct_pairs_count(t):
    return ag.distinct_pairs_count(t.book_authors, t.book_genres, "a_id", "b_id", "g_id", 1)


def list_sql(source: str, keys: str, name: str, out: str = "name") -> str:
    """SQL of an ordered list: names numbered per group."""
    return f"SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY {name}) AS pos, {name} AS {out} FROM {source}"


@query(f"""
WITH {LINKS}, x AS (SELECT b_id, s_name FROM ba JOIN supplier ON a_id = s_suppkey)
{list_sql('x', 'b_id', 's_name')}
""")
def concat_ordered(t):
    return ls.concat_ordered(t.book_authors.join(t.authors, "a_id"), ["b_id"], "a_name")


@query(f"""
WITH {LINKS}, pairs AS (SELECT DISTINCT ba.b_id, s_name, n_name FROM ba JOIN bg ON ba.b_id = bg.b_id
  JOIN supplier ON a_id = s_suppkey JOIN nation ON g_id = n_nationkey),
 named AS (SELECT DISTINCT b_id, 'authors' AS list, s_name AS name FROM pairs
   UNION ALL SELECT DISTINCT b_id, 'genres', n_name FROM pairs)
{list_sql('named', 'b_id, list', 'name')}
""")
def concat_distinct_two(t):
    return ag.concat_distinct_two(
        t.book_authors.join(t.authors, "a_id"), t.book_genres.join(t.genres, "g_id"),
        ["b_id"], ("a_name", "authors"), ("g_name", "genres"),
    )


@query(f"""
WITH {LINKS}, pairs AS (SELECT a_id, p_name, n_name FROM ba JOIN part ON ba.b_id = p_partkey
  JOIN bg ON ba.b_id = bg.b_id JOIN nation ON g_id = n_nationkey),
 named AS (SELECT DISTINCT a_id, 'books' AS list, p_name AS name FROM pairs
   UNION ALL SELECT DISTINCT a_id, 'genres', n_name FROM pairs)
{list_sql('named', 'a_id, list', 'name')}
""")
def concat_distinct_two_by_author(t):
    """Authors with their books and the genres of those books."""
    books = t.book_authors.join(t.books, "b_id")
    genres = t.book_authors.join(t.book_genres, "b_id").select("a_id", "g_id").distinct().join(t.genres, "g_id")
    return ag.concat_distinct_two(books, genres, ["a_id"], ("b_name", "books"), ("g_name", "genres"))


@query(f"""
WITH {LINKS}, x AS (SELECT DISTINCT b_id, n_name FROM bg JOIN nation ON g_id = n_nationkey)
{list_sql('x', 'b_id', 'n_name')}
""")
def concat_default_separator(t):
    return ls.concat_default_separator(t.book_genres.join(t.genres, "g_id"), ["b_id"], "g_name")


@query("SELECT CAST(median(n) AS DOUBLE) AS median FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def median_of_counts(t):
    return ag.median_of_counts(t.lineitem, "l_suppkey")


@query("SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey ORDER BY rows DESC, o_custkey LIMIT 1")
def champion_argmax(t):
    return ag.champion_argmax(t.orders, "o_custkey")
