"""Queries: joins and subquery forms."""

from pyspark.sql import functions as F

from tablewright.operators import joins as jn
from tablewright.plans.registry import query

LOANS = """
loans AS (SELECT l_orderkey, l_linenumber, o_custkey AS person, l_partkey AS book, l_suppkey AS author,
    CAST(o_orderdate AS DATE) AS start, CAST(l_shipdate AS DATE) AS finish, l_linestatus = 'O' AS active
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LINKS = """
ba AS (SELECT DISTINCT l_partkey AS b_id, l_suppkey AS a_id FROM lineitem),
bg AS (SELECT DISTINCT b_id, s_nationkey AS g_id FROM ba JOIN supplier ON a_id = s_suppkey)"""


@query(f"""
WITH {LINKS}, br AS (SELECT DISTINCT b_id, n_regionkey AS r_id FROM bg JOIN nation ON g_id = n_nationkey)
SELECT p_name AS b_name, s_name AS a_name, r_name AS g_name
FROM part, ba, supplier, br, region
WHERE p_partkey = ba.b_id AND ba.a_id = s_suppkey AND p_partkey = br.b_id AND br.r_id = r_regionkey
""")
def inner_join_using_chain(t):
    # the genre of a book is here the region of a supplier: at most five per book
    regions = t.nation.select(F.col("n_nationkey").alias("g_id"), F.col("n_regionkey").alias("r_regionkey"))
    book_regions = t.book_genres.join(regions, "g_id").select("b_id", "r_regionkey").distinct()
    joined = jn.inner_join_using_chain(
        t.books.select("b_id", "b_name"),
        [(t.book_authors, "b_id"), (t.authors, "a_id"), (book_regions, "b_id"), (t.region, "r_regionkey")],
    )
    return joined.select("b_name", "a_name", F.col("r_name").alias("g_name"))


@query("""
SELECT c_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate
FROM customer JOIN orders ON o_custkey = c_custkey
""")
def inner_join_on(t):
    return jn.inner_join_on(t.customer, t.dated_orders, "c_custkey", "o_custkey").select(
        "c_custkey", "c_name", "o_orderkey", "o_orderdate"
    )


@query("""
SELECT p_name, l_orderkey, l_linenumber, l_quantity FROM part, lineitem
WHERE p_partkey = l_partkey AND p_size >= 45 AND l_quantity > 25
""")
def inner_join_comma(t):
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    joined = jn.inner_join_comma(
        t.part, lines, "p_partkey", "l_partkey", (F.col("p_size") >= 45) & (F.col("l_quantity") > 25)
    )
    return joined.select("p_name", "l_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT o_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def left_outer_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    return jn.left_outer_join(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey").drop("l_orderkey")


LEDGER = """
WITH i AS (SELECT user_id AS point, CAST(ts AS DATE) AS day, sum(value) AS inc FROM events
           WHERE event_type = 'purchase' GROUP BY ALL),
     o AS (SELECT user_id AS point, CAST(ts AS DATE) AS day, sum(value) AS out FROM events
           WHERE event_type = 'error' GROUP BY ALL)"""


@query(f"""{LEDGER}
SELECT i.point, i.day, round(inc, 2) AS inc, round(out, 2) AS out FROM i LEFT JOIN o ON i.point = o.point AND i.day = o.day
UNION
SELECT o.point, o.day, round(inc, 2), round(out, 2) FROM i RIGHT JOIN o ON i.point = o.point AND i.day = o.day
""")
def full_outer_ledger(t):
    inc = t.ledger_rows("purchase", "inc").groupBy("point", "day").agg(F.round(F.sum("inc"), 2).alias("inc"))
    out = t.ledger_rows("error", "out").groupBy("point", "day").agg(F.round(F.sum("out"), 2).alias("out"))
    return jn.full_outer_ledger(inc, out, ["point", "day"])


@query("""
SELECT user_id AS point, CAST(ts AS DATE) AS day,
  round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS inc,
  round(sum(value) FILTER (WHERE event_type = 'error'), 2) AS out
FROM events WHERE event_type IN ('purchase', 'error') GROUP BY ALL
""")
def full_outer_daily_totals(t):
    totals = jn.full_outer_daily_totals(
        t.ledger_rows("purchase", "inc"), t.ledger_rows("error", "out"), ["point", "day"]
    )
    return totals.select("point", "day", F.round("inc", 2).alias("inc"), F.round("out", 2).alias("out"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def semi_join_in(t):
    return jn.semi_join_in(t.customer, t.orders, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("""
SELECT p_partkey AS b_id, p_name AS b_name FROM part WHERE p_partkey IN (
  SELECT l_partkey FROM lineitem WHERE l_suppkey IN (
    SELECT s_suppkey FROM supplier WHERE s_name IN ('Supplier#000000002', 'Supplier#000000005')))
""")
def semi_join_nested(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("b_id"), F.col("l_suppkey").alias("a_id"))
    named = F.col("a_name").isin("Supplier#000000002", "Supplier#000000005")
    return jn.semi_join_nested(t.books.select("b_id", "b_name"), lines, t.authors, ("b_id", "a_id"), named)


@query("""
SELECT DISTINCT p_partkey AS b_id, p_name AS b_name FROM part JOIN lineitem ON l_partkey = p_partkey
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (2, 5))
""")
def semi_join_then_join(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("b_id"), F.col("l_suppkey").alias("a_id"))
    wanted = t.supplier.filter(F.col("s_nationkey").isin(2, 5)).select(F.col("s_suppkey").alias("a_id"))
    return jn.semi_join_then_join(t.books.select("b_id", "b_name"), lines, ("b_id", "a_id"), wanted)


@query("""
SELECT DISTINCT l_suppkey AS maker FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type = 'PROMO' AND p_size >= 49
  AND l_suppkey IN (SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey
                    WHERE p_type = 'ECONOMY' AND p_size >= 49)
""")
def semi_join_intersection(t):
    def makers_of(kind):
        big = t.kind(kind).filter(F.col("p_size") >= 49).select(F.col("p_partkey").alias("model"))
        return t.makers.join(big, "model")

    return jn.semi_join_intersection(makers_of("PROMO"), makers_of("ECONOMY"), "maker")


@query("SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def anti_join_null_filter(t):
    return jn.anti_join_null_filter(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_not_in(t):
    return jn.anti_join_not_in(t.documents.select("doc_id", "lang"), t.labels, "doc_id", "doc_id")


@query("""
SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_name HAVING count(CASE WHEN o_orderstatus = 'O' THEN 1 END) = 0
""")
def anti_join_conditional_count(t):
    return jn.anti_join_conditional_count(
        t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "O"
    )


@query("SELECT CAST(-1 AS BIGINT) AS empty_key WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = -1)")
def not_exists_guard(t):
    return jn.not_exists_guard(t.lineitem, "l_orderkey", -1)


@query("""
SELECT CAST(count(*) > 0 AS BIGINT) AS error_exists FROM part
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_partkey) x
  ON l_partkey = p_partkey
WHERE p_size - coalesce(n, 0) < 0
""")
def exists_flag(t):
    shelf = jn.correlated_count(
        t.part.select("p_partkey", "p_size"), t.lineitem, "p_partkey", "l_partkey", F.col("l_linestatus") == "O"
    )
    return jn.exists_flag(shelf, F.col("p_size") - F.col("taken") < 0)


@query("""
WITH pairs AS (SELECT a.p_partkey AS hi, b.p_partkey AS lo, a.p_brand, a.p_size FROM part a JOIN part b
     ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey > b.p_partkey),
 g AS (SELECT p_brand, p_size, min(lo) AS first_id, count(*) AS pairs FROM pairs GROUP BY p_brand, p_size)
SELECT p_partkey, part.p_brand, part.p_size, first_id,
  count(*) OVER (PARTITION BY part.p_brand, part.p_size) AS members, pairs
FROM part JOIN g ON part.p_brand = g.p_brand AND part.p_size = g.p_size
""")
def self_join_pairs(t):
    return jn.self_join_pairs(t.part, "p_partkey", ["p_brand", "p_size"])


@query(f"""
WITH {LOANS},
 shelf AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part WHERE p_size <= 25),
 free AS (SELECT c_custkey, pos FROM customer, shelf
          EXCEPT SELECT person, pos FROM loans JOIN shelf ON book = p_partkey),
 runs AS (SELECT c_custkey, pos, pos - row_number() OVER (PARTITION BY c_custkey ORDER BY pos) AS run FROM free)
SELECT c_custkey, min(p_partkey) AS from_key, max(p_partkey) AS to_key, count(*) AS pairs
FROM runs JOIN shelf USING (pos) GROUP BY c_custkey, run
""")
def cross_anti_pairs(t):
    used = t.loans.select(F.col("person").alias("c_custkey"), F.col("book").alias("p_partkey"))
    return jn.cross_anti_pairs(t.customer, t.part, used, "c_custkey", "p_partkey", F.col("p_size") <= 25)


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)
  AND 1 = (SELECT count(*) FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders))
""")
def greater_than_all(t):
    return jn.greater_than_all(t.orders, "o_orderkey", "o_totalprice")


@query("""
SELECT p_partkey, p_retailprice FROM part
WHERE p_type = 'ECONOMY' AND p_retailprice < ALL (SELECT p_retailprice FROM part WHERE p_type = 'PROMO')
""")
def less_than_all(t):
    return jn.less_than_all(t.kind("ECONOMY"), t.kind("PROMO"), "p_retailprice").select("p_partkey", "p_retailprice")


@query("""
SELECT p_partkey, p_name,
  (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'O') AS taken FROM part
""")
def correlated_count(t):
    return jn.correlated_count(
        t.part.select("p_partkey", "p_name"), t.lineitem, "p_partkey", "l_partkey", F.col("l_linestatus") == "O"
    )


@query("""
SELECT l_orderkey, lead(l_orderkey) OVER (ORDER BY l_orderkey) - 1 AS stop
FROM (SELECT DISTINCT l_orderkey FROM lineitem)
""")
def correlated_next_key(t):
    return jn.correlated_next_key(t.lineitem, "l_orderkey")


@query("""
SELECT DISTINCT a.l_orderkey + 1 AS empty_key FROM lineitem a
LEFT JOIN lineitem b ON a.l_orderkey + 1 = b.l_orderkey WHERE b.l_orderkey IS NULL
""")
def shifted_self_join(t):
    return jn.shifted_self_join(t.lineitem, "l_orderkey")


@query("""
SELECT o.o_custkey, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS o_orderdate FROM orders o
JOIN (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY o_custkey) f
  ON f.o_custkey = o.o_custkey AND f.first = o.o_orderdate
""")
def composite_key_join(t):
    return jn.composite_key_join(
        t.dated_orders.select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate"
    )


@query("""
SELECT l_partkey AS b_id FROM lineitem WHERE l_suppkey = 1
INTERSECT SELECT l_partkey FROM lineitem WHERE l_suppkey = 2
""")
def relational_division(t):
    return jn.relational_division(t.book_authors, "b_id", "a_id", [1, 2])


@query("""
SELECT n_nationkey, n_name, count(s_suppkey) AS matches FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
GROUP BY n_nationkey, n_name
""")
def left_join_zero_preserving_count(t):
    return jn.left_join_zero_preserving_count(
        t.nation.select("n_nationkey", "n_name"), t.supplier, "n_nationkey", "s_nationkey"
    )


@query("""
WITH fleet AS (SELECT o_orderkey AS name, o_custkey AS class FROM orders WHERE o_orderstatus = 'O')
SELECT c_custkey, c_mktsegment, name FROM customer LEFT JOIN fleet ON class = c_custkey
UNION ALL
SELECT DISTINCT c_custkey, c_mktsegment, l_orderkey FROM customer JOIN lineitem ON l_orderkey = c_custkey
WHERE l_orderkey NOT IN (SELECT name FROM fleet)
""")
def join_unmatched_parent_union(t):
    return jn.join_unmatched_parent_union(
        t.customer.select("c_custkey", "c_mktsegment"),
        t.orders.filter(F.col("o_orderstatus") == "O"),
        t.lineitem, "c_custkey", "o_orderkey", "o_custkey", "l_orderkey",
    )
