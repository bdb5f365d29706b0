"""Queries: projections, filters, predicates."""

from pyspark.sql import functions as F

from tablewright.operators import filters as flt
from tablewright.operators import joins as jn
from tablewright.operators import projection as pj
from tablewright.plans.registry import query


@query("SELECT p_partkey, p_name, p_type FROM part")
def project_columns(t):
    return pj.project_columns(t.part, ["p_partkey", "p_name", "p_type"])


@query("""
SELECT p_partkey, p_name, p_size - coalesce(n, 0) AS real_count
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_partkey) x
  ON x.l_partkey = part.p_partkey
""")
def project_arithmetic(t):
    taken = (
        t.lineitem.filter(F.col("l_linestatus") == "O")
        .groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("taken"))
    )
    shelf = t.part.select("p_partkey", "p_name", "p_size").join(taken, "p_partkey", "left")
    return pj.project_arithmetic(shelf, "p_size", "taken").select("p_partkey", "p_name", "real_count")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Not returned' ELSE 'Returned' END AS status FROM orders
""")
def project_case(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return pj.project_case(rows, F.col("o_orderstatus") == "O", "Not returned", "Returned").drop("o_orderstatus")


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
""")
def mask_columns(t):
    return pj.mask_columns(t.dated_orders, ["o_custkey"])


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_single(t):
    return pj.distinct_single(t.orders, "o_custkey")


@query("""
SELECT DISTINCT l_suppkey, p_size FROM lineitem, part WHERE l_partkey = p_partkey AND p_size >= 25
""")
def distinct_rows(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return pj.distinct_rows(lines, t.part, "p_partkey", ["l_suppkey", "p_size"], F.col("p_size") >= 25)


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice < 950")
def filter_compare(t):
    return flt.filter_compare(t.part, "p_retailprice", "<", 950).select("p_partkey", "p_name", "p_retailprice")


@query("""
SELECT p_partkey, p_type, p_size FROM part
WHERE p_retailprice < 1000 AND p_type IN ('PROMO', 'SMALL')
""")
def filter_and_or(t):
    cheap = F.col("p_retailprice") < 1000
    kept = flt.filter_and_or(
        t.part, [(F.col("p_type") == "PROMO") & cheap, (F.col("p_type") == "SMALL") & cheap]
    )
    return kept.select("p_partkey", "p_type", "p_size")


@query("""
SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice >= 950
""")
def filter_between(t):
    kept = flt.filter_between(t.part, "p_size", 10, 20, F.col("p_retailprice") >= 950)
    return kept.select("p_partkey", "p_size", "p_retailprice")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderdate >= '1997-06-01' AND o_orderdate < '1997-09-01'
""")
def filter_date_range(t):
    kept = flt.filter_date_range(t.orders, "o_orderdate", "1997-06-01", "1997-09-01")
    return kept.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE CAST(o_orderdate AS DATE) IN (DATE '1996-02-09', DATE '1998-12-31', DATE '2000-02-29')
""")
def filter_in_list(t):
    kept = flt.filter_in_list(t.orders, "o_orderdate", ["1996-02-09", "1998-12-31", "2000-02-29"])
    return kept.select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def filter_not_null(t):
    rows = jn.left_outer_join(
        t.orders.select("o_orderkey"), t.lineitem.select("l_orderkey", "l_linenumber"), "o_orderkey", "l_orderkey"
    )
    return flt.filter_not_null(rows, "l_linenumber").select("o_orderkey", "l_linenumber")


@query("""
SELECT c_custkey, kind, value FROM (
  SELECT c_custkey, 'key' AS kind, CAST(c_custkey AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'name', c_name FROM customer)
WHERE regexp_full_match(value, '[0-9]*') OR regexp_full_match(value, '[A-Za-z]*')
""")
def filter_char_class(t):
    texts = t.customer.selectExpr(
        "c_custkey",
        "stack(3, 'key', cast(c_custkey as string), 'segment', c_mktsegment, 'name', c_name) as (kind, value)",
    )
    return flt.filter_char_class(texts, "value")


@query("SELECT p_partkey, p_type FROM part WHERE upper(p_type) = 'PROMO'")
def filter_ci_equals(t):
    return flt.filter_ci_equals(t.part, "p_type", "Promo").select("p_partkey", "p_type")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE year(o_orderdate) <= (SELECT min(year(o_orderdate)) FROM orders)
""")
def filter_year_upto_first(t):
    kept = flt.filter_year_upto_first(t.orders, "o_orderdate")
    return kept.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


@query("SELECT p_partkey, p_size FROM part WHERE p_size < (SELECT avg(p_size) FROM part)")
def filter_below_average(t):
    return flt.filter_below_average(t.part.select("p_partkey", "p_size"), "p_size")


@query("SELECT doc_id, source FROM documents WHERE contains(text, 'license')")
def filter_contains(t):
    return flt.filter_contains(t.documents, "text", "license").select("doc_id", "source")
