"""Queries: scalar functions, stored functions, key jobs."""

from pyspark.sql import functions as F

from tablewright.functions import dates as dt
from tablewright.functions.text import NAME_PATTERN, fn_check_name as check_name
from tablewright.operators import aggregates as ag
from tablewright.operators import keys as ky
from tablewright.operators import scalar_views as sv
from tablewright.plans.joining import LOANS
from tablewright.plans.registry import query
from tablewright.sources import snapshots
from tablewright.sources.scratch import scratch_path
from tablewright.sources.trial import AS_OF


def _dated_loans(t):
    return t.loans.select("l_orderkey", "l_linenumber", "start", "finish")


@query(f"WITH {LOANS} SELECT l_orderkey, l_linenumber, start || ' - ' || finish AS dates FROM loans")
def str_concat_dates(t):
    return sv.str_concat_dates(_dated_loans(t), "start", "finish").drop("start", "finish")


@query(f"WITH {LOANS} SELECT l_orderkey, l_linenumber, start, finish FROM loans")
def str_split_dates(t):
    joined = sv.str_concat_dates(_dated_loans(t), "start", "finish").drop("start", "finish")
    return sv.str_split_dates(joined, "dates").drop("dates")


@query("SELECT c_custkey, upper(c_name) AS c_name FROM customer")
def str_upper(t):
    return sv.str_upper(t.customer.select("c_custkey", "c_name"), "c_name")


def _order_dates(t):
    return t.dated_orders.select("o_orderkey", "o_orderdate")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' - ' || dayname(o_orderdate) AS start_dw FROM orders
""")
def date_weekday_text(t):
    return sv.date_weekday_text(_order_dates(t), "o_orderdate", "start_dw").drop("o_orderdate")


@query("SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate FROM orders")
def date_to_unix(t):
    return sv.date_to_unix(_order_dates(t), "o_orderdate")


@query("SELECT o_orderkey, CAST(epoch(o_orderdate + INTERVAL 3 HOUR) AS BIGINT) AS o_orderdate FROM orders")
def date_to_unix_tz(t):
    return sv.date_to_unix_tz(_order_dates(t), "o_orderdate")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders
""")
def date_parts(t):
    return sv.date_parts(_order_dates(t), "o_orderdate")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS registered FROM orders
WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-10-09', DATE '1996-10-10')
""")
def date_parse_dmy(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("registered"))
    return sv.date_parse_dmy(text, "registered", ["1995-10-09", "1996-10-10"])


@query("""
SELECT c_custkey, '{"name":"' || c_name || '","nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}' AS text,
  c_name AS name FROM customer
""")
def json_canonical_text(t):
    cards = t.customer.select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
        ).alias("card"),
    )
    return sv.json_canonical_text(cards, "card").select("c_custkey", "text", F.col("parsed.name").alias("name"))


@query(f"""
WITH {LOANS}
SELECT l_orderkey, l_linenumber, (finish - start) || CASE WHEN finish - start < 10 THEN ' OK'
  WHEN finish - start BETWEEN 10 AND 30 THEN ' NOTICE' ELSE ' WARNING' END AS status FROM loans
""")
def fn_duration_status(t):
    return _dated_loans(t).select(
        "l_orderkey", "l_linenumber", dt.fn_duration_status(F.col("start"), F.col("finish")).alias("status")
    )


@query(f"""
WITH {LOANS}
SELECT l_orderkey, l_linenumber, CASE WHEN finish < start THEN -3 WHEN finish < DATE '{AS_OF}' AND active THEN -2
  WHEN start > DATE '{AS_OF}' THEN -1 ELSE 1 END AS verdict FROM loans
""")
def fn_check_dates(t):
    verdict = dt.fn_check_dates(F.col("start"), F.col("finish"), F.col("active"), F.lit(AS_OF).cast("date"))
    return t.loans.select("l_orderkey", "l_linenumber", verdict.alias("verdict"))


# part names with four kinds of ending, so that both answers occur
TITLES = """
titles AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN p_name WHEN 'SMALL' THEN p_name || ' J.'
  WHEN 'LARGE' THEN split_part(p_name, ' ', 1) || '.' ELSE p_name || '.' END AS title FROM part)"""


def titles(t):
    kind, name = F.col("p_type"), F.col("p_name")
    title = (
        F.when(kind == "PROMO", name)
        .when(kind == "SMALL", F.concat(name, F.lit(" J.")))
        .when(kind == "LARGE", F.concat(F.split_part(name, F.lit(" "), F.lit(1)), F.lit(".")))
        .otherwise(F.concat(name, F.lit(".")))
    )
    return t.part.select("p_partkey", title.alias("title"))


NAME_PATTERN_SQL = NAME_PATTERN.replace("'", "''")


@query(f"""
WITH {TITLES}
SELECT p_partkey, title, CAST(regexp_matches(title, '{NAME_PATTERN_SQL}') AND contains(title, '.') AS INTEGER) AS valid
FROM titles
""")
def fn_check_name(t):
    return titles(t).withColumn("valid", check_name(F.col("title")))


KEYS = "keys AS (SELECT DISTINCT l_orderkey + 1 AS k FROM lineitem)"


def _shifted_keys(t):
    return t.lineitem.select((F.col("l_orderkey") + 1).alias("k")).distinct()


FREE = f"""
{KEYS}, free AS (SELECT x AS free_key FROM range(1, (SELECT max(k) FROM keys)) r(x) WHERE x NOT IN (SELECT k FROM keys))"""


@query(f"""
WITH {FREE}
SELECT min(free_key) AS start, max(free_key) AS stop
FROM (SELECT free_key, free_key - row_number() OVER (ORDER BY free_key) AS run FROM free) GROUP BY run
""")
def tf_free_key_ranges(t):
    return ky.tf_free_key_ranges(_shifted_keys(t), "k")


@query(f"""
WITH {FREE}
SELECT row_number() OVER (ORDER BY free_key) AS pos, free_key FROM free
""")
def fn_free_keys_list(t):
    return ky.fn_free_keys_list(_shifted_keys(t), "k")


@query("SELECT CAST(sum(p_size) AS BIGINT) AS delta FROM part WHERE p_type = 'PROMO'")
def fn_stats_delta(t):
    """Stored totals without the PROMO parts are refreshed with all parts; the delta is new total - old total."""
    active = F.col("l_linestatus") == "O"
    path = scratch_path(t.spark, "stats")
    before = ag.library_totals(t.part.filter(F.col("p_type") != "PROMO"), t.lineitem, "p_size", active)
    snapshots.write_snapshot(before, before.schema, path)
    return snapshots.fn_stats_delta(ag.library_totals(t.part, t.lineitem, "p_size", active), path)


@query(f"""
WITH {FREE}, n AS (SELECT count(*) AS n FROM keys),
 moved AS (SELECT k, row_number() OVER (ORDER BY k DESC) AS turn FROM keys WHERE k > (SELECT n FROM n)),
 holes AS (SELECT free_key, row_number() OVER (ORDER BY free_key) AS turn FROM free WHERE free_key <= (SELECT n FROM n))
SELECT k AS old_key, free_key AS new_key FROM moved JOIN holes USING (turn)
UNION ALL SELECT k, k FROM keys WHERE k <= (SELECT n FROM n)
""")
def proc_compact_keys(t):
    return ky.proc_compact_keys(_shifted_keys(t), "k")
