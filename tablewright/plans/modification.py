"""Queries: data modification."""

from pyspark.sql import functions as F

from tablewright.functions import dates as dt
from tablewright.operators import modify as md
from tablewright.plans.registry import query
from tablewright.sources.trial import AS_OF

ORDERS = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)"""


def _orders(t):
    return t.dated_orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def _literal_orders(t, rows):
    return t.spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate string"
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query(f"""
WITH {ORDERS}, top AS (SELECT max(o_orderkey) AS m FROM o)
SELECT * FROM o
UNION ALL SELECT 9000000001, 4, 'F', DATE '2016-01-15'
UNION ALL SELECT m + 1, 2, 'F', DATE '2016-01-25' FROM top
UNION ALL SELECT m + 2, 3, 'F', DATE '2016-01-25' FROM top
""")
def insert_rows(t):
    new = _literal_orders(t, [
        (9000000001, 4, "F", "2016-01-15"), (None, 2, "F", "2016-01-25"), (0, 3, "F", "2016-01-25"),
    ])
    return md.insert_rows(_orders(t), new, "o_orderkey", ["o_custkey"])


@query(f"""
WITH {ORDERS}, top AS (SELECT max(o_orderkey) AS m FROM o)
SELECT * FROM o
UNION ALL SELECT m + 1, 4, 'N', DATE '2000-02-01' FROM top
UNION ALL SELECT m + 2, 5, 'Y', DATE '2001-02-01' FROM top
""")
def insert_conditional(t):
    new = _literal_orders(t, [(None, 4, None, "2000-02-01"), (None, 5, None, "2001-02-01")])
    new = new.withColumn("due", F.add_months("o_orderdate", 6))
    return md.insert_conditional(
        _orders(t), new, "o_orderkey", ["o_custkey"], "o_orderstatus", "due", F.lit(AS_OF).cast("date")
    )


@query(f"""
WITH {ORDERS}
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey = 2 THEN 'O' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM o
""")
def update_where(t):
    return md.update_where(_orders(t), F.col("o_custkey") == 2, {"o_orderstatus": F.lit("O")})


@query(f"""
WITH {ORDERS}
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderdate < DATE '1997-01-01'
  THEN CAST(CAST(o_orderdate + INTERVAL 2 MONTH AS DATE) - 3 AS DATE) ELSE o_orderdate END AS o_orderdate FROM o
""")
def update_shift_date(t):
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("date")
    return md.update_shift_date(_orders(t), early, "o_orderdate", months=2, days=-3)


@query("""
SELECT c_custkey, c_name, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders
  WHERE o_custkey = c_custkey AND o_orderstatus = 'O') AS last_visit FROM customer
""")
def update_from_join(t):
    people = md.add_column_default(t.customer.select("c_custkey", "c_name"), "last_visit", "date")
    visits = (
        t.dated_orders.filter(F.col("o_orderstatus") == "O")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("latest"))
    )
    return md.update_from_join(people, visits, "c_custkey", {"last_visit": "latest"})


@query(f"WITH {ORDERS} SELECT * FROM o WHERE NOT (o_custkey = 3 AND o_orderstatus = 'F')")
def delete_where(t):
    return md.delete_where(_orders(t), (F.col("o_custkey") == 3) & (F.col("o_orderstatus") == "F"))


@query(f"WITH {ORDERS} SELECT * FROM o WHERE NOT (o_orderstatus = 'P' AND dayname(o_orderdate) = 'Sunday')")
def delete_by_weekday(t):
    return md.delete_by_weekday(_orders(t), "o_orderdate", 1, F.col("o_orderstatus") == "P")


@query(f"WITH {ORDERS} SELECT * FROM o WHERE day(o_orderdate) <= 20")
def delete_by_month_day(t):
    return md.delete_by_month_day(_orders(t), "o_orderdate", 20)


@query("""
WITH new AS (SELECT c_name AS s_name, c_nationkey AS s_nationkey FROM customer
  UNION ALL SELECT s_name, 0 FROM supplier WHERE s_nationkey = 3)
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_name NOT IN (SELECT s_name FROM new)
UNION ALL
SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_name), s_name, s_nationkey FROM new
""")
def replace_into(t):
    base = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    nothing = F.lit(None).cast("bigint").alias("s_suppkey")
    new = t.customer.select(nothing, F.col("c_name").alias("s_name"), F.col("c_nationkey").alias("s_nationkey"))
    again = base.filter(F.col("s_nationkey") == 3).select(nothing, "s_name", F.lit(0).alias("s_nationkey"))
    return md.replace_into(base, new.unionByName(again), "s_name", "s_suppkey")


@query("""
SELECT c_custkey AS id, c_name || '[OLD]' AS name FROM customer WHERE c_custkey IN (SELECT p_partkey FROM part)
UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)
""")
def upsert_rename_duplicate(t):
    here = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    there = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return md.upsert_rename_duplicate(here, there, "id", "name")


@query("SELECT c_custkey, c_name, CAST(0 AS INTEGER) AS s_books FROM customer")
def add_column_default(t):
    return md.add_column_default(t.customer.select("c_custkey", "c_name"), "s_books", "int", 0)


# loans whose two dates the view shows as one text
BASE = """
base AS (SELECT o_orderkey AS id, o_custkey AS person, CAST(o_orderdate AS DATE) AS start,
  CAST(o_orderdate AS DATE) + 30 AS finish FROM orders)"""


def _base(t):
    return t.dated_orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person"),
        F.col("o_orderdate").alias("start"), F.date_add("o_orderdate", 30).alias("finish"),
    )


@query(f"""
WITH {BASE}
SELECT * FROM base
UNION ALL
SELECT (SELECT max(id) FROM base) + row_number() OVER (ORDER BY c_custkey), c_custkey, DATE '2016-01-15', DATE '2016-01-30'
FROM customer
""")
def view_insert_through(t):
    typed = t.customer.select(
        F.lit(None).cast("bigint").alias("id"),
        F.col("c_custkey").cast("string").alias("person"), F.lit("2016-01-15 - 2016-01-30").alias("dates"),
    )
    return md.view_insert_through(
        _base(t), typed,
        {
            "person": F.col("person"),
            "start": dt.first_date_of(F.col("dates")), "finish": dt.second_date_of(F.col("dates")),
        },
        "id", ["person"], {"use digits for person": ~F.col("person").rlike("[^0-9]")},
    )


@query(f"""
WITH {BASE}
SELECT id, CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F' THEN person + 1 ELSE person END AS person,
  CASE WHEN o_orderpriority = '2-HIGH' THEN DATE '2016-01-15' ELSE start END AS start,
  CASE WHEN o_orderpriority = '2-HIGH' THEN DATE '2016-01-30' ELSE finish END AS finish
FROM base JOIN orders ON id = o_orderkey
""")
def view_update_through(t):
    # an id typed in digits is taken, a name leaves the stored id alone
    person = F.when(F.col("o_orderstatus") == "F", F.lit("somebody")).otherwise((F.col("o_custkey") + 1).cast("string"))
    edited = t.orders.filter(F.col("o_orderpriority") == "2-HIGH").select(
        F.col("o_orderkey").alias("id"), person.alias("person"), F.lit("2016-01-15 - 2016-01-30").alias("dates")
    )
    return md.view_update_through(
        _base(t), edited,
        {
            "person": F.when(
                F.col("new.person").rlike("^[0-9]+$"), F.col("new.person").try_cast("bigint")
            ).otherwise(F.col("old.person")),
            "start": dt.first_date_of(F.col("new.dates")), "finish": dt.second_date_of(F.col("new.dates")),
        },
        "id",
    )


@query(f"WITH {BASE} SELECT * FROM base WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM')")
def view_delete_through(t):
    shown = t.orders.filter(F.col("o_orderpriority") == "3-MEDIUM").select(F.col("o_orderkey").alias("id"))
    return md.view_delete_through(_base(t), shown, "id")
