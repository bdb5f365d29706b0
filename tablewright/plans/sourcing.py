"""Queries: sources, snapshots, views."""

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tablewright.operators import aggregates as ag
from tablewright.operators import ranking as rk
from tablewright.plans.aggregation import TOTALS
from tablewright.plans.ranking import FIRST_ORDERS
from tablewright.plans.registry import query
from tablewright.sources import bucketed, nested_json, snapshots
from tablewright.sources.scratch import scratch_path
from tablewright.sources.trial import TABLES

STATS = StructType([StructField(c, LongType(), False) for c in ("total", "given", "rest")])


def _totals(t):
    return ag.library_totals(t.part, t.lineitem, "p_size", F.col("l_linestatus") == "O")


def _nothing_lent(t):
    return ag.library_totals(t.part, t.lineitem, "p_size", F.lit(False))


@query("SELECT * FROM customer")
def scan_table(t):
    return snapshots.scan_table(t.spark, t.path("customer"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, false AS corrupt FROM events")
def scan_nested_json(t):
    schema = StructType([StructField("k", LongType())])
    parsed = nested_json.parse_nested_json(t.events, "props", schema)
    return parsed.select(
        "event_id", F.col("record.k").alias("k"), F.col(f"record.{nested_json.CORRUPT}").isNotNull().alias("corrupt")
    )


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, false AS corrupt FROM events")
def scan_nested_json_files(t):
    """Events written as JSON, one record per line, and read by the file reader."""
    path = scratch_path(t.spark, "events-json")
    inner = StructType([StructField("k", LongType())])
    t.events.select("event_id", "user_id", F.from_json("props", inner).alias("props")).write.json(path)
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("props", inner)])
    read = nested_json.scan_nested_json(t.spark, path, schema, one_document=False)
    return read.select("event_id", "user_id", "props.k", F.col(nested_json.CORRUPT).isNotNull().alias("corrupt"))


@query(r"""SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'x}\"{]' || event_type AS note, false AS corrupt FROM events""")
def scan_json_array(t):
    """Events written as JSON arrays of ten thousand, with braces and quotes in a text, and read by byte ranges."""
    path = scratch_path(t.spark, "events-arrays")
    inner = StructType([StructField("k", LongType())])
    note = F.concat(F.lit('x}\\"{]'), F.col("event_type"))
    # parts by place and not by key, so that one that repeats makes no large array; rows move before they are collected, as a task that scans would sort all of its lists
    parts = t.events.select(F.floor(F.monotonically_increasing_id() / 10_000).alias("part"), "event_id", "user_id", "props", "event_type").repartition("part")
    rows = parts.select("part", "event_id", "user_id", F.from_json("props", inner).alias("props"), note.alias("note"))
    lists = rows.groupBy("part").agg(F.collect_list(F.struct("event_id", "user_id", "props", "note")).alias("all"))
    lists.select(F.to_json("all", {"pretty": "true"})).write.text(path)
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("props", inner), StructField("note", StringType())])
    read = nested_json.scan_json_array(t.spark, path, schema)
    return read.select("event_id", "user_id", "props.k", "note", F.col(nested_json.CORRUPT).isNotNull().alias("corrupt"))


@query(TOTALS)
def write_snapshot(t):
    return snapshots.write_snapshot(_totals(t), STATS, scratch_path(t.spark, "stats"))


@query(TOTALS)
def reload_snapshot(t):
    path = scratch_path(t.spark, "stats")
    snapshots.write_snapshot(_nothing_lent(t), STATS, path)
    return snapshots.reload_snapshot(_totals(t), path)


@query(TOTALS)
def create_or_refresh_stats(t):
    path = scratch_path(t.spark, "stats")
    snapshots.create_or_refresh_stats(_nothing_lent(t), path)
    return snapshots.create_or_refresh_stats(_totals(t), path)


@query(TOTALS)
def refresh_stats_strict(t):
    path = scratch_path(t.spark, "stats")
    snapshots.write_snapshot(_nothing_lent(t), STATS, path)
    return snapshots.refresh_stats_strict(_totals(t), path)


@query("""
SELECT o_orderkey, c.year, count(*) AS lines, sum(l_quantity) AS quantity
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997) c
JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def bucketed_snapshots(t):
    """Orders and lines laid out by order key: joined and grouped without an exchange; the years asked for are read alone."""
    place = scratch_path(t.spark, "bucketed")
    orders = bucketed.write_bucketed(
        t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")), f"{place}/orders", "o_orderkey", 8, ["year"]
    )
    lines = bucketed.write_bucketed(t.lineitem.select("l_orderkey", "l_quantity"), f"{place}/lines", "l_orderkey", 8)
    joined = orders.where("year between 1996 and 1997").join(lines, orders["o_orderkey"] == lines["l_orderkey"])
    return joined.groupBy("o_orderkey", "year").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


@query(FIRST_ORDERS)
def named_view(t):
    orders = t.dated_orders.select("o_custkey", "o_orderkey", "o_orderdate")
    first = rk.row_number_first_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    return snapshots.named_view(first, "first_orders")


@query("SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def schema_bound_view(t):
    required = StructType([
        StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType()),
        StructField("o_orderdate", DateType()),
    ])
    return snapshots.schema_bound_view(t.dated_orders, required, "orders_anonymous")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows_count FROM {n}" for n in TABLES))
def table_row_counts(t):
    return snapshots.row_counts_of_files(t.spark, {name: t.path(name) for name in TABLES})
