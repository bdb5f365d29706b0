"""Queries: set operations."""

from pyspark.sql import functions as F

from tablewright.operators import sets as st
from tablewright.plans.registry import query

KINDS = ("PROMO", "ECONOMY", "SMALL", "STANDARD", "MEDIUM", "LARGE")


@query("""
SELECT DISTINCT p_partkey, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_suppkey = 2
""")
def union_distinct(t):
    sold = t.lineitem.filter(F.col("l_suppkey") == 2).select(F.col("l_partkey").alias("p_partkey"))
    return st.union_distinct([sold.join(t.kind(k), "p_partkey") for k in KINDS], ["p_partkey", "p_retailprice"])


@query("""
SELECT p_partkey FROM part WHERE p_size = (SELECT max(p_size) FROM part)
""")
def union_max_all(t):
    return st.union_max_all([t.kind(k) for k in KINDS], "p_partkey", "p_size").select("p_partkey")


@query("""
SELECT p_name, p_size FROM part
""")
def union_all(t):
    return st.union_all([t.kind(k).select("p_name", "p_size") for k in KINDS])


def _makers_of(t, kind):
    large = t.kind(kind).filter(F.col("p_size") == 50).select(F.col("p_partkey").alias("model"))
    return t.makers.join(large, "model").select("maker")


def _makers_sql(kind):
    return f"SELECT l_suppkey AS maker FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = '{kind}' AND p_size = 50"


@query(f"{_makers_sql('PROMO')} EXCEPT {_makers_sql('ECONOMY')}")
def except_distinct(t):
    return st.except_distinct(_makers_of(t, "PROMO"), _makers_of(t, "ECONOMY"))


@query(f"{_makers_sql('PROMO')} INTERSECT {_makers_sql('SMALL')}")
def intersect_distinct(t):
    return st.intersect_distinct(_makers_of(t, "PROMO"), _makers_of(t, "SMALL"))
