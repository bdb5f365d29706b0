"""Queries: nested arrays and trees."""

from pyspark.sql import functions as F

from tablewright.operators import nested as ns
from tablewright.operators.trees import tree_flatten as flatten
from tablewright.operators.trees import tree_preorder as preorder
from tablewright.plans.registry import query

# regions as enterprises, nations as departments, customers as employees
FLAT = """
staff AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1),
ent AS (SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS name FROM region),
dep AS (SELECT CAST(n_regionkey + 1 AS BIGINT) AS ent_id, CAST(n_nationkey + 101 AS BIGINT) AS id, n_name AS name,
  coalesce(n, 0) AS employees_count FROM nation LEFT JOIN staff ON c_nationkey = n_nationkey)"""


def flat(df):
    """One row per child, and one with NULLs for a parent without children."""
    return df.select("id", "name", F.explode_outer("departments").alias("d")).select(
        "id", "name", F.col("d.id").alias("dep_id"), F.col("d.name").alias("dep_name"), "d.employees_count"
    )


def flat_sql(ent="ent", dep="dep"):
    return f"""SELECT e.id, e.name, d.id AS dep_id, d.name AS dep_name, d.employees_count
FROM {ent} e LEFT JOIN {dep} d ON d.ent_id = e.id"""


@query("SELECT lang, text, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY lang, text")
def dedup_nested_records(t):
    records = t.documents.select("doc_id", F.struct("lang", "text").alias("record"))
    unique = ns.dedup_nested_records(records, ["record"], "doc_id")
    return unique.select("record.lang", "record.text", "doc_id", "copies")


@query(f"""
WITH {FLAT}, total AS (SELECT ent_id, CAST(sum(employees_count) AS BIGINT) AS n FROM dep GROUP BY 1)
SELECT id, CAST(0 AS INTEGER) AS position, n AS employees_count,
  name || ' (' || CASE WHEN n > 0 THEN CAST(n AS VARCHAR) ELSE 'нет' END || ' сотрудников)' AS line
FROM ent JOIN total ON ent_id = id
UNION ALL
SELECT ent_id, CAST(row_number() OVER (PARTITION BY ent_id ORDER BY id) AS INTEGER), employees_count,
  '- ' || name || ' (' || CASE WHEN employees_count > 0 THEN CAST(employees_count AS VARCHAR) ELSE 'нет' END || ' сотрудников)'
FROM dep
""")
def nested_rollup_report(t):
    return ns.nested_rollup_report(t.enterprises)


@query(f"""
WITH {FLAT}, asked AS (SELECT CAST(n_nationkey + 101 AS VARCHAR) AS value FROM nation UNION SELECT n_name FROM nation
  UNION SELECT CAST(r_regionkey + 1 AS VARCHAR) FROM region UNION SELECT c_name FROM customer)
SELECT value, CASE WHEN own.id IS NOT NULL THEN 'Это id предриятия, а не отдела' ELSE owner.name END AS owner
FROM asked LEFT JOIN ent own ON CAST(own.id AS VARCHAR) = value
LEFT JOIN dep ON CAST(dep.id AS VARCHAR) = value OR dep.name = value
LEFT JOIN ent owner ON owner.id = dep.ent_id
""")
def nested_find_owner(t):
    asked = (
        t.nation.select(F.explode(F.array((F.col("n_nationkey") + 101).cast("string"), F.col("n_name"))).alias("value"))
        .unionByName(t.region.select((F.col("r_regionkey") + 1).cast("string").alias("value")))
        .unionByName(t.customer.select(F.col("c_name").alias("value")))
    )
    return ns.nested_find_owner(t.enterprises, asked.distinct())


@query(f"""
WITH {FLAT}, new AS (SELECT DISTINCT c_mktsegment AS name FROM customer)
{flat_sql()}
UNION ALL
SELECT (SELECT max(id) FROM dep) + row_number() OVER (ORDER BY name), name, NULL, NULL, NULL FROM new
""")
def nested_append_parent(t):
    new = t.customer.select(F.col("c_mktsegment").alias("name")).distinct()
    return flat(ns.nested_append_parent(t.enterprises, new))


@query(f"""
WITH {FLAT}, new AS (SELECT CAST(n_regionkey + 1 AS BIGINT) AS ent_id, c_mktsegment AS name, count(*) AS employees_count
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
 all_dep AS (SELECT * FROM dep UNION ALL
  SELECT ent_id, (SELECT max(id) FROM dep) + row_number() OVER (ORDER BY ent_id, name), name, employees_count FROM new)
{flat_sql(dep='all_dep')}
""")
def nested_append_child(t):
    new = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy((F.col("n_regionkey") + 1).cast("bigint").alias("parent_id"), F.col("c_mktsegment").alias("name"))
        .agg(F.count("*").alias("employees_count"))
    )
    return flat(ns.nested_append_child(t.enterprises, new))


@query(f"""
WITH {FLAT}, e2 AS (SELECT id, lower(name) AS name FROM ent),
 d2 AS (SELECT ent_id, id, CASE WHEN employees_count > (SELECT avg(n) FROM staff) THEN name || ' (large)' ELSE name END AS name,
   employees_count FROM dep)
{flat_sql('e2', 'd2')}
""")
def nested_rename(t):
    parents = t.region.select((F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.lower("r_name").alias("new_name"))
    staff = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    large = staff.filter(F.col("n") > staff.agg(F.avg("n")).scalar())
    children = large.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("n_nationkey") + 101).cast("bigint").alias("id"), F.concat("n_name", F.lit(" (large)")).alias("new_name")
    )
    return flat(ns.nested_rename(t.enterprises, parents, children))


@query(f"WITH {FLAT} {flat_sql()} WHERE e.id NOT IN (SELECT r_regionkey + 1 FROM region WHERE r_name LIKE 'A%')")
def nested_delete_parent(t):
    gone = t.region.filter(F.col("r_name").startswith("A")).select((F.col("r_regionkey") + 1).cast("bigint").alias("id"))
    return flat(ns.nested_delete_parent(t.enterprises, gone))


MOVED = """
d2 AS (SELECT ent_id, id, name, CASE id WHEN 101 THEN 0 WHEN 102 THEN
  employees_count + (SELECT employees_count FROM dep WHERE id = 101) ELSE employees_count END AS employees_count FROM dep)"""


@query(f"WITH {FLAT}, {MOVED}, d3 AS (SELECT * FROM d2 WHERE id <> 101) {flat_sql(dep='d3')}")
def nested_delete_child_if_empty(t):
    # 101 is emptied first, so of the two children named it alone goes
    return flat(ns.nested_delete_child_if_empty(ns.nested_move_value(t.enterprises, 101, 102), [101, 103]))


@query(f"WITH {FLAT}, {MOVED} {flat_sql(dep='d2')}")
def nested_move_value(t):
    return flat(ns.nested_move_value(t.enterprises, 101, 102))


@query("""
WITH nodes AS (
  SELECT r_regionkey AS a, NULL AS b, NULL AS c, 0 AS depth, r_name AS name,
    (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n FROM region
  UNION ALL SELECT n_regionkey, n_nationkey, NULL, 1, n_name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) FROM nation
  UNION ALL SELECT n_regionkey, n_nationkey, s_suppkey, 2, s_name, 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT row_number() OVER (ORDER BY a, b NULLS FIRST, c NULLS FIRST) - 1 AS position, CAST(depth AS INTEGER) AS depth,
  concat_ws('/', a, b, c) AS path,
  CASE depth WHEN 0 THEN '' WHEN 1 THEN '-- ' ELSE '---- ' END || name || ' (' || n || ')' AS label
FROM nodes
""")
def tree_flatten(t):
    return flatten(_places(t), "node", "parent", "ordinal", "name", "count")


@query("""
WITH nodes AS (
  SELECT 'r' || r_regionkey AS node, r_regionkey AS a, NULL AS b, NULL AS c, 0 AS depth FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_regionkey, n_nationkey, NULL, 1 FROM nation
  UNION ALL SELECT 's' || s_suppkey, n_regionkey, n_nationkey, s_suppkey, 2 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT node, row_number() OVER (ORDER BY a, b NULLS FIRST, c NULLS FIRST) - 1 AS position, CAST(depth AS INTEGER) AS depth, CAST(NULL AS VARCHAR) AS fault FROM nodes
""")
def tree_preorder(t):
    return preorder(_places(t), "node", "parent", "ordinal")


def _places(t):
    """Regions, nations and suppliers as one tree."""
    nations = t.nation.groupBy("n_regionkey").agg(F.count("*").alias("count"))
    suppliers = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("count"))
    edges = (
        t.region.join(nations, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.concat(F.lit("r"), F.col("r_regionkey")).alias("node"), F.lit(None).cast("string").alias("parent"),
            F.col("r_regionkey").alias("ordinal"), F.col("r_name").alias("name"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .unionByName(t.nation.join(suppliers, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.concat(F.lit("n"), F.col("n_nationkey")).alias("node"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("parent"),
            F.col("n_nationkey").alias("ordinal"), F.col("n_name").alias("name"),
            F.coalesce("count", F.lit(0)).alias("count"),
        ))
        .unionByName(t.supplier.select(
            F.concat(F.lit("s"), F.col("s_suppkey")).alias("node"), F.concat(F.lit("n"), F.col("s_nationkey")).alias("parent"),
            F.col("s_suppkey").alias("ordinal"), F.col("s_name").alias("name"), F.lit(1).cast("bigint").alias("count"),
        ))
    )
    return edges
