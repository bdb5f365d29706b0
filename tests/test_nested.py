"""Nested parents and trees: the worked examples."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import nested as ns
from tablewright.operators.trees import tree_flatten, tree_preorder

SCHEMA = "id bigint, name string, departments array<struct<id:bigint,name:string,employees_count:bigint>>"


@pytest.fixture
def firms(spark):
    return spark.createDataFrame([
        (1, "First", [(2, "Testing", 10), (3, "Marketing", 20), (4, "Office", 15)]),
        (5, "Second", [(6, "Development", 50), (7, "Marketing", 20), (8, "Safety", 5)]),
        (9, "Third", [(10, "Analysis", 0)]),
        (11, "Fourth", None),
    ], SCHEMA)


def tables(df):
    return {r.id: (r.name, None if r.departments is None else [tuple(d) for d in r.departments]) for r in df.collect()}


def test_rollup_report(firms):
    lines = [r.line for r in ns.nested_rollup_report(firms).orderBy("id", "position").collect()]
    assert lines == [
        "First (45 сотрудников)", "- Testing (10 сотрудников)", "- Marketing (20 сотрудников)", "- Office (15 сотрудников)",
        "Second (75 сотрудников)", "- Development (50 сотрудников)", "- Marketing (20 сотрудников)", "- Safety (5 сотрудников)",
        "Third (нет сотрудников)", "- Analysis (нет сотрудников)", "Fourth (нет сотрудников)",
    ]


def test_find_owner(spark, firms, rows):
    asked = spark.createDataFrame([("4",), ("Marketing",), ("5",), ("Nowhere",)], "value string")
    assert rows(ns.nested_find_owner(firms, asked)) == [
        ("4", "First"), ("5", ns.OWN_ID), ("Marketing", "Second"), ("Nowhere", None)
    ]


def test_append_parent_and_child(spark, firms):
    names = spark.createDataFrame([("B",), ("A",)], "name string")
    grown = ns.nested_append_parent(firms, names)
    assert tables(grown)[12] == ("A", []) and tables(grown)[13] == ("B", [])
    new = spark.createDataFrame([(9, "New", 16), (11, "Own", 1), (99, "Lost", 1)], "parent_id bigint, name string, employees_count bigint")
    done = tables(ns.nested_append_child(firms, new))
    assert done[9] == ("Third", [(10, "Analysis", 0), (12, "New", 16)])
    assert done[11] == ("Fourth", [(13, "Own", 1)]) and done[1] == tables(firms)[1]


def test_rename(spark, firms):
    parents = spark.createDataFrame([(1, "Prime")], "id bigint, new_name string")
    children = spark.createDataFrame([(7, "Sales"), (3, "Ads"), (77, "?")], "id bigint, new_name string")
    done = tables(ns.nested_rename(firms, parents, children))
    assert done[1] == ("Prime", [(2, "Testing", 10), (3, "Ads", 20), (4, "Office", 15)])
    assert done[5][1][1] == (7, "Sales", 20) and done[11] == ("Fourth", None)


def test_delete(spark, firms):
    assert 9 not in tables(ns.nested_delete_parent(firms, spark.createDataFrame([(9,)], "id bigint")))
    done = tables(ns.nested_delete_child_if_empty(firms, [10, 2]))
    assert done[9] == ("Third", []) and len(done[1][1]) == 3


def test_move(firms):
    done = tables(ns.nested_move_value(firms, 2, 6))
    assert done[1][1][0] == (2, "Testing", 0) and done[5][1][0] == (6, "Development", 60)
    assert tables(ns.nested_move_value(firms, 2, 77)) == tables(firms)


def test_dedup_variants_agree(spark, rows):
    data = [(i, (i % 3, None if i % 2 else "x")) for i in range(12)]
    df = spark.createDataFrame(data, "id bigint, card struct<a:bigint,b:string>")
    plain = rows(ns.dedup_nested_records(df, ["card"], "id"), "id", "copies")
    assert plain == rows(ns.dedup_nested_records(df, ["card"], "id", by_hash=True), "id", "copies")
    assert plain == [(i, 2) for i in range(6)]


def test_tree_with_repeated_ids(spark):
    # (node, parent, ordinal, id, name, users): id 2 occurs twice, nodes are told apart by path
    edges = [
        ("1", None, 1, 1, "Root", 10), ("1/1", "1", 1, 2, "A", 2), ("1/1/1", "1/1", 1, 3, "A1", 1),
        ("1/2", "1", 2, 4, "B", 5), ("1/2/1", "1/2", 1, 2, "B1", 3), ("1/2/1/1", "1/2/1", 1, 5, "B11", 4), ("2", None, 2, 6, "Other", 0),
    ]
    df = spark.createDataFrame(edges, "node string, parent string, ordinal int, id bigint, name string, users bigint")
    done = tree_flatten(df, "node", "parent", "ordinal", "name", "users").orderBy("position").collect()
    assert [r.label for r in done] == [
        "Root (10)", "-- A (2)", "---- A1 (1)", "-- B (5)", "---- B1 (3)", "------ B11 (4)", "Other (0)"
    ]
    assert [r.position for r in done] == list(range(7))


def test_deep_tree_with_a_hot_parent(spark):
    pick = random.Random(4)
    parent = {n: (None if n == 0 else n - 1 if n < 12 else 3 if n < 60 else pick.randrange(n)) for n in range(90)}
    df = spark.createDataFrame([(n, p, n, f"n{n}", 1) for n, p in parent.items()], "n bigint, p bigint, o bigint, name string, c bigint")
    order = []

    def walk(n, depth):
        order.append((f"n{n}", depth))
        for child in sorted(k for k, p in parent.items() if p == n):
            walk(child, depth + 1)

    walk(0, 0)
    done = tree_flatten(df, "n", "p", "o", "name", "c").orderBy("position").collect()
    assert [(r.label.lstrip("- ").split(" ")[0], r.depth) for r in done] == order


def test_tree_faults_are_told(spark, rows):
    edges = [(1, None, 1, "root", 1), (2, 1, 1, "kid", 1), (3, 99, 1, "lost", 1), (4, 3, 1, "below", 1), (5, 6, 1, "c1", 1), (6, 5, 1, "c2", 1), (7, 6, 1, "c3", 1)]
    df = spark.createDataFrame(edges, "n bigint, p bigint, o bigint, name string, c bigint")
    done = tree_flatten(df, "n", "p", "o", "name", "c")
    assert rows(done, "label") == sorted(
        [("root (1)",), ("-- kid (1)",), ("lost (1) [orphan]",), ("below (1) [orphan]",), ("c1 (1) [cycle]",), ("c2 (1) [cycle]",), ("c3 (1) [cycle]",)]
    )
    again = spark.createDataFrame([*edges, (2, 1, 2, "twin", 1)], df.schema)
    with pytest.raises(Exception, match="node repeats"):
        tree_flatten(again, "n", "p", "o", "name", "c").collect()


def test_chain_of_a_thousand_nodes(spark):
    df = spark.range(1000).selectExpr("id AS n", "CASE WHEN id > 0 THEN id - 1 END AS p", "id AS o", "'x' AS name", "1L AS c")
    done = tree_flatten(df, "n", "p", "o", "name", "c").orderBy("position")
    assert [r.depth for r in done.select("depth").collect()] == list(range(1000))


def by_hand(parent, ordinal):
    """(node, position, depth, fault) by walking down from the roots; what is not reached is an orphan's or a cycle's."""
    below, order = {}, []
    for n, p in parent.items():
        below.setdefault(p, []).append(n)
    todo = [(n, 0) for n in sorted(below.get(None, []), key=lambda n: (ordinal[n], n), reverse=True)]
    while todo:
        n, depth = todo.pop()
        order.append((n, len(order), depth, None))
        todo += [(k, depth + 1) for k in sorted(below.get(n, []), key=lambda n: (ordinal[n], n), reverse=True)]
    for n in parent.keys() - {r[0] for r in order}:
        seen, at = set(), n
        while at in parent and at not in seen:
            seen.add(at)
            at = parent[at]
        order.append((n, None, None, "cycle" if at in seen else "orphan"))
    return sorted(order)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_preorder_by_list_ranking(spark, rows, seed):
    """Several roots, a hot parent, chains, equal ordinals, orphans with all below them, a cycle with what hangs on it."""
    pick = random.Random(seed)
    parent = {n: (None if n < 3 else 5 if n % 3 == 0 else n - 1 if n < 40 else pick.randrange(n)) for n in range(120)}
    parent |= {200: 999, 201: 200, 202: 999, 203: 201, 300: 301, 301: 302, 302: 300, 303: 301, 304: 303}
    parent[3] = 2
    ordinal = {n: pick.randrange(4) for n in parent}
    df = spark.createDataFrame([(n, p, ordinal[n]) for n, p in parent.items()], "n bigint, p bigint, o int").repartition(3)
    assert rows(tree_preorder(df, "n", "p", "o")) == by_hand(parent, ordinal)
    texts = df.selectExpr("concat('t', n) AS n", "concat('t', p) AS p", "o")
    assert tree_preorder(texts, "n", "p", "o").filter("fault is null").count() == 120
    with pytest.raises(Exception, match="node repeats"):
        tree_preorder(df.unionByName(df.limit(1)), "n", "p", "o").collect()
    assert tree_preorder(df.limit(0), "n", "p", "o").collect() == []


def test_preorder_of_a_long_chain(spark):
    """Every node's row stays as small as that of a flat tree, so depth costs rounds and not memory."""
    df = spark.range(4000).selectExpr("id AS n", "CASE WHEN id > 0 THEN id - 1 END AS p", "0 AS o")
    found = tree_preorder(df, "n", "p", "o").collect()
    assert sorted((r.node, r.position, r.depth) for r in found) == [(i, i, i) for i in range(4000)]
