"""Trees of any depth, given as (node, parent, ordinal) edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.numbering import adjacent, ordered_slices, with_row_index
from tablewright.sources.scratch import write_scratch


def _paths(rows: DataFrame) -> DataFrame:
    """Each node with its path of ordinals from the root: pointer doubling, so depth d takes about log2(d) rounds.

    ``up`` is the ancestor a node's path reaches to, NULL once that is the root. In a round every open node takes over the path and
    the pointer of its ancestor. A parent that no row has makes an orphan, and so all below it; what is still open
    after enough rounds for any depth leads into a cycle.
    """
    state = write_scratch(rows.withColumn("path", F.array("ordinal")).withColumn("fault", F.lit(None).cast("string")).withColumnRenamed("parent", "up"), "tree")
    nodes, rounds = state.count(), 0
    while 2**rounds <= 2 * nodes and not state.filter("up is not null").isEmpty():
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("fault").alias("_fault"), F.lit(True).alias("_there"))
        joined = state.filter("up is not null").join(above, "up", "left")
        stepped = joined.select(
            "node", F.when(F.col("_there"), F.col("_up")).alias("up"), "ordinal", "name", "count",
            F.concat(F.coalesce("_path", F.array().cast(state.schema["path"].dataType)), "path").alias("path"),
            F.when(F.col("_there"), F.col("_fault")).otherwise(F.lit("orphan")).alias("fault"),
        )
        state = write_scratch(state.filter("up is null").select(*stepped.columns).unionByName(stepped), "tree")
        rounds += 1
    return state.withColumn("fault", F.when(F.col("up").isNotNull(), "cycle").otherwise(F.col("fault"))).drop("up")


def _single(edges: DataFrame, node: str, others: list[Column]) -> DataFrame:
    """One row per node with other columns; a node that repeats is an error when the plan runs."""
    twice = F.raise_error(F.concat(F.lit("node repeats: "), F.col("node").cast("string"))).cast("boolean")
    single = edges.select(F.col(node).alias("node"), F.struct(*others).alias("_row")).groupBy("node").agg(F.count("*").alias("_n"), F.any_value("_row").alias("_row"))
    return single.filter(F.when(F.col("_n") == 1, True).otherwise(twice)).select("node", "_row.*")


def tree_preorder(edges: DataFrame, node: str, parent: str, ordinal: str) -> DataFrame:
    """(node, position, depth, fault): the place of every node in pre-order, in memory that grows with the nodes and not with their depth.

    The way around the tree passes every node twice, going down and coming up again; each passage knows the next one (first child, next
    sibling, or the parent's way up). The list is ranked by pointer jumping: in a round every passage adds what its next one has counted to its own
    and points where that one points, so a list of n passages takes log2(n) rounds of one join. Positions are counted from the end,
    depth is what is still open. Siblings stand in order of (ordinal, node). ``fault`` as in ``tree_flatten``: orphan or cycle, without position and depth.
    """
    named = _single(edges, node, [F.col(parent).alias("parent"), F.col(ordinal).cast("bigint").alias("ordinal")])
    rows = write_scratch(adjacent(named, ["parent"], ["ordinal", "node"], {"node": "_after"}, step=1), "tree")
    first = rows.where("parent is not null").groupBy("parent").agg(F.min(F.struct("ordinal", "node")).alias("_first"))
    first = first.select(F.col("parent").alias("_of"), F.col("_first.node").alias("_child"))
    there = rows.select(F.col("node").alias("_known"))
    told = rows.join(first, F.col("node") == F.col("_of"), "left").join(there, F.col("parent") == F.col("_known"), "left")
    kind = named.schema["node"].dataType
    none = F.lit(None).cast(kind)

    def passage(up: bool, to: Column, to_up: Column, fault: Column) -> Column:
        # what is counted from here to the end: nodes entered, and how far the way goes up on balance
        return F.struct(
            F.lit(up).alias("up"), to.alias("to"), to_up.alias("to_up"), fault.cast("string").alias("fault"),
            F.lit(0 if up else 1).cast("bigint").alias("nodes"), F.lit(1 if up else -1).cast("bigint").alias("rise"),
        )

    down = passage(False, F.coalesce("_child", "node"), F.col("_child").isNull(), F.lit(None))
    last = F.col("_after").isNull()
    up = passage(
        True, F.coalesce("_after", "_known"), F.when(~last, False).when(F.col("_known").isNotNull(), True),
        F.when(last & F.col("parent").isNotNull() & F.col("_known").isNull(), "orphan"),
    )
    state = write_scratch(told.select("node", F.explode(F.array(down, up)).alias("p")).select("node", "p.*"), "tour")
    passages, rounds = state.count(), 0
    while 2**rounds <= 2 * passages and not state.filter("to is not null").isEmpty():
        next_ = state.select(F.col("node").alias("_n"), F.col("up").alias("_u"), *[F.col(c).alias(f"_{c}") for c in ("to", "to_up", "fault", "nodes", "rise")])
        jumped = state.filter("to is not null").join(next_, (F.col("to") == F.col("_n")) & (F.col("to_up") == F.col("_u")))
        stepped = jumped.select(
            "node", "up", F.col("_to").alias("to"), F.col("_to_up").alias("to_up"), F.col("_fault").alias("fault"),
            (F.col("nodes") + F.col("_nodes")).alias("nodes"), (F.col("rise") + F.col("_rise")).alias("rise"),
        )
        state = write_scratch(state.filter("to is null").unionByName(stepped), "tour")
        rounds += 1
    fault = F.when(F.col("to").isNotNull(), "cycle").otherwise(F.col("fault"))
    entered = write_scratch(state.filter("not up").select("node", fault.alias("fault"), "nodes", "rise"), "entered")
    # the first node counts all
    most = entered.filter("fault is null").agg(F.max("nodes")).scalar()
    sound = F.col("fault").isNull()
    return entered.select(
        "node", F.when(sound, most - F.col("nodes")).alias("position"), F.when(sound, F.col("rise")).cast("int").alias("depth"), "fault"
    )


def tree_flatten(
    edges: DataFrame, node: str, parent: str, ordinal: str, name: str, count: str, indent: str = "--"
) -> DataFrame:
    """Nodes in pre-order: (position, depth, path, label).

    Nodes are told apart by ``node``, which must not repeat (an error when the plan runs); displayed ids may. Nodes that no root
    reaches come without position, depth and path, their label says why: orphan (some ancestor's parent is missing) or cycle.
    """
    rows = _single(edges, node, [
        F.col(parent).alias("parent"), F.col(ordinal).cast("bigint").alias("ordinal"), F.col(name).alias("name"), F.col(count).alias("count")
    ])
    found = _paths(rows)
    reached = found.filter("fault is null").select("node", "name", "count", (F.size("path") - 1).alias("depth"), "path")
    placed = with_row_index(ordered_slices(reached, ["path", "node"]), [], ["path", "node"], "position")
    blank = F.when(F.col("depth") > 0, " ").otherwise("")
    told = F.concat(F.col("name"), F.lit(" ("), F.col("count").cast("string"), F.lit(")"))
    shown = placed.select(
        "position", "depth", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"),
        F.concat(F.repeat(F.lit(indent), F.col("depth")), blank, told).alias("label"),
    )
    lost = found.filter("fault is not null").select(
        F.lit(None).cast("bigint").alias("position"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("path"),
        F.concat(told, F.lit(" ["), "fault", F.lit("]")).alias("label"),
    )
    return shown.unionByName(lost)
