"""Jobs on parents that hold an array of children: (id, name, departments[id, name, employees_count]).

Array work stays inside the row; only jobs that bring in other tables shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranking import surrogate_keys

ARR = "departments"

# fixed values: wording of the report
UNIT = "сотрудников"
NONE = "нет"
OWN_ID = "Это id предриятия, а не отдела"


def dedup_nested_records(df: DataFrame, cols: Sequence[str], id_col: str, by_hash: bool = False) -> DataFrame:
    """Unique records by full content: smallest id and number of copies of each.

    ``by_hash`` groups on a 256-bit digest of the record's JSON, so long records are not shuffled;
    the kept record is fetched back by its id.
    """
    if not by_hash:
        return df.groupBy(*cols).agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))
    digest = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    kept = df.groupBy(digest.alias("_digest")).agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))
    return df.select(id_col, *cols).join(kept.drop("_digest"), id_col).select(*cols, id_col, "copies")


def nested_rollup_report(df: DataFrame, arr: str = ARR, unit: str = UNIT, none: str = NONE) -> DataFrame:
    """One line per parent with its total, then one per child; 0 reads as ``none``."""
    children = F.coalesce(F.col(arr), F.array().cast(df.schema[arr].dataType))
    total = F.aggregate(children, F.lit(0).cast("bigint"), lambda acc, d: acc + d["employees_count"])

    def line(lead: str, name: Column, count: Column) -> Column:
        shown = F.when(count > 0, count.cast("string")).otherwise(none)
        return F.concat(F.lit(lead), name, F.lit(" ("), shown, F.lit(f" {unit})"))

    head = F.array(F.struct(total.alias("employees_count"), line("", F.col("name"), total).alias("line")))
    rest = F.transform(
        children,
        lambda d: F.struct(
            d["employees_count"].cast("bigint").alias("employees_count"),
            line("- ", d["name"], d["employees_count"]).alias("line"),
        ),
    )
    return df.select("id", F.posexplode(F.concat(head, rest)).alias("position", "entry")).select(
        "id", "position", "entry.employees_count", "entry.line"
    )


def nested_find_owner(df: DataFrame, lookups: DataFrame, arr: str = ARR, own_id: str = OWN_ID) -> DataFrame:
    """(value, owner) for looked-up child ids or names (column ``value``, text).

    The last parent (by id) that matches wins; a parent's own id gives a message; no match gives NULL.
    """
    children = df.select("id", "name", F.explode(arr).alias("d"))
    entries = (
        df.select(F.col("id").cast("string").alias("value"), F.lit(own_id).alias("owner"), "id", F.lit(0).alias("step"))
        .unionByName(
            children.select(
                F.explode(F.array(F.col("d.id").cast("string"), F.col("d.name"))).alias("value"),
                F.col("name").alias("owner"), "id", F.lit(1).alias("step"),
            )
        )
    )
    last = entries.groupBy("value").agg(F.max_by("owner", F.struct("id", "step")).alias("owner"))
    return lookups.select("value").join(last, "value", "left")


def _numbered(new: DataFrame, df: DataFrame, order: Sequence[str], arr: str) -> DataFrame:
    """``new`` with an ``id`` after the largest id of both levels."""
    top = df.agg(F.max(F.greatest(F.col("id"), F.array_max(F.transform(F.col(arr), lambda d: d["id"])))).alias("id"))
    blank = new.withColumn("id", F.lit(None).cast("bigint"))
    return surrogate_keys(blank, top, "id", order)


def nested_append_parent(df: DataFrame, names: DataFrame, arr: str = ARR) -> DataFrame:
    """Add parents without children; ids go on after the largest id of both levels."""
    fresh = _numbered(names.select("name"), df, ["name"], arr)
    empty = F.array().cast(df.schema[arr].dataType)
    return df.unionByName(fresh.select("id", "name", empty.alias(arr)))


def nested_append_child(df: DataFrame, changes: DataFrame, arr: str = ARR) -> DataFrame:
    """Add children (parent_id, name, employees_count) to their parents; unknown parents are ignored."""
    known = changes.join(df.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")
    fresh = _numbered(known, df, ["parent_id", "name"], arr)
    element = df.schema[arr].dataType.elementType
    added = fresh.groupBy("parent_id").agg(
        F.array_sort(
            F.collect_list(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in element.fields]))
        ).alias("_added")
    )
    joined = df.join(added, df["id"] == added["parent_id"], "left")
    present = F.coalesce(F.col(arr), F.array().cast(df.schema[arr].dataType))
    grown = F.when(F.col("_added").isNull(), F.col(arr)).otherwise(F.concat(present, F.col("_added")))
    return joined.withColumn(arr, grown).select(*df.columns)


def nested_rename(
    df: DataFrame, parents: DataFrame | None = None, children: DataFrame | None = None, arr: str = ARR
) -> DataFrame:
    """Rename by id; both tables hold (id, new_name)."""
    if parents is not None:
        names = parents.select(F.col("id").alias("_id"), "new_name")
        df = (
            df.join(names, df["id"] == names["_id"], "left")
            .withColumn("name", F.coalesce("new_name", "name")).drop("_id", "new_name")
        )
    if children is not None:
        names = children.select(F.col("id").alias("_id"), "new_name")
        flat = df.select("id", F.posexplode(arr).alias("pos", "d"))
        renamed = flat.join(names, F.col("d.id") == F.col("_id")).select(
            F.col("id").alias("_parent"), F.struct("pos", "new_name").alias("hit")
        )
        # only the renamed positions travel back, as a map from position to name
        hits = renamed.groupBy("_parent").agg(F.map_from_entries(F.collect_list("hit")).alias("_hits"))
        joined = df.join(hits, df["id"] == hits["_parent"], "left")
        new_arr = F.transform(
            F.col(arr), lambda d, i: d.withField("name", F.coalesce(F.try_element_at("_hits", i), d["name"]))
        )
        df = joined.withColumn(arr, F.when(F.col("_hits").isNull(), F.col(arr)).otherwise(new_arr)).drop("_parent", "_hits")
    return df


def nested_delete_parent(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("id").distinct(), "id", "left_anti")


def nested_delete_child_if_empty(df: DataFrame, ids: Sequence[int], arr: str = ARR) -> DataFrame:
    """Remove the given children, each only if its count is 0."""
    kept = F.filter(F.col(arr), lambda d: ~(d["id"].isin(list(ids)) & (d["employees_count"] == 0)))
    return df.withColumn(arr, kept)


def nested_move_value(df: DataFrame, from_id: int, to_id: int, arr: str = ARR) -> DataFrame:
    """Move the whole count of one child to another; nothing happens unless both exist."""
    child = df.select(F.explode(arr).alias("d")).select("d.*")
    found = child.agg(F.struct(
        F.max(F.when(F.col("id") == from_id, F.col("employees_count"))).alias("moved"),
        F.max(F.when(F.col("id") == to_id, 1)).alias("target"),
    )).scalar()
    # a subquery may not stand inside the array function, so its value comes in as a column
    ready = df.withColumn("_moved", F.when(found["target"].isNotNull(), found["moved"]))

    def value(d: Column) -> Column:
        possible = F.col("_moved").isNotNull()
        return (
            F.when(possible & (d["id"] == from_id), 0)
            .when(possible & (d["id"] == to_id), d["employees_count"] + F.col("_moved"))
            .otherwise(d["employees_count"])
        )

    shifted = F.transform(F.col(arr), lambda d: d.withField("employees_count", value(d)))
    return ready.withColumn(arr, shifted).drop("_moved")
