"""State machines over ordered events, for groups of every size.

Which state an event finds depends on all events before it, so a group looks like work for one task. But a stretch of events is a
function from the state before it to the state after it, and such functions compose. Events of a group are cut into chunks of ``CHUNK``;
a chunk becomes a table (the state after it, for each state before it), chunks of tables become tables again, until one is left. On the
way back every chunk gets the state it starts from, and only then its events theirs. No task holds more than a chunk of anything, and groups of one chunk
skip all of this.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.numbering import SLICE, ordered_slices, with_row_index, with_running_sum
from tablewright.sources.scratch import write_scratch

CHUNK = 128


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; ``right`` brings its other columns only."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_r_{k}"]) for k in keys])
    return left.join(named, same, how).drop(*[f"_r_{k}" for k in keys])


def _walk(items: Column, start: Column, move: Callable[[Column, Column], Column]) -> Column:
    """The state before each item of an array."""
    zero = F.struct(start.cast("int").alias("s"), F.array().cast("array<int>").alias("o"))
    return F.aggregate(
        items, zero, lambda a, x: F.struct(move(a["s"], x).cast("int").alias("s"), F.array_append(a["o"], a["s"]).alias("o")), lambda a: a["o"]
    )


def scan_states(
    events: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    states: int,
    start: str,
    step: Callable[[Column, Column], Column],
    out: str,
    sums: Mapping[str, Column] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``out``, the state each event finds: states are 0 .. ``states`` - 1.

    ``start`` is a column with the group's first state, the same in all its rows; ``step(state, event)`` gives the state after an event, whose
    columns are fields of ``event``. ``order`` must be unique inside a group, and columns must be of types that sort. ``sums`` adds running sums over
    the earlier events of the group, which ``step`` can use.
    """
    slices = ordered_slices(events, [*group, *order])
    placed = slices
    for name, value in (sums or {}).items():
        placed = with_running_sum(placed, group, order, value, name)
    placed = with_row_index(placed, group, order, "_pos").drop(SLICE)
    columns = [c for c in placed.columns if c != "_pos"]
    keys = [*group, "_chunk"]
    lists = placed.withColumn("_chunk", F.floor(F.col("_pos") / chunk)).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.struct(*columns).alias("e")))).alias("_events"), F.min(start).cast("int").alias("_start")
    )
    lists = write_scratch(lists, "chunks")

    # only groups that go on after their first chunk need tables; that chunk is full, and no join by group has to bring a group's events into one task
    parts = []
    if not lists.where("_chunk = 1").isEmpty():
        every = F.sequence(F.lit(0), F.lit(states - 1))
        table = F.transform(every, lambda s: F.aggregate("_events", s.cast("int"), lambda a, x: step(a, x["e"]).cast("int")))
        tables = write_scratch(lists.where((F.col("_chunk") > 0) | (F.size("_events") == chunk)).select(*keys, table.alias("_table")), "tables")
        while True:
            above = tables.withColumn("_up", F.floor(F.col("_chunk") / chunk)).groupBy(*group, "_up").agg(
                F.sort_array(F.collect_list(F.struct("_chunk", "_table"))).alias("_parts")
            )
            above = write_scratch(above.withColumnRenamed("_up", "_chunk"), "tables-above")
            parts.append(above)
            if above.where("_chunk > 0").isEmpty():
                break
            composed = F.aggregate("_parts", every.cast("array<int>"), lambda a, p: F.transform(a, lambda s: F.get(p["_table"], s)))
            tables = write_scratch(above.select(*keys, composed.alias("_table")), "tables")
        known = _matched(parts[-1], lists.where("_chunk = 0").select(*group, "_start"), group, "inner").select(*keys, F.col("_start").alias("_state"))
        for above in reversed(parts):
            found = _walk(F.col("_parts"), F.col("_state"), lambda s, p: F.get(p["_table"], s))
            below = _matched(above, known, keys, "inner").select(*group, F.explode(F.arrays_zip(F.col("_parts._chunk").alias("c"), found.alias("s"))).alias("_z"))
            known = write_scratch(below.select(*group, F.col("_z.c").alias("_chunk"), F.col("_z.s").alias("_state")), "chunk-states")
        lists = _matched(lists, known, keys, "left").withColumn("_start", F.coalesce("_state", "_start")).drop("_state")
    found = _walk(F.col("_events"), F.col("_start"), lambda s, x: step(s, x["e"]))
    rows = lists.select(F.explode(F.arrays_zip(F.col("_events.e").alias("e"), found.alias("s"))).alias("_z"))
    return rows.select("_z.e.*", F.col("_z.s").alias(out))
