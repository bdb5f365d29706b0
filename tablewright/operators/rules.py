"""Row rules and corrections on incoming rows.

Rules do not abort: each row gets the array of rule codes it breaks. ``split`` parts valid from
rejected rows, ``require_valid`` raises if anything is rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewright.functions.dates import fn_all_broken_dates
from tablewright.functions.text import changed_message, fn_check_name
from tablewright.operators.automata import CHUNK, scan_states
from tablewright.operators.numbering import running_sum
from tablewright.sources.scratch import scratch_path, write_scratch

BROKEN = "broken"


def flag_rules(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    codes = F.array_compact(F.array(*[F.when(cond, code) for code, cond in rules.items()]))
    return rows.withColumn(BROKEN, codes)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected)."""
    clean = F.size(BROKEN) == 0
    return flagged.filter(clean).drop(BROKEN), flagged.filter(~clean)


def split_once(flagged: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(valid, rejected, how many of each): written by verdict in one pass over the input, counted on the way.

    ``path`` is a new folder, by default in the scratch folder. Each part reads its own files only.
    """
    path = path or scratch_path(flagged.sparkSession, "verdicts")
    clean = F.size(BROKEN) == 0
    seen = Observation()
    judged = flagged.observe(seen, F.count(F.when(clean, 1)).alias("valid"), F.count(F.when(~clean, 1)).alias("rejected"))
    judged.withColumn("_verdict", F.when(clean, "valid").otherwise("rejected")).write.partitionBy("_verdict").parquet(path)
    both = flagged.sparkSession.read.schema(flagged.withColumn("_verdict", F.lit("")).schema).parquet(path)
    valid = both.where("_verdict = 'valid'").drop("_verdict", BROKEN)
    return valid, both.where("_verdict = 'rejected'").drop("_verdict"), seen.get


def require_valid(flagged: DataFrame) -> DataFrame:
    """The rows, if none is rejected; else an error naming one of them."""
    rejected = split(flagged)[1].take(1)
    if rejected:
        raise ValueError(f"rejected: {rejected[0]}")
    return flagged.drop(BROKEN)


def rule_dates(rows: DataFrame, start: str, end: str, is_insert: Column, as_of: Column) -> DataFrame:
    """1: start in the future; 2: finish in the past, on insert; 3: finish before start."""
    numbers = fn_all_broken_dates(F.col(start), F.col(end), is_insert, as_of)
    return rows.withColumn(BROKEN, F.transform(numbers, lambda n: n.cast("string")))


def rule_max_active(
    changes: DataFrame, loans: DataFrame, person: str, seq: str, active: Column, is_insert: Column, limit: int = 10
) -> DataFrame:
    """Reject a loan for someone who already has ``limit`` active ones.

    An insert also counts the person's active inserts before it in the batch: until the limit is
    reached all of them are accepted, afterwards none is, so their plain running sum decides. An
    update is judged by the stored loans alone.
    """
    stored = loans.filter(active).groupBy(person).agg(F.count("*").alias("_stored"))
    adds = F.when(is_insert & active, 1).otherwise(0)
    ahead = running_sum(changes, [person], [seq], adds, "_ahead")
    held = F.coalesce("_stored", F.lit(0)) + F.when(is_insert, F.col("_ahead")).otherwise(0)
    flagged = flag_rules(ahead.join(stored, person, "left"), {"max_active": held >= limit})
    return flagged.select(*changes.columns, BROKEN)


def rule_max_active_feed(
    feed: DataFrame, loans: DataFrame, person: str, active: Callable[[Column], Column], limit: int = 10, chunk: int = CHUNK
) -> DataFrame:
    """A change feed (seq, op, old, new) with ``broken``: inserts and updates for someone who then has ``limit`` active loans.

    Changes are judged one after the other by ``seq``: a delete or an accepted update that ends a loan frees its place, a rejected change has
    no effect. ``active`` tells from a row (a struct) whether its loan is active; ``loans`` are the rows before the feed.

    Below the limit a person's count is the state of a machine; above it (stored loans may exceed a limit) only deletes count, so
    a running sum of them tells where the machine sets in. An update that passes a loan on takes it from its old owner only if the new
    owner may have it, so such feeds are judged again, with what is known to be rejected left out, until nothing changes: the n-th such
    change of a chain is right after n rounds.
    """
    stored = loans.where(active(F.struct(*loans.columns))).groupBy(person).agg(F.count("*").alias("_stored"))
    old, new = F.col("old"), F.col("new")
    was = F.when(old.isNotNull() & active(old), 1).otherwise(0)
    now = F.when(new.isNotNull() & active(new), 1).otherwise(0)
    passed = (F.col("op") == "update") & ~old[person].eqNullSafe(new[person])
    told = feed.select(
        "seq", "op", F.when(F.col("op") == "delete", old[person]).otherwise(new[person]).alias("_who"), old[person].alias("_from"),
        F.when(passed, now).otherwise(now - was).alias("_delta"), (passed & (was == 1)).alias("_leaves"),
    )
    told = write_scratch(told, "feed-told")
    main = told.select("seq", "_who", (F.col("op") != "delete").alias("_gated"), "_delta")
    leaving = told.where("_leaves").select("seq", F.col("_from").alias("_who"), F.lit(False).alias("_gated"), F.lit(-1).alias("_delta"))
    passes = not leaving.isEmpty()
    rejected = None
    while True:
        events = main
        if passes:
            gone = leaving if rejected is None else leaving.join(rejected, "seq", "left_anti")
            events = main.unionByName(gone)
        events = events.join(stored, events["_who"].eqNullSafe(stored[person]), "left").drop(stored[person]).withColumn("_stored", F.coalesce("_stored", F.lit(0)))
        events = events.withColumn("_start", F.least("_stored", F.lit(limit)))

        def high(e: Column) -> Column:
            return e["_stored"] - e["_freed"] > limit

        def step(count: Column, e: Column) -> Column:
            stays = high(e) | (e["_gated"] & (count >= limit))
            return F.when(stays, count).otherwise(F.greatest(count + e["_delta"], F.lit(0)))

        ends = F.when(~F.col("_gated"), -F.col("_delta")).otherwise(0)
        found = scan_states(events, ["_who"], ["seq", "_gated"], limit + 1, "_start", step, "_count", {"_freed": ends}, chunk)
        judged = found.where("_gated").select("seq", ((F.col("_stored") - F.col("_freed") > limit) | (F.col("_count") >= limit)).alias("_over"))
        if not passes:
            break
        judged = write_scratch(judged, "feed-judged")
        again = judged.where("_over").join(leaving, "seq", "left_semi").select("seq")
        if rejected is not None and again.exceptAll(rejected).isEmpty() and rejected.exceptAll(again).isEmpty():
            break
        rejected = again
    over = F.array_compact(F.array(F.when(F.coalesce("_over", F.lit(False)), F.lit("max_active"))))
    return feed.join(judged, "seq", "left").withColumn(BROKEN, over).select(*feed.columns, BROKEN)


def rule_no_reactivation(changes: DataFrame, was_active: Column, is_active: Column) -> DataFrame:
    return flag_rules(changes, {"reactivated": ~was_active & is_active})


def rule_name_format(rows: DataFrame, name: str) -> DataFrame:
    return flag_rules(rows, {"name_format": fn_check_name(F.col(name)) == 0})


def rule_year_window(rows: DataFrame, year: Column, as_of: Column, limit: int = 100) -> DataFrame:
    return flag_rules(rows, {"too_old": F.year(as_of) - year > limit})


def _corrected(rows: DataFrame, col: str, wrong: Column, value: Column) -> DataFrame:
    fixed = rows.withColumn("_new", F.when(wrong, value).otherwise(F.col(col)))
    message = F.when(wrong, changed_message(F.col(col), F.col("_new")))
    return fixed.withColumn("message", message).withColumn(col, F.col("_new")).drop("_new")


def fix_trailing_dot(rows: DataFrame, name: str) -> DataFrame:
    """Append a missing dot; ``message`` tells what changed."""
    return _corrected(rows, name, ~F.col(name).endswith("."), F.concat(F.col(name), F.lit(".")))


def fix_finish_date(rows: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """Finish becomes two months after ``as_of`` when it is past or before the start."""
    wrong = (F.col(end) < F.col(start)) | (F.col(end) < as_of)
    return _corrected(rows, end, wrong, F.add_months(as_of, 2))
