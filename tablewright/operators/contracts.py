"""Checks on JSON documents, on state sequences, and values taken out of HTML."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.automata import CHUNK, scan_states
from tablewright.operators.numbering import adjacent


def json_contract_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, passed, failed): all rules counted in one pass. A rule that cannot be decided has failed."""
    held = {name: F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.when(cond, 1)).alias(name) for name, cond in held.items()],
    )
    return counts.unpivot("_rows", list(rules), "rule", "passed").select(
        "rule", "passed", (F.col("_rows") - F.col("passed")).alias("failed")
    )


def contract_rules(
    body: str, fields: Sequence[str], equals: Mapping[str, str] | None = None,
    elapsed: Column | None = None, limit: float = 1000.0,
) -> dict[str, Column]:
    """The usual checks of a response: is JSON, has its fields, first field set and not blank, exact values, fast."""
    parsed = F.try_parse_json(body)

    def text(field: str) -> Column:
        return F.try_variant_get(parsed, f"$.{field}", "string")

    has_all = F.lit(True)
    for field in fields:
        has_all = has_all & F.array_contains(F.json_object_keys(body), field)
    rules = {
        "is_json": parsed.isNotNull(),
        "has_fields": has_all,
        "not_null": text(fields[0]).isNotNull(),
        "not_empty": text(fields[0]) != "",
    }
    for field, value in (equals or {}).items():
        rules[f"equals_{field}"] = text(field) == value
    if elapsed is not None:
        rules["fast"] = elapsed < limit
    return rules


def json_schema_check(df: DataFrame, body: str, schema: Mapping[str, str], out: str = "problems") -> DataFrame:
    """Add the array of fields that are missing or of another type.

    Types are those of ``schema_of_variant``, in lower case (string, bigint, array<string>, ...); an empty
    array fits any array type. Text that is no JSON object reports 'not an object'.
    """
    parsed = F.col("_parsed")

    def fits(field: str, kind: str) -> Column:
        found = F.lower(F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant")))
        same = found == kind.lower()
        return same | (found == "array<void>") if kind.lower().startswith("array<") else same

    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    bad = F.array_compact(
        F.array(*[F.when(~F.coalesce(fits(f, k), F.lit(False)), f) for f, k in schema.items()])
    )
    # parsed once per row, in its own projection
    ready = df.withColumn("_parsed", F.try_parse_json(body))
    return ready.withColumn(out, F.when(is_object, bad).otherwise(F.array(F.lit("not an object")))).drop("_parsed")


def json_exact_body(df: DataFrame, body: str, expected: Mapping, out: str = "same") -> DataFrame:
    """Whether a document equals ``expected`` whatever its spacing and field order, with no field more or less."""
    want = F.lit(json.dumps(expected, ensure_ascii=False))
    shape = F.schema_of_json(want)
    same_values = F.from_json(body, shape).eqNullSafe(F.from_json(want, shape))
    same_shape = F.schema_of_variant(F.try_parse_json(body)).eqNullSafe(F.schema_of_variant(F.parse_json(want)))
    return df.withColumn(out, same_values & same_shape)


def status_flow_audit(
    df: DataFrame, key: str, order: Sequence[str], state: str, allowed: Sequence[tuple[str | None, str]]
) -> DataFrame:
    """(key, steps, violations): steps not in ``allowed`` (from, to); from None is the first state.

    The events of a hot key may lie in many tasks.
    """
    rows = df.select(key, *order, state, F.lit(True).alias("_here"))
    near = adjacent(rows, [key], list(order), {state: "_before", "_here": "_same"})
    fine = F.lit(False)
    for before, after in allowed:
        came_from = F.col("_same").isNull() if before is None else F.col("_before").eqNullSafe(F.lit(before))
        fine = fine | (came_from & F.col(state).eqNullSafe(F.lit(after)))
    return near.groupBy(key).agg(F.count("*").alias("steps"), F.count(F.when(~fine, 1)).alias("violations"))


def status_flow_machine(
    df: DataFrame, key: str, order: Sequence[str], state: str, allowed: Sequence[tuple[str | None, str]], chunk: int = CHUNK
) -> DataFrame:
    """(key, steps, violations, reached): each step judged from the state that was really reached; a wrong step does not move on.

    The states form a machine whose moves are ``allowed`` (from, to); from None is where every key begins, and ``reached`` is NULL for a key that never got on.
    """
    names = sorted({name for pair in allowed for name in pair if name is not None})
    number = {None: 0} | {name: i + 1 for i, name in enumerate(names)}
    moves = [F.lit(number[before] * (len(names) + 1) + number[after]) for before, after in allowed]
    known = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(number[name]))])
    # a state no move leads to is a wrong step wherever it comes
    rows = df.select(key, *order, F.coalesce(F.try_element_at(known, F.col(state)), F.lit(-1)).alias("_to"), F.lit(0).alias("_start"))

    def fine(now: Column, to: Column) -> Column:
        return (to > 0) & F.array_contains(F.array(*moves), now * (len(names) + 1) + to)

    def step(now: Column, e: Column) -> Column:
        return F.when(fine(now, e["_to"]), e["_to"]).otherwise(now)

    found = scan_states(rows, [key], list(order), len(names) + 1, "_start", step, "_now", chunk=chunk)
    judged = found.withColumn("_fine", fine(F.col("_now"), F.col("_to")))
    after = F.when(F.col("_fine"), F.col("_to")).otherwise(F.col("_now"))
    told = judged.groupBy(key).agg(
        F.count("*").alias("steps"), F.count(F.when(~F.col("_fine"), 1)).alias("violations"), F.max_by(after, F.struct(*order)).alias("_last")
    )
    return told.select(key, "steps", "violations", F.get(F.array(F.lit(None).cast("string"), *[F.lit(n) for n in names]), F.col("_last")).alias("reached"))


# comments, scripts and styles hold no tags
_NO_TAGS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# a name, and a value in double quotes, in single quotes or bare
_ATTRIBUTE = r"""(?s)([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""


def html_attr_extract(df: DataFrame, html: str, tag: str, attr: str, keep: Sequence[str], match: tuple[str, str] | None = None) -> DataFrame:
    """(keep, position, value): ``attr`` of every ``tag``, in document order; names in any case, ``>`` allowed inside quotes.

    ``match`` = (other attribute, its value) narrows to tags that bear it. Of an attribute written twice the first counts.
    """
    # most pages have nothing to cut out, and many not one such tag
    holds_other = F.col(html).rlike(r"(?i)<!--|<script|<style")
    body = F.when(holds_other, F.regexp_replace(F.col(html), F.lit(_NO_TAGS), F.lit(""))).otherwise(F.col(html))
    df = df.filter(holds_other | F.col(html).rlike(rf"(?i)<{tag}[\s/>]"))
    pattern = rf"""(?is)<{tag}((?:[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+)?)>"""
    found = df.select(*keep, F.posexplode(F.regexp_extract_all(body, F.lit(pattern), F.lit(1))).alias("position", "_tag"))
    names = F.transform(F.regexp_extract_all("_tag", F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all("_tag", F.lit(_ATTRIBUTE), F.lit(2))
    read = found.withColumns({"_names": names, "_values": values})

    def value(name: str) -> Column:
        quoted = F.get("_values", F.array_position("_names", name.lower()).cast("int") - 1)
        return F.when(F.array_contains("_names", name.lower()), F.regexp_replace(quoted, F.lit(r"""^["']|["']$"""), F.lit("")))

    read = read.select(*keep, "position", value(attr).alias("value"), *([value(match[0]).alias("_other")] if match else []))
    if match is not None:
        read = read.filter(F.col("_other") == match[1])
    return read.filter(F.col("value").isNotNull()).select(*keep, "position", "value")
