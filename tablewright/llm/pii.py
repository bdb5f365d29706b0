"""Personal data by patterns, and what gives it away by co-occurrence.

The patterns find protected entities: e-mail addresses, IP addresses, card and phone numbers. Terms in a text with an entity
can reveal it without being it. How much a term t reveals an entity e is estimated from the whole corpus, as the part
of the information in e that t carries:

    disclosure = PMI(t, e) / IC(e) = log(n(t, e) * N / (n(t) * n(e))) / log(N / n(e))

with document counts over all rows. It is 1 if t occurs only with e, 0 if they are independent. A term that reaches
``remove`` is removed, one that reaches ``generalise`` is generalised, wherever it stands in a text with the entity.

Pairs of fewer than ``support`` different texts are no evidence by themselves: any word that occurs once would "disclose" every entity of its
text. They count if the entity itself spells the term (a name in an address), smoothed as if the term stood in ``support`` more
documents without the entity. So the name of someone who is mentioned once is found, and other words of that text stay.

Terms and entities stand together if one text holds both, on whatever lines (``reach`` narrows this to so many characters around an entity). Only the words of
texts with entities are shuffled, once per text; words too frequent to disclose an entity, n(t) > N * (n(e) / N) ** generalise, are left out before they
meet it, as n(t, e) is at most n(e). Entities and terms of fewer than ``support`` texts meet only where the entity spells the term, so a text with very
many addresses is no product of them and its words. The counts n(t) come from one pass over all texts that counts, per batch,
the words that may be such terms (a bitmap of fixed size lets them through) and joins exactly afterwards.

Edge cases: NULL and empty texts have no spans; rows with a NULL doc_id are kept; texts that repeat have the same spans; repeated rows
each give their row; extra columns are left out of `find_spans` and kept by `sanitise`; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bitmap_of, free_names, sliced, text_column, write_scratch

#: Kinds in the order of the contract; terms found by co-occurrence come last.
KINDS = ("email", "ip", "card", "phone", "term", "general")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a number's digits are taken whole: starting later within them could not help
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


@dataclass(frozen=True)
class Settings:
    reach: int | None = None
    support: int = 3
    generalise: float = 0.7
    remove: float = 0.9


def _emails(text: str):
    """An address begins as far left of its @ as its characters go, though not within the address before."""
    last = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each span, by start, then kind. Code points, end exclusive."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    for m in _CARD.finditer(text):
        # length first: it is cheap, and most numbers are short
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            found.append((m.start(), 2, m.end()))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity_of(text: str, span: tuple[int, int, int]) -> str:
    start, kind, end = span
    value = text[start:end].lower()
    return f"{KINDS[kind]}:{value if kind < 2 else _digits(value)}"


def _terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of the words outside all spans, which are sorted."""
    out, at, last = [], 0, -1
    for m in _TERM.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            last = max(last, spans[at][2])
            at += 1
        if last <= m.start():
            out.append((m.group().lower(), m.start(), m.end()))
    return out


def contexts(text: str, spans: list[tuple[int, int, int]], reach: int | None = None) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end): the terms of the text, or those within ``reach`` characters of each span, outside all spans."""
    terms = _terms(text, spans)
    return [
        (entity_of(text, span), *t) for span in spans for t in terms if reach is None or (span[0] - reach <= t[1] and t[2] <= span[2] + reach)
    ]


def _units(text: str, spans: list[tuple[int, int, int]], reach: int | None) -> list[dict]:
    """Entities and terms that stand together, of the whole text or around each span, and the terms that an entity spells itself."""
    if not spans:
        return []
    if reach is None:
        together = [({entity_of(text, s) for s in spans}, {t for t, _, _ in _terms(text, spans)})]
    else:
        near: dict[str, set] = {entity_of(text, s): set() for s in spans}
        for entity, term, _, _ in contexts(text, spans, reach):
            near[entity].add(term)
        together = [({e}, t) for e, t in near.items()]
    # the entity's text after its kind; only addresses have words
    return [
        {
            "entities": sorted(entities), "terms": sorted(terms),
            "spelled": [{"entity": e, "term": t} for e in sorted(entities) for t in sorted(terms & set(_TERM.findall(e.split(":", 1)[1])))],
        }
        for entities, terms in together
    ]


def _scan(docs: DataFrame, reach: int | None) -> DataFrame:
    """(k, key, text) to (k, key, base, units)."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    pair = pa.struct([("entity", pa.string()), ("term", pa.string())])
    unit = pa.list_(pa.struct([("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.string())), ("spelled", pa.list_(pair))]))
    kind = docs.schema["k"].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches, 256):
            base, units = [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text)
                base.append([dict(zip(("start", "kind", "end"), s)) for s in spans])
                units.append(_units(text, spans, reach))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(base, type=span), pa.array(units, type=unit)], names=["k", "key", "base", "units"])

    return docs.mapInArrow(
        run,
        f"k {kind}, key string, base array<struct<start:int,kind:int,end:int>>,"
        " units array<struct<entities:array<string>,terms:array<string>,spelled:array<struct<entity:string,term:string>>>>",
    )


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): in how many rows of ``docs`` (text) each of the terms (term, code) occurs; other terms that the bitmap lets through come along."""
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(terms, "code"))

    def run(batches):
        import xxhash

        # words met before, with whether the bitmap lets them through
        known: dict[str, bool] = {}
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                words = set(_TERM.findall(text.lower()))
                new = [w for w in words if w not in known]
                if new:
                    if len(known) > 100_000:
                        known.clear()
                        new = list(words)
                    codes = np.array([xxhash.xxh64_intdigest(w, 42) for w in new], dtype=np.uint64).view(np.int64)
                    known.update(zip(new, bitmap.value.holds(codes).tolist()))
                counts.update(w for w in words if known[w])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())], names=["term", "n"]
            )

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def disclosing_terms(found: DataFrame, docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(key, term, kind): kind 4 for terms to remove in the texts of ``key``, 5 for terms to generalise. ``found`` comes from `_scan`, ``docs`` has text."""
    s = settings
    n = F.lit(float(max(1, found.count())))
    # rows of one text are one supporting text, but as many documents; its words are shuffled once, as one array
    held = found.where(F.size("units") > 0).groupBy("key").agg(F.count("*").alias("rows"), F.any_value("units").alias("units"))
    units = write_scratch(held.select("key", "rows", F.posexplode("units").alias("unit", "x")).select("key", "rows", "unit", "x.*"), "units")
    entities = units.select("key", "unit", "rows", F.explode("entities").alias("entity"))
    n_e = entities.select("key", "entity", "rows").distinct().groupBy("entity").agg(F.sum("rows").alias("n_e"), F.count("*").alias("texts_e"))
    of = write_scratch(entities.join(n_e.where(F.col("n_e") < n), "entity"), "entities")
    terms = units.select("key", "unit", F.explode("terms").alias("term"))
    spelled = units.select("key", F.explode("spelled").alias("x")).select("key", "x.*")
    enough = terms.groupBy("term").agg(F.count("*").alias("texts_t")).where(F.col("texts_t") >= s.support).select("term")
    asked = write_scratch(enough.unionByName(spelled.select("term")).distinct(), "asked-terms")
    n_t = write_scratch(_document_counts(docs, asked.withColumn("code", F.xxhash64("term"))), "term-counts")
    rare = F.col("n_t") <= n * F.pow(F.col("n_e") / n, F.lit(s.generalise)) * (1 + 1e-6)
    names = ["key", "entity", "term", "rows", "n_e", "n_t"]
    # entities of too few texts meet no other terms than those they spell; the joins are merges at every size
    often = of.where(F.col("texts_e") >= s.support)
    met = often.join(terms.join(n_t.hint("merge"), "term").hint("merge"), ["key", "unit"]).where(rare).select(*names).distinct()
    own = of.select("key", "entity", "rows", "n_e").distinct().join(spelled, ["key", "entity"]).join(n_t, "term").where(rare)
    told = spelled.distinct().withColumn("spells", F.lit(True))
    pairs = met.unionByName(own.select(*names)).distinct().join(told, ["key", "entity", "term"], "left")
    pairs = write_scratch(pairs, "disclosure")
    together = pairs.groupBy("entity", "term").agg(
        F.sum("rows").alias("n_te"), F.count("*").alias("texts"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"),
        F.max("spells").alias("spells"),
    )
    together = together.where((F.col("texts") >= s.support) | F.col("spells"))
    seen = F.col("n_t") + F.when(F.col("texts") < s.support, s.support).otherwise(0)
    told = F.log(F.col("n_te") * n / (seen * F.col("n_e"))) / F.log(n / F.col("n_e"))
    chosen = together.withColumn("disclosure", F.round(told, 9)).where(F.col("disclosure") >= s.generalise).select(
        "entity", "term", F.when(F.col("disclosure") >= s.remove, 4).otherwise(5).alias("kind")
    )
    return pairs.select("key", "entity", "term").join(chosen, ["entity", "term"]).groupBy("key", "term").agg(F.min("kind").alias("kind"))


def _terms_of_texts(told: DataFrame) -> DataFrame:
    """(key, terms): the disclosing terms of each text, at most its distinct words."""
    return told.groupBy("key").agg(F.collect_list(F.struct("term", "kind")).alias("terms"))


def term_spans(text: str, spans: list[tuple[int, int, int]], told: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every occurrence of the terms, outside all spans."""
    return [(a, told[t], b) for t, a, b in _terms(text, spans) if t in told]


def _may_have(terms: DataFrame):
    """A column function that tells by a bitmap which digests of texts may be among (key)."""
    bitmap = terms.sparkSession.sparkContext.broadcast(bitmap_of(terms.select(F.xxhash64("key").alias("code")), "code"))

    @F.pandas_udf("boolean")
    def may_have(codes):
        import pandas as pd

        return pd.Series(bitmap.value.holds(codes.to_numpy(dtype=np.int64)))

    return bitmap, may_have


def _term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, terms): the spans of the disclosing terms of each text that has any."""
    _, may_have = _may_have(terms)
    maybe = write_scratch(docs.select("key", "text").where(may_have(F.xxhash64("key"))), "maybe-terms")
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in sliced(batches, 256):
            out = []
            for text, told in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = term_spans(text, base_spans(text), {t["term"]: t["kind"] for t in told})
                out.append([dict(zip(("start", "kind", "end"), x)) for x in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=span)], names=["key", "terms"])

    joined = maybe.join(terms, "key").select("key", "text", "terms")
    spans = joined.mapInArrow(run, "key string, terms array<struct<start:int,kind:int,end:int>>")
    return spans.groupBy("key").agg(F.any_value("terms").alias("terms"))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: key, base and spans (arrays of start, kind as a place in KINDS, end; by start, then kind)."""
    plain = docs.select(F.col(key).alias("k"), F.md5(text_column(text)).alias("key"), text_column(text).alias("text"))
    found = write_scratch(_scan(plain, settings.reach), "spans")
    told = write_scratch(_terms_of_texts(disclosing_terms(found, plain, settings)), "terms-of-texts")
    terms = _term_spans(plain, told)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.join(terms, "key", "left").select(
        F.col("k").alias(key), "base", F.sort_array(F.concat("base", F.coalesce("terms", none))).alias("spans")
    )


def as_text(spans: str):
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, digest of the base spans, all spans as text."""
    counts = [_count(kind).alias(f"n_{KINDS[kind]}") for kind in range(4)]
    return spans.select(key, *counts, F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))


def _count(kind: int):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def cover(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans replaced: entities by their kind, general terms by a placeholder, the others by nothing."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if end <= at:
            continue
        # of spans that overlap, what the earlier one left over is covered too
        out.append(text[at:start])
        out.append("" if kind == 4 else f"[{KINDS[kind].upper()}]" if start >= at else "")
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text", length: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with all their columns, spans in the text replaced; ``length`` names a column that holds the text's length."""
    plain = docs.select(F.lit(0).alias("k"), F.md5(text_column(text)).alias("key"), text_column(text).alias("text"))
    found = write_scratch(_scan(plain, settings.reach), "spans")
    terms = write_scratch(_terms_of_texts(disclosing_terms(found, plain, settings)), "terms-of-texts")
    # only texts that may have such terms are joined, the rest is covered where it is
    bitmap, may_have = _may_have(terms)

    def one(t, told):
        spans = base_spans(t)
        if told is not None:
            spans += term_spans(t, spans, {x["term"]: x["kind"] for x in told})
        return cover(t, spans) if spans else t

    @F.pandas_udf("string")
    def covered(texts, more):
        import pandas as pd

        return pd.Series([one(t, m) for t, m in zip(texts, more)])

    @F.pandas_udf("string")
    def covered_alone(texts, codes):
        """NULL for texts that the bitmap leaves to the join."""
        import pandas as pd

        held = bitmap.value.holds(codes.to_numpy(dtype=np.int64))
        return pd.Series([None if h else one(t, None) for t, h in zip(texts, held)])

    digest, new, told = free_names([*docs.columns, "key", "terms"], "digest", "new_text", "told")
    keyed = docs.withColumn(digest, F.md5(text_column(text)))
    rest = keyed.withColumn(new, covered_alone(text_column(text), F.xxhash64(digest))).where(F.col(new).isNotNull())
    # written, so that no task has two Python stages, and so two sets of workers, at once
    maybe = write_scratch(keyed.where(may_have(F.xxhash64(digest))), "maybe-terms")
    joined = maybe.join(terms.withColumnsRenamed({"key": digest, "terms": told}), digest, "left").withColumn(new, covered(text_column(text), F.col(told)))
    out = rest.unionByName(joined.select(*rest.columns)).withColumn(text, F.when(F.col(text).isNotNull(), F.col(new)))
    if length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(length).isNotNull(), F.length(F.col(text)).cast(kind)))
    return out.select(*docs.columns)
