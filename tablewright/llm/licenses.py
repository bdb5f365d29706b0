"""Licence scans by a positional rare-token index, in DataFrame functions only.

The index holds, for every licence template, its words with their positions (postings) and its mandatory key phrase. Each word weighs by
how rare it is among the files (an integer level of inverse document frequency, counted over the whole table). Every template has
an anchor: the rarest word of its key phrase. A file is scanned for its rarest licence words, the anchors: where an anchor
stands at word i of the file and at position j of the template, the template would begin at i - j. There the key phrase must
stand word for word; the other postings are then counted at the same relative position, and the share of the template's
weight that stands there is the score of that place.

The template table is a fixed list in this module (some dozens of postings), so it goes into the plan as literals. A file is one
row all the way, so nothing is shuffled but the document frequencies of the template words.

Edge cases: NULL and empty texts have no words, no labels and score 0; repeated rows each give their row; rows with a NULL doc_id
are kept; a phrase counts at every place, also where places overlap; extra columns are left out; a table without rows gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import text_column

#: What a word is: letters and digits of ASCII, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A template is found where at least this share of its weight stands (and its key phrase in full).
THRESHOLD = 0.6


@dataclass(frozen=True)
class Template:
    """``words``: the whole template; ``key``: its mandatory phrase, a part of it, word for word."""

    label: str
    words: str
    key: str
    base: bool = False


# fixed values: phrases that the query's contract names, then wordings of common licence notes
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "under the terms of the gnu affero general public license version 3", "gnu affero general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission to use copy modify and or distribute this software"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def _position(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def levels(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Integer rarity of each template word: the number of binary digits of (files + 1) div (files with the word + 1).

    One pass over all files. The result has one row per template word, a number this module fixes.
    """
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    per_file = docs.select(F.array_intersect("words", _strings(vocabulary)).alias("found"))
    # NULL stands for the file itself, so that one aggregation counts the files as well
    counted = per_file.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), "found")).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}
    files = counts.get(None, 0)
    return {w: ((files + 1) // (counts.get(w, 0) + 1)).bit_length() for w in vocabulary}


def with_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and words: the words of each whole text, A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # one pass of a regular expression; splitting leaves an empty string where a text begins or ends with a gap
    words = F.split(F.translate(text_column(text), upper, lower), GAP)
    return docs.select(F.col(key).alias("k"), F.array_remove(words, "").alias("words"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: key, n_words, places (array of label, at, base, share), sorted."""
    split = with_words(docs, key, text)
    rarity = levels(split, templates)

    index = []
    for t in templates:
        words, phrase = t.words.split(), t.key.split()
        start = _position(words, phrase)
        # the rarest word of the key phrase; of equally rare ones the one that sorts first
        anchor = max(range(len(phrase)), key=lambda i: (rarity[phrase[i]], [-ord(c) for c in phrase[i]], -i))
        index.append((t, words, phrase, start, anchor))
    anchors = sorted({phrase[anchor] for _, _, phrase, _, anchor in index})

    # each file's rarest licence words with their positions; most files have none and stop here
    rare = _strings(anchors)
    hits = F.when(
        F.arrays_overlap("words", rare),
        F.filter(
            F.transform("words", lambda w, i: F.when(F.array_contains(rare, w), F.struct(w.alias("word"), i.alias("at")))),
            lambda h: h.isNotNull(),
        ),
    ).otherwise(F.array().cast("array<struct<word:string,at:int>>"))
    found = split.select("k", "words", hits.alias("hits"))

    kinds = "array<struct<label:string,at:int,base:boolean,share:double>>"
    places = [_places(*entry, rarity, threshold) for entry in index]
    listed = F.when(F.size("hits") > 0, F.concat(*places)).otherwise(F.array().cast(kinds)).cast(kinds)
    return found.select(F.col("k").alias(key), F.size("words").cast("long").alias("n_words"), F.array_sort(listed).alias("places"))


def _places(t: Template, words: list[str], phrase: list[str], start: int, anchor: int, rarity: dict[str, int], threshold: float) -> Column:
    """Where one template stands, from the positions of its anchor: array of (label, at, base, share); ``at`` is where the key phrase begins."""
    total = sum(rarity[w] for w in words)

    def weight(at: Column) -> Column:
        got = F.lit(0)
        for j, w in enumerate(words):
            place = at + (j - start)
            got = got + F.when((place >= 0) & (F.get("words", place) == F.lit(w)), F.lit(rarity[w])).otherwise(F.lit(0))
        return got

    def stands(at: Column) -> Column:
        """The mandatory phrase, word for word."""
        return (at >= 0) & (F.slice("words", F.greatest(at, F.lit(0)) + 1, F.lit(len(phrase))) == _strings(phrase))

    begins = F.transform(F.filter("hits", lambda h: h["word"] == F.lit(phrase[anchor])), lambda h: h["at"] - anchor)
    marked = F.transform(
        F.filter(begins, stands),
        lambda at: F.struct(
            F.lit(t.label).alias("label"), at.alias("at"), F.lit(t.base).alias("base"),
            F.round(weight(at) / F.lit(float(total)), 6).alias("share"),
        ),
    )
    return F.filter(marked, lambda p: p["share"] >= F.lit(threshold))


def report(places: DataFrame, key: str = "doc_id") -> DataFrame:
    """Places to one summary row each: how many base places, where they begin and end, labels, best share."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["at"].cast("long"))

    def names(array: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(array, lambda p: p["label"]))), ",")

    return places.select(
        key, "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
