"""Counts over texts and words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as tx


def age_band_counts(df: DataFrame, col: str) -> DataFrame:
    """(band, rows) of ages given as text; blank text counts as 0."""
    trimmed = F.trim(F.col(col))
    age = F.when(trimmed == "", 0.0).otherwise(trimmed.try_cast("double"))
    band = (
        F.when(age.isNull() | F.isnan(age), "not a number")
        .when((age >= 0) & (age < 18), "0-17")
        .when((age >= 18) & (age < 60), "18-59")
        .when(age > 60, "over 60")
        .otherwise("other")
    )
    return df.groupBy(band.alias("band")).agg(F.count("*").alias("rows"))


def letter_structure(df: DataFrame, text: str, key: str) -> DataFrame:
    """Vowels and consonants (Latin, any case) summed per group."""
    return df.groupBy(key).agg(
        F.sum(tx.vowels(F.col(text)).cast("bigint")).alias("vowels"),
        F.sum(tx.consonants(F.col(text)).cast("bigint")).alias("consonants"),
    )


def palindrome_words(df: DataFrame, text: str) -> DataFrame:
    """(word, rows): lower-cased words that read the same backwards."""
    words = df.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
    word = F.col("word")
    # most words already differ in their first and last letter; only the rest is turned round
    ends = (word != "") & (F.substring(word, 1, 1) == F.substring(word, -1, 1))
    return words.filter(ends & (word == F.reverse(word))).groupBy("word").agg(F.count("*").alias("rows"))
