"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the name pattern (two words, Latin or Cyrillic) and the letter classes
NAME_PATTERN = "^[a-zA-Zа-яА-ЯёЁ'-]+([^a-zA-Zа-яА-ЯёЁ'-]+[a-zA-Zа-яА-ЯёЁ'.-]+){1,}$"
VOWELS = "eyuioa"
CONSONANTS = "qwrtpsdfghjklzxcvbnm"


def fn_check_name(name: Column) -> Column:
    """1 if the name has at least two words and a dot, else 0."""
    proper = name.rlike(NAME_PATTERN) & name.contains(".")
    return F.when(proper, 1).otherwise(0)


def _letters_of(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are among ``letters``, in any case: what is lost by taking them out."""
    lowered = F.lower(text)
    return F.length(lowered) - F.length(F.translate(lowered, letters, ""))


def vowels(text: Column) -> Column:
    return _letters_of(text, VOWELS)


def consonants(text: Column) -> Column:
    return _letters_of(text, CONSONANTS)


def changed_message(before: Column, after: Column) -> Column:
    return F.concat(
        F.lit("Value ["), before.cast("string"), F.lit("] was automatically changed to ["),
        after.cast("string"), F.lit("]"),
    )
