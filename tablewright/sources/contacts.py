"""Made-up contact data, one contact per given id, the same on every run and on every executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: alphabets, lengths and formats of the contact form
LETTERS = "qwertyuiopasdfghjklzxcvbnm"
MAIL_LETTERS = "asdftopmcgl"
DIGITS = "123456789"
MAIL_DOMAIN = "@mail.ru"
PHONE_PREFIX = "+375"
GROUPS = 20


def _digest(key: Column, seed: int, field: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(field), key.cast("string")))


def _number(digest: Column, at: int) -> Column:
    """Two hex digits of the digest as a number."""
    return F.conv(F.substring(digest, at, 2), 16, 10).cast("int")


def _text(digest: Column, alphabet: str, length: int) -> Column:
    letters = [
        F.substring(F.lit(alphabet), _number(digest, 2 * i + 1) % len(alphabet) + 1, 1) for i in range(length)
    ]
    return F.concat(*letters)


def synth_contacts(df: DataFrame, id_col: str, seed: int = 1) -> DataFrame:
    key = F.col(id_col)
    return df.select(
        id_col,
        _text(_digest(key, seed, "first"), LETTERS, 6).alias("first_name"),
        _text(_digest(key, seed, "middle"), LETTERS, 8).alias("middle_name"),
        _text(_digest(key, seed, "last"), LETTERS, 10).alias("last_name"),
        F.concat(_text(_digest(key, seed, "mail"), MAIL_LETTERS, 10), F.lit(MAIL_DOMAIN)).alias("mail"),
        F.concat(F.lit(PHONE_PREFIX), _text(_digest(key, seed, "mobile"), DIGITS, 9)).alias("mobile"),
        F.concat(F.lit("Group "), (_number(_digest(key, seed, "group"), 1) % GROUPS + 1).cast("string")).alias("group"),
    )
