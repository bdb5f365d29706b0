"""Chat formatting with Spark expressions only.

Turns are collected as structs, sorted, adjacent turns of one role are merged with array aggregation, and the text of
a conversation is concatenated. A long conversation is first put together in slices of turns, each by a task of its
own; then the slices' blocks are joined in order. The whole conversation is one row at the end, since that is what the format is.

The format of a block: OPEN role NEWLINE text (NEXT text)* CLOSE. NEXT stands between the turns of one role that were merged, so that
every turn can be read back. Control strings inside roles and texts are escaped: ESCAPE itself becomes ESCAPE 0, the n-th
control string becomes ESCAPE and the n-th code letter. An escaped text holds no control string, and every ESCAPE in it is followed by its
code, so `unescape` gives the text back.

Edge cases: NULL text or role counts as empty; a NULL turn number sorts first; turns that share a number are ordered by role, then text;
repeated rows are turns like any other; rows with a NULL conv_id form one conversation; adjacent turns of one role are one block;
extra columns are left out; a table without rows gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns put together by one task before the slices of a conversation are joined.
SLICE_TURNS = 512


@dataclass(frozen=True)
class Template:
    """Marks of the format, and further strings that a trained model would take as control strings."""

    open: str = "<|turn|>"
    next: str = "<|next|>"
    close: str = "<|end|>\n"
    escape: str = "\u001b"
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
    learned: str = "assistant"

    @property
    def control(self) -> list[tuple[str, str]]:
        """Control strings with their codes; a mark counts without its line break."""
        marks = [self.open.strip(), self.next.strip(), self.close.strip(), *self.others]
        return [(mark, chr(ord("a") + k)) for k, mark in enumerate(marks)]

    def escaped(self, text: Column) -> Column:
        text = F.replace(text, F.lit(self.escape), F.lit(self.escape + "0"))
        for mark, code in self.control:
            text = F.replace(text, F.lit(mark), F.lit(self.escape + code))
        return text

    def escaped_role(self, role: Column) -> Column:
        """A role is one line, so its line breaks are escaped as well."""
        return F.replace(self.escaped(role), F.lit("\n"), F.lit(self.escape + "1"))

    def unescaped(self, text: Column) -> Column:
        for mark, code in self.control:
            text = F.replace(text, F.lit(self.escape + code), F.lit(mark))
        text = F.replace(text, F.lit(self.escape + "1"), F.lit("\n"))
        return F.replace(text, F.lit(self.escape + "0"), F.lit(self.escape))


def _runs(items: str, texts_of) -> Column:
    """Array column ``items`` of structs with a role to blocks (role, texts): a block begins where the role differs from the item before.

    Each array expression stands outside the lambdas that go through its elements, so the work stays in proportion to the array.
    """
    array = F.col(items)
    begins = F.filter(
        F.sequence(F.lit(1), F.size(array)),
        lambda i: (i == 1) | (F.element_at(array, i)["role"] != F.element_at(array, F.greatest(i - 1, F.lit(1)))["role"]),
    )
    # each start with the start after it; the last one ends behind the array
    spans = F.zip_with(begins, F.slice(begins, 2, F.size(array)), lambda a, b: F.struct(a.alias("a"), F.coalesce(b, F.size(array) + 1).alias("b")))
    return F.transform(
        spans,
        lambda s: F.struct(
            F.element_at(array, s["a"])["role"].alias("role"), texts_of(F.slice(array, s["a"], s["b"] - s["a"])).alias("texts")
        ),
    )


def format_chats(
    turns: DataFrame, template: Template = Template(), key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    slice_turns: int = SLICE_TURNS,
) -> DataFrame:
    """One row per conversation: key, formatted (string), n_blocks."""
    plain = turns.select(
        F.col(key).alias("k"),
        F.col(turn).alias("turn"),
        template.escaped_role(F.coalesce(F.col(role), F.lit(""))).alias("role"),
        template.escaped(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    # NULL turns go to the first slice, in front of all others
    no = F.coalesce(F.floor(F.col("turn") / F.lit(slice_turns)), F.lit(-(2**62))).cast("long")
    slices = (
        plain.withColumn("no", no).groupBy("k", "no")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select("k", F.struct("no", _runs("turns", lambda part: F.transform(part, lambda t: t["text"])).alias("blocks")).alias("slice"))
    )
    # one role may go on from slice to slice, so the blocks of all slices are put in order and merged once more
    whole = slices.groupBy("k").agg(F.sort_array(F.collect_list("slice")).alias("slices"))
    flat = whole.select("k", F.flatten(F.transform("slices", lambda s: s["blocks"])).alias("flat"))
    blocks = flat.select("k", _runs("flat", lambda part: F.flatten(F.transform(part, lambda b: b["texts"]))).alias("blocks"))
    pieces = F.transform(
        F.col("blocks"),
        lambda b: F.concat(F.lit(template.open), b["role"], F.lit("\n"), F.array_join(b["texts"], template.next), F.lit(template.close)),
    )
    return blocks.select(F.col("k").alias(key), F.array_join(pieces, "").alias("formatted"), F.size("blocks").cast("long").alias("n_blocks"))


def read_back(formatted: DataFrame, template: Template = Template(), column: str = "formatted") -> DataFrame:
    """``formatted`` with turns: array of (role, text), read from the formatted text alone."""
    body = F.filter(F.split(F.col(column), _literal(template.close)), lambda b: b != F.lit(""))
    parsed = F.transform(
        body,
        lambda b: F.struct(
            F.substr(F.substring_index(b, "\n", 1), F.lit(len(template.open) + 1)).alias("role"),
            F.split(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2), _literal(template.next)).alias("texts"),
        ),
    )
    turns = F.transform(
        parsed,
        lambda p: F.transform(
            p["texts"], lambda t: F.struct(template.unescaped(p["role"]).alias("role"), template.unescaped(t).alias("text"))
        ),
    )
    return formatted.withColumn("turns", F.flatten(turns))


def _literal(mark: str) -> str:
    """A split pattern that takes the mark as it is."""
    return "\\Q" + mark + "\\E"


def digests(formatted: DataFrame, template: Template = Template(), key: str = "conv_id") -> DataFrame:
    """What was formatted, read back: turns and their digest, the learned text under the loss mask and its digest."""
    back = read_back(formatted, template)
    learned = F.array_join(
        F.transform(F.filter("turns", lambda t: t["role"] == F.lit(template.learned)), lambda t: t["text"]), ""
    )
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
