"""Summary tables kept up to date from a change feed.

A feed has one row per change: ``seq``, ``op`` (insert, update, delete), and the row before (``old``)
and after (``new``) as structs, NULL where there is none. Each job takes the present state and one
batch and returns the next state; the result equals recomputing it from the changed tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.sources.scratch import write_scratch


def signed_rows(feed: DataFrame) -> DataFrame:
    """-1 for each old row and +1 for each new row, with the row's columns."""
    both = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")),
    )
    return (
        feed.select(F.explode(both).alias("c"))
        .filter(F.col("c.row").isNotNull())
        .select("c.sign", "c.row.*")
    )


def net_changes(feed: DataFrame, key: str) -> DataFrame:
    """(key, row): what a batch leaves of each key it touches; ``row`` is NULL where the key is gone at the end.

    A key may change several times in a batch; its changes count in the order of ``seq``. The job ends with an error where they can't
    follow each other (two inserts of a key, or two deletes), or where a feed without ``seq`` changes a key more than once. Each key is one row of sums and
    extremes combined on the map side, however often it changes.
    """
    ordered = "seq" in feed.columns
    seq = F.col("seq") if ordered else F.lit(0)
    both = F.array(
        F.struct(seq.alias("seq"), F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(seq.alias("seq"), F.lit(1).alias("sign"), F.col("new").alias("row"))
    )
    signed = feed.select(F.explode(both).alias("c")).filter(F.col("c.row").isNotNull()).select(F.col(f"c.row.{key}").alias(key), "c.*")
    at = F.struct("seq", "sign")
    net = signed.groupBy(key).agg(
        F.sum("sign").alias("_sum"), F.count("*").alias("_n"), F.min_by("sign", at).alias("_first"), F.max_by(F.struct("sign", "row"), at).alias("_last")
    )
    # removals and arrivals take turns, so their sum is the first one's sign, or zero if the last one is of the other kind
    fits = F.col("_sum") == F.when(F.col("_first") == F.col("_last.sign"), F.col("_first")).otherwise(0)
    if not ordered:
        fits = fits & (F.col("_n") <= 2) & ~((F.col("_n") == 2) & (F.col("_sum") != 0))
    message = F.concat(F.lit("changes do not follow each other for key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(fits, F.col("_last.sign")).otherwise(F.raise_error(message).cast("int"))
    return net.select(key, F.when(checked > 0, F.col("_last.row")).alias("row"))


def apply_changes(base: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """The table after the batch, in which a key may change several times (see ``net_changes``)."""
    net = net_changes(feed, key)
    arrived = net.filter(F.col("row").isNotNull()).select("row.*")
    return base.join(net.select(key), key, "left_anti").select(*base.columns).unionByName(arrived.select(*base.columns))


def _deltas(feed: DataFrame, **measures: Column) -> Column:
    """Per measure its sum over new rows minus its sum over old rows: one subquery, a struct, one pass."""
    sums = [
        F.coalesce(F.sum(F.col("sign") * measure), F.lit(0)).cast("bigint").alias(name)
        for name, measure in measures.items()
    ]
    return signed_rows(feed).agg(F.struct(*sums)).scalar()


def inc_library_totals(
    state: DataFrame,
    book_changes: DataFrame,
    loan_changes: DataFrame,
    loans_after: DataFrame,
    book_key: str,
    quantity: str,
    loan_book: str,
    active: Column,
) -> DataFrame:
    """Next (total, given, rest). Deleting a book also takes its active loans, read from the loans after the batch."""
    dropped = book_changes.filter(F.col("op") == "delete").select(F.col(f"old.{book_key}").alias(loan_book))
    cascaded = loans_after.filter(active).join(dropped.distinct(), loan_book, "left_semi").agg(F.count("*")).scalar()
    copies = _deltas(book_changes, total=F.col(quantity))
    lent = _deltas(loan_changes, given=F.when(active, 1).otherwise(0))
    moved = state.select(
        (F.col("total") + copies["total"]).alias("total"),
        (F.col("given") + lent["given"] - cascaded).alias("given"),
    )
    return moved.withColumn("rest", F.col("total") - F.col("given"))


def inc_denormalised_copy(
    state: DataFrame,
    changes: DataFrame,
    facts_after: DataFrame,
    renamed: DataFrame,
    key: str,
    person: str,
    readable: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Next readable copy. Touched keys are changed facts plus facts of renamed people; only they are rebuilt.

    ``renamed`` holds the ids (column ``person``) of dimension rows that changed or went away;
    ``readable`` joins names into fact rows.
    """
    touched = (
        changes.select(F.explode(F.array(f"old.{key}", f"new.{key}")).alias(key))
        .filter(F.col(key).isNotNull())
        .unionByName(facts_after.join(renamed.select(person).distinct(), person, "left_semi").select(key))
        .distinct()
    )
    # read twice below, so written once
    touched = write_scratch(touched, "touched")
    rebuilt = readable(facts_after.join(touched, key, "left_semi"))
    return state.join(touched, key, "left_anti").select(*state.columns).unionByName(rebuilt.select(*state.columns))


def inc_last_visit(
    state: DataFrame, changes: DataFrame, loans_after: DataFrame, person: str, start: str, out: str = "last_visit"
) -> DataFrame:
    """Next latest start per person. Inserts can only raise it; people of other changes are recomputed."""
    raised = (
        changes.filter(F.col("op") == "insert")
        .groupBy(F.col(f"new.{person}").alias(person))
        .agg(F.max(f"new.{start}").alias("_raised"))
    )
    touched = (
        changes.filter(F.col("op") != "insert")
        .select(F.explode(F.array(f"old.{person}", f"new.{person}")).alias(person))
        .filter(F.col(person).isNotNull())
        .distinct()
    )
    touched = write_scratch(touched, "touched")
    again = loans_after.join(touched, person, "left_semi").groupBy(person).agg(F.max(start).alias("_again"))
    judged = touched.join(again, person, "left").withColumn("_touched", F.lit(True))
    joined = state.join(raised, person, "left").join(judged, person, "left")
    latest = F.when(F.col("_touched"), F.col("_again")).otherwise(F.greatest(out, "_raised"))
    return joined.withColumn(out, latest).select(*state.columns)


def inc_averages(
    state: DataFrame, people_changes: DataFrame, loan_changes: DataFrame, active: Column, start: str, end: str
) -> DataFrame:
    """Next (persons, active, inactive, days): the sums behind the three ratios."""
    people = _deltas(people_changes, persons=F.lit(1))
    loans = _deltas(
        loan_changes,
        active=F.when(active, 1).otherwise(0),
        inactive=F.when(active, 0).otherwise(1),
        days=F.when(~active, F.datediff(end, start)).otherwise(0),
    )
    return state.select(
        (F.col("persons") + people["persons"]).alias("persons"),
        *[(F.col(name) + loans[name]).alias(name) for name in ("active", "inactive", "days")],
    )


def averages_of(state: DataFrame) -> DataFrame:
    """The three ratios, computed on read."""
    return state.select(
        F.try_divide("active", "persons").alias("books_taken"),
        F.try_divide("days", "inactive").alias("days_to_read"),
        F.try_divide("inactive", "persons").alias("books_returned"),
    )


def _add_deltas(state: DataFrame, deltas: DataFrame, key: str, out: str) -> DataFrame:
    return (
        state.join(deltas, key, "left")
        .withColumn(out, F.col(out) + F.coalesce("_delta", F.lit(0)))
        .select(*state.columns)
    )


def inc_active_count(state: DataFrame, changes: DataFrame, person: str, active: Column, out: str = "books") -> DataFrame:
    """Next number of active loans per person: -1 to the old owner, +1 to the new one, if active."""
    deltas = signed_rows(changes).filter(active).groupBy(person).agg(F.sum("sign").alias("_delta"))
    return _add_deltas(state, deltas, person, out)


def inc_genre_count(
    state: DataFrame,
    link_changes: DataFrame,
    book_deletes: DataFrame,
    links_after: DataFrame,
    genre: str,
    book: str,
    out: str = "books",
) -> DataFrame:
    """Next number of books per genre. A deleted book takes one from each genre it is linked to after the batch."""
    linked = signed_rows(link_changes).groupBy(genre).agg(F.sum("sign").alias("_delta"))
    lost = (
        links_after.join(book_deletes.select(book).distinct(), book, "left_semi")
        .groupBy(genre).agg((-F.count("*")).alias("_delta"))
    )
    deltas = linked.unionByName(lost).groupBy(genre).agg(F.sum("_delta").alias("_delta"))
    return _add_deltas(state, deltas, genre, out)


def link_changes(links: DataFrame, batch: DataFrame, lost: DataFrame, book: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links added, links removed, all books lost so far) of a batch of link inserts, link deletes and drops of books (op drop, the book in ``new``).

    A dropped book takes its links along, and links to it that still arrive are refused, whatever their order; a link that is there already is not added
    again, and one that is gone is not removed again, so repeated events change nothing.
    """
    names = links.columns
    come = batch.filter("op = 'insert'").select(*[F.col(f"new.{c}").alias(c) for c in names]).distinct()
    cut = batch.filter("op = 'delete'").select(*[F.col(f"old.{c}").alias(c) for c in names]).distinct()
    dropped = lost.unionByName(batch.filter("op = 'drop'").select(F.col(f"new.{book}").alias(book))).distinct()
    removed = links.join(cut, names, "left_semi").unionByName(links.join(dropped, book, "left_semi").select(*names)).distinct()
    added = come.join(dropped, book, "left_anti").select(*names).join(links, names, "left_anti")
    return added, removed, dropped


def inc_link_count(state: DataFrame, added: DataFrame, removed: DataFrame, group: str, out: str = "books") -> DataFrame:
    """Next number of links per group."""
    signed = added.select(group, F.lit(1).alias("_s")).unionByName(removed.select(group, F.lit(-1).alias("_s")))
    return _add_deltas(state, signed.groupBy(group).agg(F.sum("_s").alias("_delta")), group, out)
