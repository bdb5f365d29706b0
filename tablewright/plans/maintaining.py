"""Queries: summary tables under a change feed, row rules, corrections, streams."""

from pyspark.sql import functions as F

from tablewright.operators import aggregates as ag
from tablewright.operators import changes as ch
from tablewright.operators import rules as rl
from tablewright.plans.joining import LINKS, LOANS
from tablewright.plans.registry import query
from tablewright.plans.scalars import NAME_PATTERN_SQL, TITLES, titles
from tablewright.sources.files import bytes_below
from tablewright.sources.scratch import scratch_path, write_scratch
from tablewright.sources.trial import AS_OF
from tablewright.streaming import feeds, keeping, keyed
from tablewright.streaming import totals as st
from tablewright.streaming import visits as vs


def as_of():
    return F.lit(AS_OF).cast("date")


# orders after the feed: urgent ones are new, high ones flipped, medium ones gone
AFTER = """
after AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
  WHERE o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')
  UNION ALL
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END,
    CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE 'O' END, CAST(o_orderdate AS DATE) + 1 FROM orders
  WHERE o_orderpriority = '2-HIGH')"""


def _base(t):
    return t.base_orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def _after(t):
    """Orders after the feed, as a stored table."""
    return write_scratch(ch.apply_changes(_base(t), t.order_feed, "o_orderkey"), "orders-after")


#: Bytes of the given tables behind one file of a batch.
FILE_BYTES = 32 << 20


def _feed_stream(t, feed, *keys):
    """A change feed as a stream of three micro-batches: each is taken from as many files as the tables' size asks for.

    All changes of ``keys`` are in one file, and so in one batch.
    """
    path = scratch_path(t.spark, "feed")
    files = -(-sum(bytes_below(t.spark, t.path(name)) for name in ("customer", "part", "orders", "lineitem")) // FILE_BYTES) or 1
    feed.repartition(3 * files, *keys).write.parquet(path)
    return feeds.table_stream(t.spark, path, t.spark.read.parquet(path).schema, files_per_batch=files)


def _kept(t, feed, states, step):
    place = scratch_path(t.spark, "kept")
    return keeping.keep(_feed_stream(t, feed), states, step, f"{place}/state", f"{place}/checkpoint")


def _book_feed(t):
    """PROMO parts arrive, SMALL parts get one copy more, LARGE parts go away."""
    row = F.struct(F.col("p_partkey").alias("book"), F.col("p_size").alias("copies"))
    more = F.struct(F.col("p_partkey").alias("book"), (F.col("p_size") + 1).alias("copies"))
    nothing = F.lit(None).cast("struct<book:bigint,copies:int>")
    kind = F.col("p_type")
    return t.part.filter(kind.isin("PROMO", "SMALL", "LARGE")).select(
        F.when(kind == "PROMO", "insert").when(kind == "SMALL", "update").otherwise("delete").alias("op"),
        F.when(kind != "PROMO", row).otherwise(nothing).alias("old"),
        F.when(kind == "PROMO", row).when(kind == "SMALL", more).otherwise(nothing).alias("new"),
    )


def _flagged_loans(t):
    """Loans with the flag that decides their part in the feed: A arrives, N flips, R stays."""
    heads = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("person"),
        F.col("o_orderdate").cast("date").alias("start"),
    )
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("book"), F.col("l_shipdate").cast("date").alias("finish"),
        (F.col("l_linestatus") == "O").alias("active"), F.col("l_returnflag").alias("flag"),
    )
    return lines.join(heads, "l_orderkey").select("person", "book", "start", "finish", "active", "flag")


def _loan_feed(loans):
    names = ["person", "book", "start", "finish", "active"]
    row = F.struct(*names)
    flipped = F.struct(*names[:-1], (~F.col("active")).alias("active"))
    nothing = F.lit(None).cast("struct<person:bigint,book:bigint,start:date,finish:date,active:boolean>")
    arrives = F.col("flag") == "A"
    return loans.filter(F.col("flag").isin("A", "N")).select(
        F.when(arrives, "insert").otherwise("update").alias("op"),
        F.when(~arrives, row).otherwise(nothing).alias("old"),
        F.when(arrives, row).otherwise(flipped).alias("new"),
    )


def _loans_before(loans):
    return loans.filter(F.col("flag") != "A")


def _loans_after(loans):
    return loans.withColumn("active", F.when(F.col("flag") == "N", ~F.col("active")).otherwise(F.col("active")))


LOANS_AFTER = """
loans_after AS (SELECT o_custkey AS person, l_partkey AS book, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days,
    (l_linestatus = 'O') <> (l_returnflag = 'N') AS active
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("""
WITH shelf AS (SELECT p_partkey, p_size + CASE p_type WHEN 'SMALL' THEN 1 ELSE 0 END AS copies FROM part WHERE p_type <> 'LARGE'),
 x AS (SELECT (SELECT CAST(sum(copies) AS BIGINT) FROM shelf) AS total, (SELECT count(*) FROM lineitem
   WHERE (l_linestatus = 'O') <> (l_returnflag = 'N') AND l_partkey IN (SELECT p_partkey FROM shelf)) AS given)
SELECT total, given, total - given AS rest FROM x
""")
def inc_library_totals(t):
    # totals need no owner or dates, so line items alone are the loans here
    loans = t.lineitem.select(
        F.col("l_partkey").alias("book"), (F.col("l_linestatus") == "O").alias("active"), F.col("l_returnflag").alias("flag")
    ).withColumns({"person": F.lit(None).cast("bigint"), "start": F.lit(None).cast("date"), "finish": F.lit(None).cast("date")})
    active = F.col("active")
    state = ag.library_totals(t.part.filter(F.col("p_type") != "PROMO"), _loans_before(loans), "p_size", active)
    return ch.inc_library_totals(
        state, _book_feed(t), _loan_feed(loans), _loans_after(loans), "book", "copies", "book", active
    )


def _readable(people):
    return lambda facts: facts.join(people, "o_custkey").select("o_orderkey", "person", "o_orderdate", "o_orderstatus")


COPY_AFTER = f"""
WITH {AFTER}
SELECT o_orderkey, c_name AS person, o_orderdate, o_orderstatus FROM after JOIN customer ON o_custkey = c_custkey"""


@query(COPY_AFTER)
def stream_denormalised_copy(t):
    """The readable copy kept over a stream of order changes; orders and copy are both states."""
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("person"))
    nobody = people.filter(F.lit(False)).select("o_custkey")

    def step(now, batch):
        facts = write_scratch(ch.apply_changes(now["facts"], batch, "o_orderkey"), "facts")
        return {"facts": facts, "copy": ch.inc_denormalised_copy(now["copy"], batch, facts, nobody, "o_orderkey", "o_custkey", _readable(people))}

    return _kept(t, t.order_feed, {"facts": _base(t), "copy": _readable(people)(_base(t))}, step)["copy"]


@query(f"""
WITH {AFTER}
SELECT o_orderkey, CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name) ELSE c_name END AS person, o_orderdate, o_orderstatus
FROM after JOIN customer ON o_custkey = c_custkey
""")
def inc_denormalised_copy(t):
    readable = _readable
    renamed = F.col("c_mktsegment") == "BUILDING"
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("person"))
    people_after = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(renamed, F.upper("c_name")).otherwise(F.col("c_name")).alias("person"),
    )
    changed = t.customer.filter(renamed).select(F.col("c_custkey").alias("o_custkey"))
    state = readable(people)(_base(t))
    return ch.inc_denormalised_copy(
        state, t.order_feed, _after(t), changed, "o_orderkey", "o_custkey", readable(people_after)
    )


# a feed with several changes of a key: medium orders go away and come back as finished ones of the next customer, low ones are changed twice;
# customers of BUILDING are renamed twice, those of MACHINERY go away
@query("""
WITH facts AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
    CASE o_orderpriority WHEN '3-MEDIUM' THEN 'F' WHEN '5-LOW' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CAST(o_orderdate AS DATE) + CASE o_orderpriority WHEN '5-LOW' THEN 2 ELSE 0 END AS o_orderdate
  FROM orders WHERE o_orderpriority <> '2-HIGH')
SELECT o_orderkey, CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name) || '!' ELSE c_name END AS person, o_orderdate, o_orderstatus
FROM facts JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'MACHINERY'
""")
def stream_copy_renamed(t):
    """The readable copy merged on read, over a stream in which keys change several times and people are renamed or go away."""
    row = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    orders = t.dated_orders.select(*row, "o_orderpriority")
    of = F.col("o_orderpriority")
    first = F.struct(*row)
    moved = F.struct("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), "o_orderdate")
    later = [F.struct("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.date_add("o_orderdate", n).alias("o_orderdate")) for n in (1, 2)]
    fact, name = "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:date>", "struct<o_custkey:bigint,person:string>"

    def change(seq, old, new):
        return F.struct(F.lit(seq).alias("seq"), *[F.lit(None).cast(kind).alias(c) if v is None else v.alias(c) for c, v, kind in old + new])

    def of_fact(seq, old, new):
        nobody = [("old_person", None, name)], [("new_person", None, name)]
        return change(seq, [("old", old, fact), *nobody[0]], [("new", new, fact), *nobody[1]])

    def of_person(seq, old, new):
        nothing = [("old", None, fact)], [("new", None, fact)]
        return change(seq, [*nothing[0], ("old_person", old, name)], [*nothing[1], ("new_person", new, name)])

    order_feed = orders.select(F.explode(
        F.when(of == "2-HIGH", F.array(of_fact(1, first, None)))
        .when(of == "3-MEDIUM", F.array(of_fact(1, first, None), of_fact(2, None, moved)))
        .when(of == "5-LOW", F.array(of_fact(1, first, later[0]), of_fact(2, later[0], later[1])))
    ).alias("c")).select("c.*")
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("person"), "c_mktsegment")
    was = F.struct("o_custkey", "person")
    named = [F.struct("o_custkey", n.alias("person")) for n in (F.upper("person"), F.concat(F.upper("person"), F.lit("!")))]
    people_feed = people.select(F.explode(
        F.when(F.col("c_mktsegment") == "BUILDING", F.array(of_person(1, was, named[0]), of_person(2, named[0], named[1])))
        .when(F.col("c_mktsegment") == "MACHINERY", F.array(of_person(1, was, None)))
    ).alias("c")).select("c.*")
    # all changes of a key are in one batch
    feed = order_feed.unionByName(people_feed).withColumn("at", F.coalesce("old.o_orderkey", "new.o_orderkey", "old_person.o_custkey"))
    stream = _feed_stream(t, feed, "at")
    place = scratch_path(t.spark, "keyed")
    base, names = orders.select(*row), people.select("o_custkey", "person")
    tables = [
        keyed.KeyedTable(t.spark, f"{place}/{folder}", key, df.schema, buckets=4, every=2).create(df)
        for folder, key, df in (("facts", "o_orderkey", base), ("people", "o_custkey", names), ("copy", "o_orderkey", _readable(names)(base)))
    ]

    def step(batch, batch_id):
        facts = ch.net_changes(batch.select("seq", "old", "new"), "o_orderkey")
        persons = ch.net_changes(batch.select("seq", F.col("old_person").alias("old"), F.col("new_person").alias("new")), "o_custkey")
        keyed.keep_copy(*tables, "o_custkey", lambda rows, known: _readable(known)(rows), batch_id, facts, persons)

    keyed.keep_tables(stream, tables, step, f"{place}/checkpoint")
    return tables[2].read()


LAST_VISITS = f"""
WITH {AFTER}
SELECT c_custkey AS o_custkey, (SELECT max(o_orderdate) FROM after WHERE after.o_custkey = c_custkey) AS last_visit FROM customer"""


def _visits(t):
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return people.join(_base(t).groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_visit")), "o_custkey", "left")


@query(LAST_VISITS)
def inc_last_visit(t):
    return ch.inc_last_visit(_visits(t), t.order_feed, _after(t), "o_custkey", "o_orderdate")


@query(LAST_VISITS)
def stream_last_visit(t):
    def step(now, batch):
        facts = write_scratch(ch.apply_changes(now["facts"], batch, "o_orderkey"), "facts")
        return {"facts": facts, "visits": ch.inc_last_visit(now["visits"], batch, facts, "o_custkey", "o_orderdate")}

    return _kept(t, t.order_feed, {"facts": _base(t), "visits": _visits(t)}, step)["visits"]


@query(LAST_VISITS)
def stream_last_visit_state(t):
    """The same by a state of dates and counts per person, so that no loan is looked at twice."""
    place = scratch_path(t.spark, "visits")
    latest = _visits(t)
    table = keyed.KeyedTable(t.spark, f"{place}/table", "o_custkey", latest.schema, buckets=4, every=2).create(latest)
    found = vs.stream_last_visit(_feed_stream(t, t.order_feed), _base(t), table, "o_custkey", "o_orderdate", f"{place}/checkpoint")
    # an order may be passed to a key that no customer has
    return found.join(t.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")


RATIOS = f"""
WITH {LOANS_AFTER}
SELECT round(count(*) FILTER (WHERE active) / (SELECT count(*) FROM customer), 6) AS books_taken,
  round(CAST(sum(days) FILTER (WHERE NOT active) AS DOUBLE) / count(*) FILTER (WHERE NOT active), 6) AS days_to_read,
  round(count(*) FILTER (WHERE NOT active) / (SELECT count(*) FROM customer), 6) AS books_returned
FROM loans_after"""


def _sums(loans, persons):
    """The sums behind the ratios before the feed."""
    active = F.col("active")
    return _loans_before(loans).agg(
        F.count(F.when(active, 1)).alias("active"), F.count(F.when(~active, 1)).alias("inactive"),
        F.coalesce(F.sum(F.when(~active, F.datediff("finish", "start"))), F.lit(0)).alias("days"),
    ).withColumn("persons", persons)


def _people_feed(people):
    nobody = F.lit(None).cast("struct<c_custkey:bigint>")
    return people.select(F.lit("insert").alias("op"), nobody.alias("old"), F.struct("c_custkey").alias("new"))


def _rounded(state):
    ratios = ch.averages_of(state)
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


@query(RATIOS)
def inc_averages(t):
    loans = _flagged_loans(t)
    arriving = F.col("c_mktsegment") == "BUILDING"
    persons = t.customer.filter(~arriving).agg(F.count("*")).scalar()
    feed = _people_feed(t.customer.filter(arriving))
    return _rounded(ch.inc_averages(_sums(loans, persons), feed, _loan_feed(loans), F.col("active"), "start", "finish"))


@query(RATIOS)
def stream_averages(t):
    """The same sums over a stream of loan changes, with all people there from the start."""
    loans = _flagged_loans(t)
    state = _sums(loans, t.customer.agg(F.count("*")).scalar())
    nobody = _people_feed(t.customer.filter(F.lit(False)))

    def step(now, batch):
        return {"sums": ch.inc_averages(now["sums"], nobody, batch, F.col("active"), "start", "finish").select(*now["sums"].columns)}

    return _rounded(_kept(t, _loan_feed(loans), {"sums": state}, step)["sums"])


ACTIVE = f"""
WITH {AFTER}
SELECT c_custkey AS o_custkey, count(o_orderkey) AS books
FROM customer LEFT JOIN after ON o_custkey = c_custkey AND o_orderstatus = 'O' GROUP BY c_custkey"""


def _active_counts(t):
    counts = _base(t).filter(_open()).groupBy("o_custkey").agg(F.count("*").alias("books"))
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return people.join(counts, "o_custkey", "left").select("o_custkey", F.coalesce("books", F.lit(0)).alias("books"))


def _open():
    return F.col("o_orderstatus") == "O"


@query(ACTIVE)
def inc_active_count(t):
    return ch.inc_active_count(_active_counts(t), t.order_feed, "o_custkey", _open())


@query(ACTIVE)
def stream_active_count(t):
    def step(now, batch):
        return {"counts": ch.inc_active_count(now["counts"], batch, "o_custkey", _open())}

    return _kept(t, t.order_feed, {"counts": _active_counts(t)}, step)["counts"]


GENRES = f"""
WITH {LINKS}
SELECT n_nationkey AS g_id, count(p_partkey) AS books FROM nation LEFT JOIN bg ON g_id = n_nationkey
LEFT JOIN part ON p_partkey = b_id AND p_type <> 'LARGE' GROUP BY n_nationkey"""


def _genre_parts(t):
    """(state, arriving links, deleted books, all links): PROMO parts arrive, LARGE parts go away."""
    kinds = t.part.select(F.col("p_partkey").alias("b_id"), "p_type")
    links = t.book_genres.join(kinds, "b_id")
    before = links.filter(F.col("p_type") != "PROMO").groupBy("g_id").agg(F.count("*").alias("books"))
    state = t.genres.join(before, "g_id", "left").select("g_id", F.coalesce("books", F.lit(0)).alias("books"))
    nothing = F.lit(None).cast("struct<b_id:bigint,g_id:int>")
    arriving = links.filter(F.col("p_type") == "PROMO").select(
        F.lit("insert").alias("op"), nothing.alias("old"), F.struct("b_id", "g_id").alias("new")
    )
    return state, arriving, kinds.filter(F.col("p_type") == "LARGE"), links


@query(GENRES)
def inc_genre_count(t):
    state, arriving, gone, links = _genre_parts(t)
    return ch.inc_genre_count(state, arriving, gone, links, "g_id", "b_id")


def _kept_genres(t, feed, links, counts):
    """Counts after a stream of link inserts, link deletes and drops of books; links and dropped books are states as well."""
    nobody = links.select("b_id").limit(0)

    def step(now, batch):
        added, removed, lost = ch.link_changes(now["links"], batch, now["lost"], "b_id")
        added, removed = write_scratch(added, "links-added"), write_scratch(removed, "links-removed")
        after = now["links"].join(removed, ["b_id", "g_id"], "left_anti").unionByName(added)
        return {"links": after, "lost": lost, "counts": ch.inc_link_count(now["counts"], added, removed, "g_id")}

    return _kept(t, feed, {"links": links, "lost": nobody, "counts": counts}, step)["counts"]


def _drops(books):
    none = F.lit(None).cast("struct<b_id:bigint,g_id:int>")
    return books.select(F.lit("drop").alias("op"), none.alias("old"), F.struct("b_id", F.lit(None).cast("int").alias("g_id")).alias("new"))


@query(GENRES)
def stream_genre_count(t):
    """Links that arrive and books that go away in one stream; the links are a state as well."""
    state, arriving, gone, links = _genre_parts(t)
    stored = links.filter(F.col("p_type") != "PROMO").select("b_id", "g_id")
    return _kept_genres(t, arriving.unionByName(_drops(gone)), stored, state)


@query(f"""
WITH {LINKS}
SELECT n_nationkey AS g_id, count(p_partkey) AS books FROM nation LEFT JOIN bg ON g_id = n_nationkey
LEFT JOIN part ON p_partkey = b_id AND p_type NOT IN ('LARGE', 'ECONOMY') GROUP BY n_nationkey
""")
def stream_genre_links(t):
    """Links deleted one by one (ECONOMY), books dropped twice (LARGE), and links of dropped books that arrive late: they don't count."""
    state, arriving, gone, links = _genre_parts(t)
    none = F.lit(None).cast("struct<b_id:bigint,g_id:int>")
    stored = links.filter(F.col("p_type") != "PROMO")
    link = F.struct("b_id", "g_id")
    unlinked = stored.filter(F.col("p_type") == "ECONOMY").select(F.lit("delete").alias("op"), link.alias("old"), none.alias("new"))
    late = stored.filter(F.col("p_type") == "LARGE").select(F.lit("insert").alias("op"), none.alias("old"), link.alias("new"))
    feed = arriving.unionByName(unlinked).unionByName(late).unionByName(_drops(gone)).unionByName(_drops(gone))
    return _kept_genres(t, feed, stored.select("b_id", "g_id"), state)


def codes(flagged):
    """Broken rules as text."""
    return flagged.withColumn(rl.BROKEN, F.array_join(rl.BROKEN, ","))


@query(f"""
WITH {LOANS}
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN start > DATE '{AS_OF}' THEN '1' END,
  CASE WHEN finish < DATE '{AS_OF}' AND active THEN '2' END, CASE WHEN finish < start THEN '3' END) AS broken FROM loans
""")
def rule_dates(t):
    flagged = rl.rule_dates(t.loans, "start", "finish", F.col("active"), as_of())
    return codes(flagged).select("l_orderkey", "l_linenumber", "broken")


@query("""
WITH stored AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' GROUP BY 1),
 batch AS (SELECT o_orderkey, o_custkey, o_orderstatus = 'O' AS active, o_orderpriority = '1-URGENT' AS ins FROM orders
   WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
 ahead AS (SELECT *, count(*) FILTER (WHERE active AND ins) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM batch)
SELECT o_orderkey, CASE WHEN coalesce(n, 0) + CASE WHEN ins THEN before ELSE 0 END >= 4 THEN 'max_active' ELSE '' END AS broken
FROM ahead LEFT JOIN stored USING (o_custkey)
""")
def rule_max_active(t):
    active = F.col("o_orderstatus") == "O"
    batch = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_orderpriority") == "1-URGENT").alias("ins")
    )
    # customers hold about ten orders in all, so the trial limit is 4
    flagged = rl.rule_max_active(batch, _base(t), "o_custkey", "o_orderkey", active, F.col("ins"), limit=4)
    return codes(flagged).select("o_orderkey", "broken")


# urgent orders arrive, high ones are flipped, medium ones go away; owners stay, so customers can be walked through apart
@query("""
WITH RECURSIVE stored AS (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' GROUP BY 1),
 feed AS (SELECT o_custkey, o_orderkey AS seq, o_orderpriority <> '3-MEDIUM' AS gated,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN -1 ELSE -1 END * CAST(o_orderstatus = 'O' AS INT)
      + CAST(o_orderpriority = '2-HIGH' AND o_orderstatus <> 'O' AS INT) AS delta,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
 walk AS (
  SELECT c_custkey AS o_custkey, CAST(1 AS BIGINT) AS pos, coalesce(n, 0) AS held FROM customer LEFT JOIN stored ON o_custkey = c_custkey
  UNION ALL
  SELECT o_custkey, pos + 1, CASE WHEN gated AND held >= 4 THEN held ELSE greatest(held + delta, 0) END FROM walk JOIN feed USING (o_custkey, pos))
SELECT seq, CASE WHEN gated AND held >= 4 THEN 'max_active' ELSE '' END AS broken FROM feed JOIN walk USING (o_custkey, pos)
""")
def rule_max_active_feed(t):
    """The limit over a batch of inserts, updates and deletes, each judged by what the ones before it left."""
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus")
    flipped = F.struct("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "O", "F").otherwise("O").alias("o_orderstatus"))
    nothing = F.lit(None).cast("struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>")
    kind = F.col("o_orderpriority")
    feed = t.orders.filter(kind.isin("1-URGENT", "2-HIGH", "3-MEDIUM")).select(
        F.col("o_orderkey").alias("seq"),
        F.when(kind == "1-URGENT", "insert").when(kind == "2-HIGH", "update").otherwise("delete").alias("op"),
        F.when(kind != "1-URGENT", row).otherwise(nothing).alias("old"),
        F.when(kind == "1-URGENT", row).when(kind == "2-HIGH", flipped).otherwise(nothing).alias("new"),
    )
    flagged = rl.rule_max_active_feed(feed, _base(t), "o_custkey", lambda r: r["o_orderstatus"] == "O", limit=4)
    return codes(flagged).select("seq", "broken")


@query(f"""
WITH {LOANS}, judged AS (SELECT concat_ws(',', CASE WHEN start > DATE '{AS_OF}' THEN '1' END,
  CASE WHEN finish < DATE '{AS_OF}' AND active THEN '2' END, CASE WHEN finish < start THEN '3' END) AS broken, finish FROM loans)
SELECT broken, count(*) AS n, max(finish) AS latest, (SELECT count(*) FROM judged WHERE broken = '') AS valid FROM judged GROUP BY broken
""")
def rule_dates_split(t):
    """Valid and rejected loans written in one pass, each part read again on its own."""
    valid, rejected, counts = rl.split_once(rl.rule_dates(t.loans, "start", "finish", F.col("active"), as_of()).select("finish", rl.BROKEN))
    both = valid.withColumn(rl.BROKEN, F.array().cast("array<string>")).unionByName(rejected)
    told = codes(both).groupBy("broken").agg(F.count("*").alias("n"), F.max("finish").alias("latest"))
    return told.withColumn("valid", F.lit(counts["valid"]).cast("bigint"))


@query("""
SELECT o_orderkey AS seq, CASE WHEN o_orderstatus <> 'O' THEN 'reactivated' ELSE '' END AS broken
FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def rule_no_reactivation(t):
    updates = t.order_feed.filter(F.col("op") == "update")
    flagged = rl.rule_no_reactivation(
        updates, F.col("old.o_orderstatus") == "O", F.col("new.o_orderstatus") == "O"
    )
    return codes(flagged).select("seq", "broken")


@query(f"""
WITH {TITLES}
SELECT p_partkey, title, CASE WHEN regexp_matches(title, '{NAME_PATTERN_SQL}') AND contains(title, '.') THEN ''
  ELSE 'name_format' END AS broken FROM titles
""")
def rule_name_format(t):
    return codes(rl.rule_name_format(titles(t), "title"))


@query(f"""
SELECT o_orderkey, CASE WHEN year(DATE '{AS_OF}') - year(o_orderdate) > 5 THEN 'too_old' ELSE '' END AS broken FROM orders
""")
def rule_year_window(t):
    flagged = rl.rule_year_window(t.dated_orders, F.year("o_orderdate"), as_of(), limit=5)
    return codes(flagged).select("o_orderkey", "broken")


@query(f"""
WITH {TITLES}
SELECT p_partkey, CASE WHEN title LIKE '%.' THEN title ELSE title || '.' END AS title,
  CASE WHEN title NOT LIKE '%.' THEN 'Value [' || title || '] was automatically changed to [' || title || '.]' END AS message
FROM titles
""")
def fix_trailing_dot(t):
    return rl.fix_trailing_dot(titles(t), "title")


@query(f"""
WITH {LOANS}, judged AS (SELECT *, finish < start OR finish < DATE '{AS_OF}' AS wrong FROM loans)
SELECT l_orderkey, l_linenumber, CASE WHEN wrong THEN DATE '2001-08-01' ELSE finish END AS finish,
  CASE WHEN wrong THEN 'Value [' || finish || '] was automatically changed to [2001-08-01]' END AS message FROM judged
""")
def fix_finish_date(t):
    fixed = rl.fix_finish_date(t.loans, "start", "finish", as_of())
    return fixed.select("l_orderkey", "l_linenumber", "finish", "message")


@query("""
SELECT count(*) FILTER (WHERE event_type = 'signup') AS total,
  count(*) FILTER (WHERE event_type = 'purchase') - count(*) FILTER (WHERE event_type = 'error') AS given,
  count(*) FILTER (WHERE event_type = 'signup') - count(*) FILTER (WHERE event_type = 'purchase')
    + count(*) FILTER (WHERE event_type = 'error') AS rest
FROM events
""")
def stream_totals(t):
    """A signup brings a copy in, a purchase lends one, an error takes one back."""
    changes = feeds.table_stream(t.spark, t.path("events"), t.events.schema)
    kind = F.col("event_type")
    given = F.when(kind == "purchase", 1).when(kind == "error", -1).otherwise(0)
    total = F.when(kind == "signup", 1).otherwise(0)
    state = scratch_path(t.spark, "totals")
    return st.stream_totals(changes, total, given, f"{state}/state", f"{state}/checkpoint")


@query("""
SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE contains(line, 'license')
""")
def stream_text_filter(t):
    texts = feeds.table_stream(t.spark, t.path("documents"), t.documents.schema)
    lines = texts.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    place = scratch_path(t.spark, "lines")
    feeds.stream_text_filter(lines, "line", "license", f"{place}/out", f"{place}/checkpoint")
    return t.spark.read.schema(lines.schema).parquet(f"{place}/out")


@query("""
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) WHERE contains(line, 'license') GROUP BY line
""")
def stream_growing_text(t):
    """Lines of a folder of text files that grows: two runs of one query, of which the second takes only what came after the first."""
    place = scratch_path(t.spark, "growing")
    texts = t.documents.select(F.coalesce("text", F.lit("")).alias("value"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("part"))
    for part in (0, 1):
        texts.filter(F.col("part") == part).select("value").write.mode("append").text(f"{place}/in")
        feeds.stream_text_filter(feeds.text_stream(t.spark, f"{place}/in"), "value", "license", f"{place}/out", f"{place}/checkpoint")
    found = t.spark.read.schema("value string").parquet(f"{place}/out")
    return found.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))
