"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Targets. Each source has a weight; all sources share ``share`` times the words of the table by weight. A target stops at ``most`` times its
source's words and what is over is shared out again by weight until no target is above that. In the order of most * words / weight
the sources that stop come first, so running sums give the level at which the rest is shared, in whole numbers.

Blocks. A source's rows are permuted by a hash, laid out along their words, and cut into blocks (about ``block_rows`` rows, at most
``most_blocks`` blocks a source). The source is gone through again and again until its target is reached, so a row is drawn once for each round whose
target lies beyond the row's middle: the words drawn miss the target by half a row at most. A source's *quota* is the number of its (block, round) pairs
with any drawn row.

Splitting tree. The root holds the quotas of all sources and all output shards. A node hands its left half as many pairs as that half of its shards
holds; which sources they come from is drawn from the multivariate hypergeometric distribution, source after source as an urn without
replacement; the right half gets the rest. So every shard's count per source is known, quotas are met exactly, and no row has been moved. A source's
pairs, permuted by another hash, then go to its shards in stretches: no pair is drawn twice. In a shard, rows are ordered by a third hash.

Hashes depend on keys, sizes and the seed only, so a lost executor or a second run gives the same mix. Quotas of a node are one array, a
source each. Windows run inside a block, over the pairs of one source (at most rounds * ``most_blocks``) or over one shard.

Edge cases: a NULL text has no words, a NULL source is a source of its own that sorts last, a NULL key is a key; equal rows are told apart by number; rows without words
are never needed, they are drawn with the words around them; sources or tables without words have target 0; other columns are left out, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import write_scratch
from tablewright.operators.numbering import SLICE, explode_range, ordered_slices, running_sum, with_running_sum


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (3, 1, 2)
    #: words of the mix: share[0] / share[1] times the words of the table
    share: tuple[int, int] = (3, 2)
    most: int = 2
    block_rows: int = 256
    most_blocks: int = 16_384
    shard_words: int = 1 << 22
    seed: int = 12


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """id, source, size of every row; words are the stretches of a text without blanks."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.size(words).cast("long").alias("size"))


def targets(items: DataFrame, s: Settings) -> DataFrame:
    """One row per source: source, no (its place in order), words, n_rows, target."""
    each = items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n_rows"))
    each = each.withColumn("last", F.col("source").isNull())
    numbered = running_sum(each, [], ["last", "source"], F.lit(1), "no").drop("last")
    weights = F.array(*[F.lit(w).cast("long") for w in s.weights])
    weighed = numbered.withColumn("w", F.get(weights, (F.col("no") % len(s.weights)).cast("int")))
    weighed = weighed.withColumn("cap", F.col("words") * s.most)
    slices = ordered_slices(weighed.withColumn("due", F.expr(f"cap * ({lcm(*s.weights)} div w)")), ["due", "no"])
    summed = with_running_sum(slices, [], ["due", "no"], F.col("cap"), "cap_before")
    summed = with_running_sum(summed, [], ["due", "no"], F.col("w"), "w_before").drop(SLICE)
    summed = write_scratch(summed, "source-sums")
    # what is left to share, and the weight it is shared by, if all sources before this one stop
    total, weight = summed.agg(F.sum("words")).scalar(), summed.agg(F.sum("w")).scalar()
    shared = summed.withColumn("num", total * s.share[0] - F.col("cap_before") * s.share[1]).withColumn(
        "den", (weight - F.col("w_before")) * s.share[1]
    )
    wide = "decimal(38,0)"
    goes_on = F.col("cap").cast(wide) * F.col("den").cast(wide) >= F.col("w").cast(wide) * F.col("num").cast(wide)
    level = shared.where(goes_on).agg(F.min_by(F.struct("num", "den"), F.struct("due", "no")))
    level = level.toDF("level").select(F.col("level.num").alias("num"), F.col("level.den").alias("den"))
    num, den = level.select("num").scalar(), level.select("den").scalar()
    # no such source: the share is more than all caps together, and every source stops
    due = F.coalesce((F.col("w") * num).cast("double") / den.cast("double"), F.col("cap").cast("double"))
    return summed.select("source", "no", "words", "n_rows", F.least(F.col("cap").cast("double"), due).alias("target"))


def laid_out(docs: DataFrame, key: str, text: str, source: str, s: Settings) -> DataFrame:
    """Every row with its place: no, block, id, nth (number among equal rows), source, size, source_size, target, rounds (how often it is drawn)."""
    plain = sized(docs, key, text, source)
    items = plain.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    told = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("/"), F.col("size").cast("string"))
    items = write_scratch(items.withColumn("h", F.conv(F.substring(F.md5(told.cast("binary")), 1, 15), 16, 10).cast("long")), "items")
    sources = write_scratch(targets(items, s), "sources")

    blocks = F.greatest(F.lit(1), F.least(F.lit(s.most_blocks), F.ceil(F.col("n_rows") / s.block_rows))).cast("long")
    goals = sources.select(F.col("source").alias("of"), "no", F.col("words").alias("source_size"), "target", blocks.alias("blocks"))
    # blocks are stretches of the order by hash
    placed = items.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "block", F.shiftright(F.shiftright("h", 30) * F.col("blocks"), 30)
    )
    placed = write_scratch(placed.drop("blocks"), "placed")
    of_block = placed.groupBy("no", "block").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    begins = running_sum(of_block, ["no"], ["block"], F.col("words"), "block_begin").select("no", "block", "block_begin")
    inside = Window.partitionBy("no", "block").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = placed.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    at = at.join(begins, ["no", "block"]).withColumn("begin", F.col("block_begin") + F.col("before")).drop("before", "block_begin", "h")
    at = write_scratch(at, "begins")

    single = at.where("n = 1").withColumn("nth", F.lit(0).cast("long"))
    equal = at.where("n > 1").withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.col("n") - 1)
    rows = single.unionByName(explode_range(equal, "lo", "hi", "nth").drop("lo", "hi")).drop("n")
    begin = F.col("begin") + F.col("nth") * F.col("size")
    drawn = [
        F.when((begin + F.col("source_size") * r) * 2 + F.col("size") < F.col("target") * 2, 1).otherwise(0) for r in range(s.most)
    ]
    return write_scratch(rows.withColumn("rounds", sum(drawn, F.lit(0))).drop("begin"), "laid-out")


def split_quotas(quotas: DataFrame, shards: int, pairs: int, seed: int) -> DataFrame:
    """(no, n) per source to (shard, no, n): all pairs dealt to the shards by the splitting tree, sources with none left out.

    ``pairs`` is the sum of n. Shard i takes pairs * (i + 1) div shards - pairs * i div shards of them.
    """
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("no", "n"))).alias("quotas")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "quotas"
    )
    held = "array<struct<no:bigint,n:bigint>>"
    # one source's draw: an urn of t pairs, l of which go left; each of the source's n pairs is asked in turn
    urn = f"""aggregate(sequence(1L, q.n), named_struct('l', a.l, 't', a.t, 'x', 0L), (b, i) ->
        IF(shiftrightunsigned(xxhash64({seed}, lo, hi, q.no, i), 11) * {2.0**-53!r}D * b.t < b.l,
           named_struct('l', b.l - 1, 't', b.t - 1, 'x', b.x + 1), named_struct('l', b.l, 't', b.t - 1, 'x', b.x)))"""
    step = f"""aggregate(quotas, named_struct('l', {pairs}L * mid div {shards} - {pairs}L * lo div {shards},
            't', {pairs}L * hi div {shards} - {pairs}L * lo div {shards},
            'left', CAST(array() AS {held}), 'right', CAST(array() AS {held})),
        (a, q) -> transform(array({urn}), u -> named_struct('l', u.l, 't', u.t,
            'left', IF(u.x > 0, array_append(a.left, named_struct('no', q.no, 'n', u.x)), a.left),
            'right', IF(u.x < q.n, array_append(a.right, named_struct('no', q.no, 'n', q.n - u.x)), a.right)))[0])"""
    for level in range(max(0, shards - 1).bit_length()):
        if level == 6:  # enough nodes to share the rest of the tree among tasks
            nodes = nodes.repartition("lo")
        split = nodes.withColumn("mid", F.expr("(lo + hi) div 2")).withColumn("halves", F.expr(f"IF(hi - lo > 1, {step}, NULL)"))
        nodes = split.select(F.explode(F.expr("""IF(hi - lo > 1,
            array(named_struct('lo', lo, 'hi', mid, 'quotas', halves.left), named_struct('lo', mid, 'hi', hi, 'quotas', halves.right)),
            array(named_struct('lo', lo, 'hi', hi, 'quotas', quotas)))""")).alias("node")).select("node.*")
    return nodes.select(F.col("lo").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.no", "q.n")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: id, nth, source, size, source_size, target, drawn (array of round, shard: where the row goes)."""
    s = settings
    rows = laid_out(docs, key, text, source, s)
    asked = rows.where("rounds > 0").select("no", "block", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round")).distinct()
    order = Window.partitionBy("no").orderBy(F.xxhash64(F.lit(s.seed), "no", "block", "round"), "block", "round")
    pairs = write_scratch(asked.withColumn("turn", F.row_number().over(order).cast("long")), "pairs")

    quotas = pairs.groupBy("no").agg(F.count("*").alias("n"))
    words = rows.agg(F.sum(F.col("size") * F.col("rounds")).alias("w")).first()["w"] or 0
    n_pairs = pairs.count()
    shards = max(1, min(n_pairs, -(-words // s.shard_words)))
    dealt = write_scratch(split_quotas(quotas, shards, n_pairs, s.seed), "quotas")
    earlier = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    stretches = dealt.withColumn("from", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    turns = stretches.select("no", "shard", F.explode(F.expr("sequence(`from` + 1, `from` + n)")).alias("turn"))
    goes = pairs.join(turns, ["no", "turn"]).groupBy("no", "block").agg(
        F.sort_array(F.collect_list(F.struct("round", "shard"))).alias("drawn")
    )
    none = F.array().cast("array<struct<round:int,shard:bigint>>")
    drawn = F.coalesce(F.filter("drawn", lambda d: d["round"] < F.col("rounds")), none)
    # rows of blocks that were never asked have no partner; an inner join and the rest, as only inner joins split a hot block on both sides
    asked_rows = rows.where("rounds > 0").join(goes, ["no", "block"]).withColumn("drawn", drawn)
    rest = rows.where("rounds = 0").withColumn("drawn", none)
    return asked_rows.unionByName(rest).select("id", "nth", "source", "size", "source_size", "target", "drawn")


def shard_rows(mixed: DataFrame, seed: int = Settings.seed) -> DataFrame:
    """The mix itself: shard, place (from 1, in shuffled order), id, nth, source, size, round."""
    rows = mixed.select(F.explode("drawn").alias("d"), "id", "nth", "source", "size").select("d.shard", "d.round", "id", "nth", "source", "size")
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "id", "size", "nth", "round"), "id", "source", "size", "nth", "round")
    return rows.select("shard", F.row_number().over(order).alias("place"), "id", "nth", "source", "size", "round")


def report(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each row's words in the mix: key, size, source_size, target, taken."""
    return mixed.select(F.col("id").alias(key), "size", "source_size", "target", (F.col("size") * F.size("drawn")).alias("taken"))
