"""Approximate nearest neighbours: stable projections in a kd-tree, verified until a chi-square test stops.

Largest inner product is turned into smallest distance by one more coordinate, sqrt(M**2 - |x|**2), M the largest norm of the table;
a query's is 0. Vectors are projected to m dimensions by Gaussian (2-stable) projections: for a point at distance r the squared
projected distance is r**2 times a chi-square variable of m degrees. A point nearer than the k-th best found, d, that still has not come up
when projected neighbours are at distance s is thus as unlikely as chi2_m > s**2 / d**2. A query takes its projected neighbours in
order, verifies them by their true products a few at a time, and stops when that chance is at most ``miss``; leaves of the kd-tree whose boxes
are too far for the test are not opened.

The upper part of the tree (at most ``cells`` cells, and a sixteenth of the sample) is fitted on a bounded sample of vectors; every vector is put into its cell, and cells are
cut into blocks that fit a task. A query is answered in its own cell first; then it goes to every other cell whose box the
test does not rule out, given the k-th best so far. Queries of a cell go in portions, so neither side of a task is unbounded.

Of identical vectors only the k + 1 smallest ids can ever be among a query's k nearest, so a vector with very many copies is held once with
those ids: nothing that could be a result is lost, and copies make no hot block.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, neither do rows without id; of vectors of
different lengths those of the most frequent length take part (of equally frequent ones the shortest); repeated rows of one
id are one candidate each time; with k or fewer candidates all are given; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import write_scratch


@dataclass(frozen=True)
class Settings:
    k: int = 20
    #: even, as the chi-square test has a closed form then
    dimensions: int = 40
    miss: float = 0.15
    #: rows of its own cell that a query verifies before the stopping test is asked
    least: int = 256
    sample: int = 16_384
    cells: int = 1_024
    cell_rows: int = 8_192
    leaf_rows: int = 64
    portion: int = 1_024
    seed: int = 7


def chi2_tail(x: np.ndarray, degrees: int) -> np.ndarray:
    """P(chi-square of an even number of degrees > x)."""
    half = np.minimum(x, 1e4) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return np.exp(-half) * total


class Tree:
    """Upper kd-tree: splits at the medians of a sample, down to ``depth`` levels; cells are numbered by their path."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.splits: dict[int, tuple[int, float]] = {}
        parts = {1: points}
        for _ in range(depth):
            below = {}
            for node, part in parts.items():
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
                cut = float(np.median(part[:, axis])) if len(part) else 0.0
                self.splits[node] = (axis, cut)
                below[2 * node], below[2 * node + 1] = part[part[:, axis] <= cut], part[part[:, axis] > cut]
            parts = below

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            axis = np.array([self.splits[n][0] for n in node.tolist()], dtype=np.int64)
            cut = np.array([self.splits[n][1] for n in node.tolist()])
            node = 2 * node + (points[np.arange(len(points)), axis] > cut)
        return node


def _leaves(points: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of points by leaf of a median-split tree, and where leaves begin."""
    order, begins, todo = [], [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= rows:
            begins.append(sum(map(len, order)))
            order.append(part)
            continue
        axis = int(np.argmax(np.ptp(points[part], axis=0)))
        ranked = part[np.argsort(points[part, axis], kind="stable")]
        todo += [ranked[len(ranked) // 2:], ranked[: len(ranked) // 2]]
    return np.concatenate(order), np.array(begins)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed the same way, so equal vectors give equal scores."""
    return (rows * query).sum(axis=-1)


def chi2_bound(miss: float, degrees: int) -> float:
    """The value that a chi-square variable exceeds with probability ``miss``."""
    low, high = 0.0, 1.0
    while chi2_tail(np.array([high]), degrees)[0] > miss:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(np.array([middle]), degrees)[0] > miss else (low, middle)
    return high


def _near_leaves(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of points to the boxes of leaves (points x leaves)."""
    out = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis:axis + 1]
        out += np.maximum(np.maximum(low[:, axis] - p, p - high[:, axis]), 0) ** 2
    return out


def search_block(x: np.ndarray, px: np.ndarray, q: np.ndarray, pq: np.ndarray, top: float, bound: np.ndarray, s: Settings):
    """The best k + 1 rows of a block for each query: (query, row, score), and how many rows were verified in all.

    ``x`` and ``q`` are original vectors, ``px`` and ``pq`` projected ones, ``top`` the largest squared norm of the table, ``bound`` squared distances
    within which k + 1 vectors are known already (infinity for none). Projected distances of a leaf come from one matrix product with
    the queries that its box leaves open; then each query verifies its projected neighbours in their order, a few at a time, up to the stopping test.
    """
    want, stop = s.k + 1, chi2_bound(s.miss, s.dimensions)
    order, begins = _leaves(px, s.leaf_rows)
    x, px = x[order], px[order]
    ends = np.append(begins[1:], len(x))
    low, high = np.minimum.reduceat(px, begins), np.maximum.reduceat(px, begins)
    norms, limit = products(q, q), bound.astype(float).copy()
    gaps = _near_leaves(low, high, pq)
    found, rows_of, scores_of, verified = [], [], [], 0

    # without a bound the rows of the nearest leaves are verified and give one
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    sizes, taken = ends - begins, np.zeros(gaps.shape, dtype=bool)
    for i in np.flatnonzero(~np.isfinite(limit)).tolist():
        nearest = np.argsort(gaps[i], kind="stable")
        nearest = nearest[: int(np.searchsorted(np.cumsum(sizes[nearest]), s.least)) + 1]
        taken[i, nearest] = True
        rows = np.concatenate([np.arange(begins[k], ends[k]) for k in nearest.tolist()])
        score = products(x[rows], q[i])
        verified += len(rows)
        if len(rows) > want:
            last = np.partition(score, len(score) - want)[len(score) - want]
            rows, score = rows[score >= last], score[score >= last]
        if len(rows) >= want:
            limit[i] = norms[i] + top - 2 * score.min()
        seeds[i] = score, rows

    reach = np.maximum(limit, 1e-12) * stop
    open_leaf = ~(gaps > reach[:, None]) & ~taken
    squares_x, squares_q = products(px, px), products(pq, pq)
    held_q, held_row, held_gap = [], [], []
    for k in range(len(begins)):
        asked = np.flatnonzero(open_leaf[:, k])
        if not len(asked):
            continue
        part = slice(begins[k], ends[k])
        away = squares_q[asked][:, None] + squares_x[part][None, :] - 2 * (pq[asked] @ px[part].T)
        i, r = np.nonzero(~(away > reach[asked][:, None]))
        held_q.append(asked[i])
        held_row.append(r + begins[k])
        held_gap.append(away[i, r])
    held_q, held_row, held_gap = (np.concatenate([*h, np.empty(0)]) for h in (held_q, held_row, held_gap))
    turn = np.lexsort((held_gap, held_q))
    held_q, held_row, held_gap = held_q[turn], held_row[turn].astype(np.int64), held_gap[turn]
    cuts = np.searchsorted(held_q, np.arange(len(q) + 1))
    for i in range(len(q)):
        rows, away = held_row[cuts[i]:cuts[i + 1]], held_gap[cuts[i]:cuts[i + 1]]
        best, kept = seeds.get(i, (np.empty(0), np.empty(0, dtype=np.int64)))
        at, step = 0, 2 * want
        # incremental projected neighbours, until the next one is too far for the k-th best found
        while at < len(rows) and not away[at] > max(limit[i], 1e-12) * stop:
            some = rows[at:at + step]
            at, step = at + len(some), 2 * step
            verified += len(some)
            best, kept = np.append(best, products(x[some], q[i])), np.append(kept, some)
            if len(best) > want:
                last = np.partition(best, len(best) - want)[len(best) - want]
                # all that tie with the last one stay
                best, kept = best[best >= last], kept[best >= last]
            if len(best) >= want:
                limit[i] = min(limit[i], norms[i] + top - 2 * best.min())
        found.append(np.full(len(kept), i))
        rows_of.append(order[kept])
        scores_of.append(best)
    return np.concatenate(found), np.concatenate(rows_of), np.concatenate(scores_of), verified


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v as doubles) of the vectors that take part."""
    plain = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and size(v) > 0")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    plain = plain.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda c: c != 0))
    lengths = plain.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return plain.where(F.size("v") == (lengths[0]["n"] if lengths else -1))


def nearest(vectors: DataFrame, queries, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """query, rank, id, score: the k nearest of each row for which the condition ``queries`` (on column id) holds."""
    s = settings
    spark = vectors.sparkSession
    rows = write_scratch(usable(vectors, key, vector), "vectors")
    told = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("top"), F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    kind = rows.schema["id"].dataType.simpleString()
    if not told["n"]:
        return spark.createDataFrame([], f"query {kind}, rank int, id {kind}, score double")
    top, n, width = told["top"], told["n"], told["d"]
    # copies of a vector: their smallest ids only; the limit works before the shuffle as well
    same = Window.partitionBy("v").orderBy("id")
    held = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= s.k + 1)
    points = held.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    rng = np.random.default_rng(s.seed)
    directions = rng.normal(size=(width + 1, s.dimensions))

    def project(v: np.ndarray, last: np.ndarray) -> np.ndarray:
        return v @ directions[:width] + last[:, None] * directions[width]

    def lifted(v: np.ndarray) -> np.ndarray:
        return project(v, np.sqrt(np.maximum(top - products(v, v), 0)))

    # a bounded sample: the vectors whose hash falls below a threshold, sorted so that it is the same each time
    share = min(1.0, s.sample / n)
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("v").orderBy("v").limit(2 * s.sample).collect()
    sample = np.array([r["v"] for r in drawn]) if drawn else np.zeros((1, width))
    depth = int(np.ceil(np.log2(max(1, min(s.cells, n / s.cell_rows, len(sample) / 16)))))
    tree = spark.sparkContext.broadcast(Tree(lifted(sample), depth))

    @F.pandas_udf("long")
    def point_cell(v: pd.Series) -> pd.Series:
        return pd.Series(tree.value.cell(lifted(np.stack(v.to_numpy()))))

    @F.pandas_udf("array<double>")
    def query_point(v: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy())
        return pd.Series(list(project(m, np.zeros(len(m)))))

    @F.pandas_udf("array<double>")
    def point_of(v: pd.Series) -> pd.Series:
        return pd.Series(list(lifted(np.stack(v.to_numpy()))))

    placed = write_scratch(points.withColumn("cell", point_cell("v")).withColumn("p", point_of("v")), "points")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    blocks = {c: int(np.ceil(m / s.cell_rows)) for c, m in counts.items()}
    # boxes of the cells: at most ``cells`` rows
    edges = placed.select("cell", F.posexplode("p").alias("axis", "x")).groupBy("cell", "axis").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    cells = sorted(counts)
    at = {c: i for i, c in enumerate(cells)}
    low, high = np.zeros((len(cells), s.dimensions)), np.zeros((len(cells), s.dimensions))
    for e in edges:
        low[at[e["cell"]], e["axis"]], high[at[e["cell"]], e["axis"]] = e["low"], e["high"]
    boxes = spark.sparkContext.broadcast((np.array(cells), low, high))

    def gaps(p: pd.Series) -> np.ndarray:
        _, lo, hi = boxes.value
        q = np.stack(p.to_numpy())[:, None, :]
        return (np.maximum(np.maximum(lo - q, q - hi), 0) ** 2).sum(axis=2)

    @F.pandas_udf("long")
    def home_cell(p: pd.Series) -> pd.Series:
        return pd.Series(boxes.value[0][gaps(p).argmin(axis=1)])

    @F.pandas_udf("array<long>")
    def further_cells(p: pd.Series, home: pd.Series, bound: pd.Series) -> pd.Series:
        names, near = boxes.value[0], gaps(p)
        limit = np.maximum(bound.to_numpy(dtype=float), 1e-12)[:, None]
        open_ = (chi2_tail(near / limit, s.dimensions) > s.miss) | ~np.isfinite(limit)
        open_ &= names[None, :] != home.to_numpy()[:, None]
        return pd.Series([names[row].tolist() for row in open_])

    asked = rows.where(queries).select(F.col("id").alias("query"), "v").distinct()
    asked = write_scratch(asked.withColumn("p", query_point("v")).withColumn("cell", home_cell("p")), "queries")

    blocks_of = F.create_map(*[x for c in cells for x in (F.lit(c).cast("long"), F.lit(blocks[c]))])
    numbered = placed.withColumn("block", F.pmod(F.xxhash64("v"), F.element_at(blocks_of, F.col("cell"))).cast("int"))
    result = f"query {kind}, ids array<{kind}>, score double"

    def search(pairs: DataFrame) -> DataFrame:
        """(query, v, p, cell, bound) to the best rows of that cell for each query; block by block, queries in portions."""
        sizes = {r["cell"]: r["count"] for r in pairs.groupBy("cell").count().collect()}
        if not sizes:
            return spark.createDataFrame([], result)
        portions = F.create_map(*[x for c, m in sorted(sizes.items()) for x in (F.lit(c).cast("long"), F.lit(int(np.ceil(m / s.portion))))])
        left = numbered.withColumn("of", F.element_at(F.try_element_at(F.array(portions), F.lit(1)), F.col("cell"))).where("of is not null")
        left = left.withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).select("cell", "block", "portion", "v", "p", "ids")
        right = (
            pairs.withColumn("portion", F.pmod(F.xxhash64("query"), F.element_at(portions, F.col("cell"))).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks_of, F.col("cell")) - 1)))
            .select("cell", "block", "portion", "query", "v", "p", "bound")
        )

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query": [], "ids": [], "score": []})
            x, px, q, pq = (np.stack(c.to_numpy()) for c in (a["v"], a["p"], b["v"], b["p"]))
            of, row, score, _ = search_block(x, px, q, pq, top, b["bound"].to_numpy(dtype=float), s)
            return pd.DataFrame({"query": b["query"].to_numpy()[of], "ids": a["ids"].to_numpy()[row], "score": score})

        keys = ["cell", "block", "portion"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, result)

    def best(found: DataFrame, ids: str) -> DataFrame:
        each = found.select("query", "score", F.explode(ids).alias("id")).where("id <> query")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k)

    first = write_scratch(search(asked.withColumn("bound", F.lit(float("inf")))), "near")
    # squared distance of the k-th best so far; infinity where there are fewer
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    kth = best(first, "ids").where(F.col("rank") == s.k).select("query", "score")
    bounded = asked.join(kth, "query", "left").withColumn(
        "bound", F.coalesce(squares + F.lit(top) - 2 * F.col("score"), F.lit(float("inf")))
    )
    routed = bounded.withColumn("to", further_cells("p", "cell", "bound")).select("query", "v", "p", "bound", F.explode("to").alias("cell"))
    second = search(write_scratch(routed, "routed"))
    ranked = best(first.unionByName(second), "ids")
    return ranked.select("query", "rank", "id", "score")
