"""Hard negatives by a multiway tree of split points with distance ranges to sibling subtrees (GNAT-style), exact in its leaves.

For an anchor, its positives are the most similar rows of its own label. For each positive, the hard negatives are the most similar rows of other
labels whose similarity lies in a window of shares of the positive's. Similarity is the integer inner product of vectors scaled and rounded down.

Inner products become distances by one more coordinate, sqrt(top - |x|**2), top the largest squared norm; an anchor's is 0. Then
distance**2 = |a|**2 + top - 2 * score for every row x, so a window of scores is an annulus around the anchor.

The tree. A node has split points taken from a sample, each as far from the ones before as possible; a row goes to the child of its nearest split point.
For every split point i and child j the node stores the least and largest distance of i to any row below j (over all rows, not the sample). An anchor at
distance r of split point i can only be between max(low - r, r - high) and r + high of the rows below j; if no window's
annulus meets what all split points leave over, the subtree is out. The upper tree is fitted on at most ``sample`` vectors and gives cells; every row is put into its
cell, cells are cut into blocks that fit a task, and a block builds its own node of the same kind. What is left in a leaf is scored exactly.

An anchor is answered in its own cell first. That gives the k-th best score so far, the lower end of the window from there on; then it goes to
all other cells that the ranges leave open. Anchors of a cell go in portions, so neither side of a task is unbounded.

Of rows with equal vector and label only the k + 1 smallest ids can ever be given, so a very common vector is held once with those ids.

Edge cases: rows without id or label, without vector, or with a component that is NULL or not finite (also after scaling) take no part; shorter
vectors count as filled up with zeros; zero and empty vectors score 0 with all; equal rows count once, and rows of the anchor's
id are never its partners; a positive with negative score has no window; scores beyond 64 bits count as the largest long; fewer than k partners are given as they are;
extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import write_scratch

LEAST, MOST = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 10
    #: a negative's score times ``base`` lies between ``low`` and ``high`` times the positive's
    low: int = 30
    high: int = 90
    base: int = 100
    scale: int = 256
    sample: int = 16_384
    fan_out: int = 16
    cell_rows: int = 8_192
    leaf_rows: int = 256
    portion: int = 8_192


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to split points."""
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


def split_points(x: np.ndarray, many: int) -> np.ndarray:
    """Up to ``many`` different rows, each as far as possible from those before it; chosen among three times as many."""
    pool = x[np.linspace(0, len(x) - 1, min(len(x), 3 * many)).astype(np.int64)]
    chosen = [0]
    near = distances(pool, pool[:1])[:, 0]
    while len(chosen) < many and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(pool, pool[chosen[-1]:chosen[-1] + 1])[:, 0])
    return pool[chosen]


@dataclass
class Node:
    """Split points and, for every child, the range of distances from each of them to the rows below."""

    points: np.ndarray
    number: int = 0
    children: list = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def ranges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Child of each row, and the least and largest distances (children x points); children without rows get an empty range."""
        each = distances(x, self.points)
        child = each.argmin(axis=1)
        low, high = np.full((len(self.points),) * 2, np.inf), np.full((len(self.points),) * 2, -np.inf)
        for j in np.unique(child).tolist():
            mine = each[child == j]
            low[j], high[j] = mine.min(axis=0), mine.max(axis=0)
        return child, low, high

    def scores_left(self, q: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score that any row below each child can have with each anchor (anchors x children)."""
        r = distances(q, self.points)[:, None, :]
        near = np.maximum(np.maximum(self.low - r, r - self.high), 0).max(axis=2)
        far = (r + self.high).min(axis=2)
        # rounding of square roots must never rule a row out
        slack = 1e-5 * np.sqrt(top + 1)
        both = (q * q).sum(axis=1)[:, None] + top
        with np.errstate(invalid="ignore", over="ignore"):
            least = (both - (far + slack) ** 2) / 2 - slack - 1e-9 * both
            largest = (both - np.maximum(near - slack, 0) ** 2) / 2 + slack + 1e-9 * both
        return np.where(self.high[:, 0] < 0, np.inf, least), np.where(self.high[:, 0] < 0, -np.inf, largest)


def open_children(least: np.ndarray, largest: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Which children (anchors x children) meet one of the anchor's windows (anchors x windows)."""
    out = np.zeros(least.shape, dtype=bool)
    for w in range(lows.shape[1]):
        lo, hi = lows[:, w:w + 1], highs[:, w:w + 1]
        # written so that a bound that is not a number keeps the child
        out |= ~(largest < lo) & ~(least > hi) & (lo <= hi)
    return out


class Tree:
    """The upper tree: nodes over a sample, cells numbered from 0; without nodes there is one cell."""

    def __init__(self, sample: np.ndarray, per_row: float, s: Settings):
        self.nodes: list[Node] = []
        #: the way to each cell: (node, child) from the root on
        self.ways: list[list[tuple[Node, int]]] = []
        self.root = self._grow(sample, per_row, s, [])

    def _grow(self, x: np.ndarray, per_row: float, s: Settings, way: list[tuple[Node, int]]):
        points = split_points(x, s.fan_out) if len(x) * per_row > s.cell_rows and len(x) >= 4 * s.fan_out and len(way) < 16 else x[:0]
        if len(points) < 2:
            self.ways.append(way)
            return len(self.ways) - 1
        node = Node(points, len(self.nodes))
        self.nodes.append(node)
        child = distances(x, points).argmin(axis=1)
        node.children = [self._grow(x[child == j], per_row, s, [*way, (node, j)]) for j in range(len(points))]
        return node

    def cell(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if not isinstance(at, Node):
                out[rows] = at
                continue
            child = distances(x[rows], at.points).argmin(axis=1)
            todo += [(at.children[j], rows[child == j]) for j in np.unique(child).tolist()]
        return out

    def row_ranges(self, cells: np.ndarray, x: np.ndarray):
        """(node, child, least distances, largest distances) for the rows ``x`` of the given cells."""
        for cell in np.unique(cells).tolist():
            for node, child in self.ways[cell]:
                each = distances(x[cells == cell], node.points)
                yield node.number, child, each.min(axis=0).tolist(), each.max(axis=0).tolist()

    def open_cells(self, q: np.ndarray, lows: np.ndarray, highs: np.ndarray, top: float) -> list[list[int]]:
        """For each anchor the cells whose ranges leave one of its windows open."""
        out: list[list[int]] = [[] for _ in range(len(q))]
        todo = [(self.root, np.arange(len(q)))]
        while todo:
            at, rows = todo.pop()
            if not isinstance(at, Node):
                for i in rows.tolist():
                    out[i].append(at)
                continue
            left = open_children(*at.scores_left(q[rows], top), lows[rows], highs[rows])
            todo += [(c, rows[left[:, j]]) for j, c in enumerate(at.children) if left[:, j].any()]
        return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows as longs (anchors x rows)."""
    size = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if size < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(q).astype(object) @ whole(x).astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def lifted(v: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack((v, np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0))))


def search_block(x, labels, first, q, q_labels, lows, highs, same: bool, many: int, top: float, s: Settings):
    """The best ``many`` rows of a block in each window of each anchor: (anchor, window, row, score), and the number of products made.

    ``first`` is a row's smallest id, which settles ties; ``lows`` and ``highs`` (anchors x windows) bound the scores, both ends included.
    """
    up = lifted(x, top)
    points = split_points(up[np.argsort(first, kind="stable")], max(2, len(x) // s.leaf_rows)) if len(x) > s.leaf_rows else up[:1]
    node = Node(points)
    child, node.low, node.high = node.ranges(up)
    zero = np.column_stack((q, np.zeros(len(q))))
    least, largest = node.scores_left(zero, top)
    windows = lows.shape[1]
    floor, ceiling = lows.copy(), highs
    held = [np.empty(0, dtype=np.int64)] * 4  # window, score, first id, row
    made = 0
    for j in range(len(points)):
        rows = np.nonzero(child == j)[0]
        if not len(rows):
            continue
        asked = np.nonzero(open_children(least[:, j:j + 1], largest[:, j:j + 1], floor, ceiling)[:, 0])[0]
        for at in range(0, len(asked), 1_024):
            some = asked[at:at + 1_024]
            score = products(q[some], x[rows])
            made += score.size
            fits = (q_labels[some][:, None] == labels[rows][None, :]) == same
            for w in range(windows):
                i, r = np.nonzero(fits & (score >= floor[some, w][:, None]) & (score <= ceiling[some, w][:, None]))
                held = [np.concatenate(p) for p in zip(held, (some[i] * windows + w, score[i, r], first[rows[r]], rows[r]))]
        order = np.lexsort((held[2], ~held[1], held[0]))  # ~ turns the order of longs round
        held = [h[order] for h in held]
        place = np.arange(len(order)) - np.searchsorted(held[0], held[0])
        held = [h[place < many] for h in held]
        full = held[0][place[place < many] == many - 1]
        floor[full // windows, full % windows] = held[1][place[place < many] == many - 1]
    return held[0] // windows, held[0] % windows, held[3], held[1], made


def prepared(vectors: DataFrame, key: str, vector: str, label: str, s: Settings) -> DataFrame:
    """(id, label, v) of the rows that take part, each once: v scaled, rounded down, filled up with zeros."""
    plain = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * s.scale) < F.lit(float("inf"))))
    plain = plain.where("id is not null and label is not null and v is not null").where(F.coalesce(finite, F.lit(False)))
    # doubles from 2**53 on are whole numbers already
    whole = F.transform("v", lambda c: F.when(F.abs(c * s.scale) < 2.0**53, F.floor(c * s.scale).cast("double")).otherwise(c * s.scale))
    rows = write_scratch(plain.select("id", "label", whole.alias("v")).distinct(), "scaled")
    width = rows.agg(F.max(F.size("v"))).scalar()
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), (width - F.size("v")).cast("int"))))


def mine(
    vectors: DataFrame, anchors, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """anchor, positive, rank, negative, positive_score, negative_score; ``anchors`` is a condition on the column id."""
    s = settings
    spark = vectors.sparkSession
    rows = write_scratch(prepared(vectors, key, vector, label, s), "rows")
    kind = rows.schema["id"].dataType.simpleString()
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    told = rows.agg(F.max(squares).alias("top"), F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not told["n"]:
        return spark.createDataFrame(
            [], f"anchor {kind}, positive {kind}, rank int, negative {kind}, positive_score bigint, negative_score bigint"
        )
    top, n = told["top"], told["n"]
    # equal vectors of one label: their smallest ids only; the limit works before the shuffle as well
    keep = max(s.positives, s.negatives) + 1
    nth = F.row_number().over(Window.partitionBy("v", "label").orderBy("id"))
    points = rows.withColumn("nth", nth).where(F.col("nth") <= keep).groupBy("v", "label").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    share = min(1.0, s.sample / n)
    drawn = rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("v").orderBy("v").limit(2 * s.sample)
    sample = np.array([r["v"] for r in drawn.collect()]).reshape(-1, told["width"])
    tree = Tree(np.unique(lifted(sample, top), axis=0), n / max(1, len(sample)), s)
    empty = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("long")
    def cell_of(v: pd.Series) -> pd.Series:
        return pd.Series(empty.value.cell(lifted(np.stack(v.to_numpy()), top)))

    placed = write_scratch(points.withColumn("cell", cell_of("v")), "points")

    def ranges(batches):
        for batch in batches:
            if len(batch):
                found = empty.value.row_ranges(batch["cell"].to_numpy(), lifted(np.stack(batch["v"].to_numpy()), top))
                yield pd.DataFrame(list(found), columns=["node", "child", "low", "high"])

    # at most sample / fan_out children, each with a range per split point
    each = placed.select("cell", "v").mapInPandas(ranges, "node int, child int, low array<double>, high array<double>")
    each = each.select("node", "child", F.posexplode(F.arrays_zip("low", "high")).alias("at", "r"))
    merged = each.groupBy("node", "child", "at").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high")).collect()
    for node in tree.nodes:
        node.low, node.high = (np.full((len(node.points),) * 2, x) for x in (np.inf, -np.inf))
    for r in merged:
        tree.nodes[r["node"]].low[r["child"], r["at"]], tree.nodes[r["node"]].high[r["child"], r["at"]] = r["low"], r["high"]
    index = spark.sparkContext.broadcast(tree)

    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    blocks_of = F.create_map(*[x for c, m in sorted(counts.items()) for x in (F.lit(c).cast("long"), F.lit(-(-m // s.cell_rows)))])
    numbered = placed.withColumn("block", F.pmod(F.xxhash64("v", "label"), F.element_at(blocks_of, F.col("cell"))).cast("int"))

    def windows_of(lows: pd.Series, highs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Arrays (anchors x windows); anchors with fewer windows get empty ones."""
        many = max([1, *map(len, lows)])
        low, high = np.full((len(lows), many), MOST), np.full((len(lows), many), LEAST)
        for i, (a, b) in enumerate(zip(lows, highs)):
            low[i, : len(a)], high[i, : len(b)] = a, b
        return low, high

    @F.pandas_udf("array<long>")
    def others(v: pd.Series, home: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy())
        cells = index.value.open_cells(np.column_stack((m, np.zeros(len(m)))), *windows_of(lows, highs), top)
        return pd.Series([[c for c in row if c != h] for row, h in zip(cells, home)])

    @F.pandas_udf("long")
    def own_cell(v: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy())
        return pd.Series(index.value.cell(np.column_stack((m, np.zeros(len(m))))))

    result = f"a bigint, w int, ids array<{kind}>, score bigint"

    def search(pairs: DataFrame, same: bool, many: int) -> DataFrame:
        """(a, v, label, cell, lows, highs) to the best rows of that cell in each window; block by block, anchors in portions."""
        sizes = {r["cell"]: r["count"] for r in pairs.groupBy("cell").count().collect() if r["cell"] in counts}
        if not sizes:
            return spark.createDataFrame([], result)
        portions = F.create_map(*[x for c, m in sorted(sizes.items()) for x in (F.lit(c).cast("long"), F.lit(-(-m // s.portion)))])
        left = numbered.where(F.col("cell").isin(list(sizes))).withColumn(
            "portion", F.explode(F.sequence(F.lit(0), F.element_at(portions, F.col("cell")) - 1))
        )
        right = (
            pairs.where(F.col("cell").isin(list(sizes)))
            .withColumn("portion", F.pmod(F.xxhash64("a"), F.element_at(portions, F.col("cell"))).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks_of, F.col("cell")) - 1)))
        )

        def run(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            if not len(x) or not len(q):
                return pd.DataFrame({"a": [], "w": [], "ids": [], "score": []})
            first = np.array([ids[0] for ids in x["ids"]])
            first = first if first.dtype == np.int64 else np.unique(first, return_inverse=True)[1]
            lows, highs = windows_of(q["lows"], q["highs"])
            codes = pd.factorize(pd.concat([x["label"], q["label"]]))[0]
            of, w, row, score, _ = search_block(
                np.stack(x["v"].to_numpy()), codes[: len(x)], first, np.stack(q["v"].to_numpy()), codes[len(x):], lows, highs, same, many, top, s
            )
            return pd.DataFrame({"a": q["a"].to_numpy()[of], "w": w, "ids": x["ids"].to_numpy()[row], "score": score})

        keys = ["cell", "block", "portion"]
        left = left.select(*keys, "v", "label", "ids")
        right = right.select(*keys, "a", "v", "label", "lows", "highs")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, result)

    asked = rows.where(anchors).withColumn("a", F.monotonically_increasing_id()).withColumn("cell", own_cell("v"))
    asked = write_scratch(asked.withColumnRenamed("id", "anchor"), "anchors")

    def best(found: DataFrame, many: int) -> DataFrame:
        """The first ``many`` rows of each window: a, w, rank, id, score."""
        each = found.select("a", "w", "score", F.explode("ids").alias("id")).join(asked.select("a", "anchor"), "a").where("id <> anchor")
        order = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many).drop("anchor")

    def two_rounds(pairs: DataFrame, same: bool, many: int) -> DataFrame:
        """The own cell first, then all cells that are still open given the last one found there."""
        near = write_scratch(search(pairs, same, many + 1), "near")
        found = best(near, many).where(F.col("rank") == many).groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("last"))
        raised = F.transform("lows", lambda lo, w: F.greatest(lo, F.coalesce(F.try_element_at("last", w), F.lit(LEAST))))
        # the last one's score itself stays open: a smaller id may have it too
        bounded = pairs.join(found, "a", "left").withColumn("lows", F.when(F.col("last").isNull(), F.col("lows")).otherwise(raised)).drop("last")
        routed = bounded.withColumn("cell", F.explode(others("v", "cell", "lows", "highs")))
        return best(near.unionByName(search(write_scratch(routed, "routed"), same, many + 1)), many)

    whole = asked.withColumn("lows", F.array(F.lit(LEAST))).withColumn("highs", F.array(F.lit(MOST)))
    likes = two_rounds(whole.drop("anchor"), True, s.positives).select("a", F.col("rank").alias("nth"), F.col("id").alias("positive"), "score")
    likes = write_scratch(likes, "positives")
    # decimals, so that no product overflows
    bounds = likes.withColumn("lo", F.expr(f"IF(score < 0, {MOST}L, (CAST(score AS DECIMAL(38,0)) * {s.low} + {s.base - 1}) div {s.base})"))
    bounds = bounds.withColumn("hi", F.expr(f"IF(score < 0, {LEAST + 1}L, CAST(score AS DECIMAL(38,0)) * {s.high} div {s.base})"))
    in_order = F.sort_array(F.collect_list(F.struct("nth", "lo", "hi")))
    windows = bounds.groupBy("a").agg(in_order.alias("b")).select("a", F.col("b.lo").alias("lows"), F.col("b.hi").alias("highs"))
    hard = two_rounds(asked.drop("anchor").join(windows, "a"), False, s.negatives)
    named = hard.withColumn("nth", F.col("w") + 1).select("a", "nth", "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
    return (
        named.join(likes, ["a", "nth"]).join(asked.select("a", "anchor"), "a")
        .select("anchor", "positive", "rank", "negative", F.col("score").alias("positive_score"), "negative_score")
    )
