"""Hard-negative mining by largest integer inner product with cover trees over norm-augmented candidates.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, so all lie on one sphere, and queries a zero.
With r the radius that covers a node's vectors around its centre c, each of them has an inner product with q within
q.c - |q| r and q.c + |q| r. The top level of the tree is shared: cells around centres, cut into shards of bounded size,
each with a covering radius of its own; below it each shard holds a tree, built level by level from nets of half the
radius above. A query goes only to shards whose bounds meet one of its windows; in a tree it opens the node of the
largest upper bound first and skips nodes outside all its windows or below the worst of a window's best. Vectors in
leaves are verified by exact integer products.

First each anchor finds its positives (same label, no window): in its own cell, then in the cells that can hold better
ones. Each positive sets a window of scores for the negatives (other labels). Equal vectors of one label are one
candidate that carries its smallest ids, one more than can be asked for, so copies cost nothing and no row is lost.

Defined cases: rows with a null id, label or vector or a null or non-finite component take no part; the integers'
products must fit 62 bits, larger ones raise an error; shorter vectors count as filled with zeros; an empty vector takes
part with products of zero; repeated rows count once; a row never meets another of its own id; an anchor id with several
rows asks with the smallest (label, vector); ties go to the smaller id; an empty table gives an empty result; further
columns aren't looked at.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import stored

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
SCALE = 256
LOW_PERCENT, HIGH_PERCENT = 30, 90
SHARD_ROWS = 8192
MAX_CENTRES = 1024  # of the top level; more shards than that are parts of a cell
LEAF = 32
CHUNK = 256  # vectors verified at once
FOUND = "anchor_id long, tag long, vec_id long, score long"


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(vec_id, label, v): rows that take part, v as integers floor(256 x)."""
    x = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), (F.col("label") if label is None else label).cast("bigint").alias("label"), x.alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    rows = rows.filter(~F.exists("x", lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))))
    return rows.select("vec_id", "label", F.transform("x", lambda y: F.floor(F.lit(float(SCALE)) * y).cast("bigint")).alias("v"))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _lifted(x: np.ndarray, radius: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(radius * radius - (x * x).sum(axis=1), 0.0))[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _net(p: np.ndarray, gap: float) -> np.ndarray:
    """Positions of points more than ``gap`` apart that cover all of ``p`` within it; the first point is one."""
    centres = [0]
    for a in range(1, len(p), CHUNK):
        block = p[a : a + CHUNK]
        free = np.flatnonzero(_distances(block, p[centres]).min(axis=1) > gap)
        if not len(free):
            continue
        own = _distances(block[free], block[free])
        covered = np.zeros(len(free), dtype=bool)
        for i in range(len(free)):
            if not covered[i]:
                centres.append(a + int(free[i]))
                covered |= own[i] <= gap
    return np.array(centres)


def build(x: np.ndarray, radius: float) -> dict:
    """The cover tree of the distinct integer rows ``x``, all of norm ``radius`` at most.

    ``nodes``: arrays (centre, covering radius, child or -1, first, last) over the groups of a node; a group without
    a child is verified whole, its members are ``order[first:last]``.
    """
    p = _lifted(x, radius)
    slack = 1e-7 * (radius + 1.0)  # of a distance, far above its rounding error
    order = np.arange(len(x))
    nodes: list[list] = []
    todo = [(0, len(x), float(_distances(p[:1], p).max()) if len(x) else 0.0)]
    links: list[tuple[int, int] | None] = [None]
    while todo:
        first, last, r = todo.pop()
        link = links.pop()
        if link is not None:
            nodes[link[0]][2][link[1]] = len(nodes)
        at = order[first:last].copy()
        centres = np.array([0])
        while len(centres) == 1 and last - first > LEAF and r > slack:
            r /= 2.0
            centres = _net(p[at], r)
        if len(centres) == 1:  # small, or all within rounding of each other
            group, far = np.zeros(len(at), dtype=int), _distances(p[at], p[at[:1]])[:, 0]
        else:
            near = [_distances(p[at[a : a + CHUNK]], p[at[centres]]) for a in range(0, len(at), CHUNK)]
            group = np.concatenate([d.argmin(axis=1) for d in near])
            far = np.concatenate([d.min(axis=1) for d in near])
            group[centres] = np.arange(len(centres))
            far[centres] = 0.0
        by = np.lexsort((far, group))  # a group's centre first: it's the first point of its child
        order[first:last] = at[by]
        ends = first + np.searchsorted(group[by], np.arange(len(centres) + 1))
        reach = np.zeros(len(centres))
        np.maximum.at(reach, group, far)
        nodes.append([at[centres], reach + slack, np.full(len(centres), -1), ends[:-1], ends[1:]])
        for g in np.flatnonzero(ends[1:] - ends[:-1] > LEAF) if len(centres) > 1 else ():
            todo.append((int(ends[g]), int(ends[g + 1]), float(reach[g])))
            links.append((len(nodes) - 1, int(g)))
    return {"order": order, "nodes": nodes if len(x) else []}


class _Best:
    """The ``keep`` best of a window: larger scores first, then smaller first ids."""

    def __init__(self, low: float, high: float, keep: int) -> None:
        self.low, self.high, self.keep = low, high, keep
        self.score, self.at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    @property
    def least(self) -> float:
        return self.low if len(self.score) < self.keep else max(self.low, int(self.score[-1]))

    def add(self, score: np.ndarray, at: np.ndarray, first: np.ndarray) -> None:
        fit = (score >= self.least) & (score <= self.high)
        if fit.any():
            score, at = np.concatenate([self.score, score[fit]]), np.concatenate([self.at, at[fit]])
            pick = np.lexsort((first[at], -score))[: self.keep]
            self.score, self.at = score[pick], at[pick]


def search(tree: dict, q: np.ndarray, fits: np.ndarray, windows: list[tuple[float, float]], keep: int) -> list[_Best]:
    """For each window of scores the best candidates that ``fits`` allows; ``q`` holds integers.

    ``tree``: of :func:`build`, with the candidates ``x`` (as doubles if their products are exact), ``wide`` (int64, else
    None), ``first`` ids and ``radius``.
    """
    best = [_Best(low, high, keep) for low, high in windows]
    x, order, nodes = tree["x"], tree["order"], tree["nodes"]
    qf = q.astype(np.float64)
    norm = math.sqrt(float(qf @ qf))
    slack = 1e-7 * norm * tree["radius"] + 1e-6
    heap = [(-math.inf, 0)] if nodes else []

    def meets(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        out = np.zeros(len(upper), dtype=bool)
        for b in best:
            out |= (upper >= b.least) & (lower <= b.high)
        return out

    def verify(at: np.ndarray) -> None:
        at = at[fits[at]]
        if len(at):
            score = (x[at] @ qf).astype(np.int64) if tree["wide"] is None else tree["wide"][at] @ q
            for b in best:
                b.add(score, at, tree["first"])

    while heap:
        upper, node = heapq.heappop(heap)
        if all(-upper < b.least for b in best):
            break  # no node left reaches a window
        centre, reach, child, first, last = nodes[node]
        s = x[centre] @ qf
        high, low = s + norm * reach + slack, s - norm * reach - slack
        alive = np.flatnonzero(meets(high, low))
        for g in alive[child[alive] >= 0].tolist():
            heapq.heappush(heap, (-float(high[g]), int(child[g])))
        flat = alive[child[alive] < 0]
        flat = flat[np.argsort(-high[flat], kind="stable")]
        size = np.cumsum(last[flat] - first[flat])
        a = 0
        while a < len(flat):
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + CHUNK, side="right")))
            some = flat[a:b]
            some = some[meets(high[some], low[some])]
            if len(some):
                verify(np.concatenate([order[f:e] for f, e in zip(first[some], last[some], strict=True)]))
            a = b
    return best


def _exact(radius: float) -> bool:
    """Whether sums of products are exact in doubles."""
    if radius * radius >= 2.0**62:
        raise ArithmeticError("inner products beyond 62 bits")
    return radius * radius < 2.0**52


def _plant(key: tuple, pdf: pd.DataFrame, radius: float, dim: int) -> pd.DataFrame:
    """A shard's tree, and the covering radius of the shard around its cell's centre."""
    x = _matrix(pdf["v"], dim)
    tree = build(x, radius)
    fine = _exact(radius)
    tree |= {"x": x.astype(np.float64), "wide": None if fine else x, "radius": radius}
    tree |= {"label": pdf["label"].to_numpy(), "ids": [np.array(i) for i in pdf["ids"]]}
    tree["first"] = np.array([i[0] for i in tree["ids"]])
    return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps(tree, protocol=5)]})


def _cells(centres: np.ndarray, radius: float, dim: int) -> Callable:
    """A UDF: (number of the nearest centre, distance to it)."""

    @F.pandas_udf("cell int, far double")
    def nearest(v: pd.Series) -> pd.DataFrame:
        d = _distances(_lifted(_matrix(v, dim), radius), _lifted(centres, radius))
        return pd.DataFrame({"cell": d.argmin(axis=1).astype("int32"), "far": d.min(axis=1)})

    return nearest


def _route(batches: Iterator[pd.DataFrame], shards: dict, radius: float, dim: int, home: bool | None) -> Iterator[pd.DataFrame]:
    """Queries packed by the shard that they must visit: those of their own cell, of other cells, or (None) of all."""
    slack = 1e-7 * (radius + 1.0)
    for pdf in batches:
        q = _matrix(pdf["v"], dim)
        s = q.astype(np.float64) @ shards["centre"].T.astype(np.float64)
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None]
        spread = norm * (shards["far"][None] + slack) + slack * norm + 1e-6
        meets = np.zeros(s.shape, dtype=bool)
        for i, windows in enumerate(pdf["windows"]):
            for w in windows:
                low, high = _bounds(w)
                meets[i] |= (s[i] + spread[i] >= low) & (s[i] - spread[i] <= high)
        if home is not None:
            meets &= (shards["cell"][None] == pdf["cell"].to_numpy()[:, None]) == home
        for j in np.flatnonzero(meets.any(axis=0)):
            some = np.flatnonzero(meets[:, j])
            pack = (pdf["vec_id"].to_numpy()[some], pdf["label"].to_numpy()[some], q[some], [[(w["tag"], *_bounds(w)) for w in pdf["windows"].iloc[i]] for i in some])
            yield pd.DataFrame({"shard": [int(shards["shard"][j])], "kind": [1], "load": [pickle.dumps(pack, protocol=5)]})


def _bounds(w: dict) -> tuple[float, float]:
    return (-math.inf if w["low"] is None else w["low"], math.inf if w["high"] is None else w["high"])


def _answer(batches: Iterator[pd.DataFrame], k: int, same: bool) -> Iterator[pd.DataFrame]:
    """The k best rows of a shard for each window; a shard's tree comes first, its queries follow."""
    tree: dict = {}
    for pdf in batches:
        out: list[tuple] = []
        for kind, load in zip(pdf["kind"], pdf["load"], strict=True):
            if kind == 0:
                tree = pickle.loads(load)
                continue
            for anchor, label, q, windows in zip(*pickle.loads(load), strict=True):
                fits = (tree["label"] == label) == same
                found = search(tree, q, fits, [w[1:] for w in windows], k + 1)
                for (tag, *_), b in zip(windows, found, strict=True):
                    rows = [(-s, i) for s, at in zip(b.score.tolist(), b.at.tolist(), strict=True) for i in tree["ids"][at].tolist() if i != anchor]
                    out += [(int(anchor), tag, i, -s) for s, i in sorted(rows)[:k]]
        yield pd.DataFrame(out, columns=["anchor_id", "tag", "vec_id", "score"])


class Index:
    """Candidates (vec_id, label, v), integer vectors, in shards with a cover tree each."""

    def __init__(self, rows: DataFrame, most: int, shard_rows: int = SHARD_ROWS, max_centres: int = MAX_CENTRES) -> None:
        """``most``: the most rows that a search asks for."""
        self.rows = stored(rows.dropDuplicates(["vec_id", "label", "v"]))
        by_id = Window.partitionBy("label", "v").orderBy("vec_id")
        first = self.rows.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= most + 1)
        classes = stored(first.groupBy("label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        n, dim, norm = classes.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.sqrt(square))).first()
        self.dim, self.radius = dim or 0, (norm or 0.0) * (1 + 1e-9) + 1e-9
        _exact(self.radius)
        wanted = min(max_centres, max(1, -(-n // shard_rows)))
        # At most ``max_centres`` vectors reach the driver; the first in the order of a hash.
        top = classes.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
        self.centres = _matrix(pd.Series([r["v"] for r in top], dtype=object), self.dim) if top else np.zeros((1, self.dim), dtype=np.int64)
        self.nearest = _cells(self.centres, self.radius, self.dim)
        celled = stored(classes.withColumn("near", self.nearest("v")))
        # Cells of more rows than a shard takes are cut by a hash into parts.
        parts = celled.groupBy("near.cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("parts"))
        numbered = Window.orderBy("cell")  # one row per cell, max_centres at most
        parts = parts.withColumn("offset", (F.sum("parts").over(numbered) - F.col("parts")).cast("int"))
        part = F.pmod(F.xxhash64(F.lit("part"), "label", "v"), F.col("parts")).cast("int")
        dealt = stored(
            celled.withColumn("cell", F.col("near.cell")).join(F.broadcast(parts), "cell").withColumn("shard", F.col("offset") + part)
        )
        self.shards = dealt.groupBy("shard").agg(F.first("cell").alias("cell"), F.max("near.far").alias("far"))
        radius, dim = self.radius, self.dim
        self.trees = stored(
            dealt.groupBy("shard").applyInPandas(lambda key, pdf: _plant(key, pdf, radius, dim), "shard int, tree binary")
        )

    def search(self, queries: DataFrame, k: int, same: bool, home: bool | None = None) -> DataFrame:
        """(anchor_id, tag, vec_id, score): at least the k best of each window among the rows of the same or other labels.

        ``queries``: (vec_id, label, v, cell, windows), windows an array of (tag, low, high) with null for no bound. One
        row per shard, two numbers each, reaches the driver.
        """
        listed = self.shards.orderBy("shard").toPandas()
        cell = listed["cell"].to_numpy(dtype=int)
        shards = {"shard": listed["shard"].to_numpy(), "cell": cell, "far": listed["far"].to_numpy(), "centre": self.centres[cell]}
        route = partial(_route, shards=shards, radius=self.radius, dim=self.dim, home=home)
        loads = queries.mapInPandas(route, "shard int, kind int, load binary")
        trees = self.trees.select("shard", F.lit(0).alias("kind"), F.col("tree").alias("load"))
        # Each shard's tree is followed by its queries: a task holds one tree and one batch of them.
        dealt = trees.unionByName(loads).repartition("shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInPandas(partial(_answer, k=k, same=same), FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    shard_rows: int = SHARD_ROWS,
    max_centres: int = MAX_CENTRES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), see the module.

    Both tables hold (vec_id, label, v) as :func:`usable` gives them. A negative's score lies between the two
    percentages of the positive's, both included.
    """
    index = Index(rows, max(positives, negatives), shard_rows, max_centres)
    asked = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v")
    asked = stored(asked.withColumn("cell", index.nearest("v")["cell"]))
    window = lambda tag, low, high: F.struct(tag.cast("bigint").alias("tag"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))
    none = F.lit(None)
    own = asked.withColumn("windows", F.array(window(F.lit(0), none, none)))
    near = stored(index.search(own, positives, same=True, home=True))
    # The worst of an anchor's best so far bounds what other cells must offer.
    worst = _ranked(near, positives).filter(F.col("rank") == positives).select(F.col("anchor_id").alias("vec_id"), F.col("score").alias("least"))
    rest = asked.join(worst, "vec_id", "left").withColumn("windows", F.array(window(F.lit(0), F.col("least"), none))).drop("least")
    far = index.search(rest, positives, same=True, home=False)
    chosen = stored(_ranked(near.unionByName(far), positives).select("anchor_id", F.col("rank").cast("bigint").alias("tag"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    # Integer division towards zero, mended to the ceiling and the floor.
    low = (F.lit(low_percent) * p + F.pmod(-F.lit(low_percent) * p, F.lit(100))).cast("decimal(38,0)") / F.lit(100)
    high = (F.lit(high_percent) * p - F.pmod(F.lit(high_percent) * p, F.lit(100))).cast("decimal(38,0)") / F.lit(100)
    bounds = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window(F.col("tag"), low, high))).alias("windows"))
    wanted = asked.join(bounds.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = _ranked(index.search(wanted, negatives, same=False), negatives)
    return found.join(chosen, ["anchor_id", "tag"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def report(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", every: int = ANCHOR_EVERY, **how: int) -> DataFrame:
    """Hard negatives of every row whose id is divisible by ``every``; ids divisible by 7 take the next of ten labels."""
    label = F.col(label_col).cast("bigint")
    label = F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = usable(df, id_col, vec_col, label)
    return mine(rows, rows.filter(F.col("vec_id") % every == 0), **how)
