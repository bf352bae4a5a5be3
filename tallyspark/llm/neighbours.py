"""Approximate nearest neighbours by largest inner product with vantage-point trees, one per shard.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, queries a zero: then the nearest in Euclidean
distance is the largest inner product, and the triangle inequality holds. Rows are dealt to shards by a hash of their id;
each shard builds a vantage-point tree over its distinct vectors. A block of queries walks each tree: a child is skipped
when ``factor`` times the lower bound of the distance to it exceeds the query's k-th nearest distance so far. Factor one
is exact; larger factors skip more. Leaves rank by inner product and then smaller id, distances only prune. Each shard's
k best per query meet in one aggregation.

What a factor costs depends on the lengths: one long vector makes M large and all distances nearly equal, and then a
factor a little over one skips most of the tree. So unless a factor is given, ``FACTOR`` is tried on ``SAMPLE`` queries
against factor one, over all rows, and used only if it finds ``RECALL`` of their neighbours; else the search is exact.

The answers of a shard are of vectors in that shard alone, and the k best of all are among the k best of the shards, so
sharding itself loses nothing.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import stored

K = 20
QUERY_EVERY = 20
FACTOR = 1.25
SAMPLE = 64  # queries, the first by a hash, that a factor is tried on
RECALL = 0.95  # of their neighbours that it must find
SHARD_ROWS = 16_384
BLOCK_ROWS = 8192  # queries of a block
WALK_ROWS = 1024  # queries that walk a tree together
LEAF = 192


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): ids and vectors as doubles; null ids, null, empty, zero and non-finite vectors are left out."""
    v = F.col(vec_col).cast("array<double>")
    return (
        df.select(F.col(id_col).alias("vec_id"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
        .filter(~F.exists("v", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0.0))
    )


def build(ids: np.ndarray, x: np.ndarray, radius: float, k: int) -> dict:
    """A vantage-point tree over the distinct rows of ``x``; of equal vectors the k + 1 smallest ids are enough.

    ``nodes``: (vantage position, inner bounds, outer bounds, children) as arrays; leaves are ranges of ``order``.
    """
    uniq, at = np.unique(x, axis=0, return_inverse=True)
    by = np.lexsort((ids, at.ravel()))
    sorted_at, sorted_ids = at.ravel()[by], ids[by]
    starts = np.searchsorted(sorted_at, np.arange(len(uniq) + 1))
    own = [sorted_ids[s : min(e, s + k + 1)] for s, e in zip(starts[:-1], starts[1:], strict=True)]
    lift = np.sqrt(np.maximum(radius * radius - (uniq * uniq).sum(axis=1), 0.0))
    p = np.concatenate([uniq, lift[:, None]], axis=1)
    order = np.arange(len(uniq))
    rng = np.random.default_rng(len(uniq))
    nodes: list[tuple] = []  # (vantage point, (lo, hi, child or leaf) of the inner and of the outer part)

    def grow(a: int, b: int) -> int:
        """Node over order[a:b]; returns its number."""
        me = len(nodes)
        nodes.append(())
        if b - a <= LEAF:
            nodes[me] = ("leaf", a, b)
            return me
        v = order[a + int(rng.integers(b - a))]
        d = np.sqrt(np.maximum(((p[order[a:b]] - p[v]) ** 2).sum(axis=1), 0.0))
        mid = (b - a) // 2
        part = np.argpartition(d, mid)
        order[a:b], d = order[a:b][part], d[part]
        inner = (float(d[:mid].min()), float(d[:mid].max()), grow(a, a + mid))
        outer = (float(d[mid:].min()), float(d[mid:].max()), grow(a + mid, b))
        nodes[me] = ("split", int(v), inner, outer)
        return me

    if len(uniq):
        grow(0, len(uniq))
    return {"p": p, "order": order, "own": own, "nodes": nodes}


def search(tree: dict, q: np.ndarray, k: int, factor: float) -> np.ndarray:
    """Positions of each query's k + 1 best distinct vectors (-1: fewer), by a walk of all queries together.

    The best have the largest inner products, of equal ones the smallest ids: one more than k, as one may hold the query.
    """
    p, order, nodes = tree["p"], tree["order"], tree["nodes"]
    x = np.ascontiguousarray(p[:, :-1])
    first = np.array([own[0] for own in tree["own"]])
    keep = min(k + 1, len(p))
    best = np.full((len(q), keep), -np.inf)  # in order, the worst last
    held = np.full((len(q), keep), -1)
    qq, pp = (q * q).sum(axis=1), (p * p).sum(axis=1)
    unit = 8 * (p.shape[1] + 1) * np.finfo(float).eps  # bounds the relative error of a sum of products
    qn, xn = np.sqrt(qq), np.sqrt((x * x).sum(axis=1))
    radius2 = float(pp.max()) if len(pp) else 0.0
    error = unit * (qq + radius2)  # of a squared distance

    def leaf(at: np.ndarray, active: np.ndarray) -> None:
        s = q[active] @ x[at].T
        e = unit * qn[active, None] * xn[None, at]
        least = best[active, -1]
        if len(at) >= keep:
            least = np.maximum(least, np.partition(s - e, len(at) - keep, axis=1)[:, len(at) - keep])
        high = s + e >= least[:, None]
        hit = high.any(axis=1)
        rows, high = active[hit], high[hit]
        if not len(rows):
            return
        # Few vectors are left: their products are taken one by one, so that equal vectors' products are equal.
        some = np.argsort(~high, axis=1, kind="stable")[:, : int(high.sum(axis=1).max())]
        own, col = np.nonzero(np.take_along_axis(high, some, 1))
        where = at[some]
        exact = np.full(some.shape, -np.inf)
        for i in range(0, len(own), 65_536):
            r, c = own[i : i + 65_536], col[i : i + 65_536]
            exact[r, c] = np.einsum("ij,ij->i", x[where[r, c]], q[rows[r]])
        both = np.concatenate([best[rows], exact], axis=1)
        who = np.concatenate([held[rows], where], axis=1)
        pick = np.lexsort((first[who], -both), axis=1)[:, :keep]
        best[rows] = np.take_along_axis(both, pick, 1)
        held[rows] = np.where(best[rows] == -np.inf, -1, np.take_along_axis(who, pick, 1))

    def visit(node: int, active: np.ndarray) -> None:
        kind, *rest = nodes[node]
        if kind == "leaf":
            leaf(order[rest[0] : rest[1]], active)
            return
        v, inner, outer = rest
        d = np.sqrt(np.maximum(qq[active] + pp[v] - 2 * (q[active] @ x[v]), 0.0))
        near = np.abs(d - 0.5 * (inner[0] + inner[1])) <= np.abs(d - 0.5 * (outer[0] + outer[1]))
        # Each query goes to its nearer side first; the other side is judged with the distances found there.
        for group, sides in ((near, (inner, outer)), (~near, (outer, inner))):
            rows, dist = active[group], d[group]
            for lo, hi, child in sides:
                bound = np.maximum(np.maximum(lo - dist, dist - hi), 0.0)
                worst = np.sqrt(np.maximum(qq[rows] + radius2 - 2 * best[rows, -1], 0.0))
                slack = 4 * error[rows] / np.maximum(np.minimum(dist, worst), np.sqrt(error[rows]))
                go = factor * bound <= worst + factor * slack
                if go.any():
                    visit(child, rows[go])

    if nodes:
        visit(0, np.arange(len(q)))
    return held


def _build(key: tuple, pdf: pd.DataFrame, radius: float, k: int) -> pd.DataFrame:
    tree = build(pdf["vec_id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64), radius, k)
    return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree, protocol=5)]})


def _answer(tree_rows: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """The k best of one shard for each query of one block."""
    out = []
    if len(tree_rows) and len(queries):
        tree = pickle.loads(tree_rows["tree"].iloc[0])
        qid = queries["vec_id"].to_numpy()
        q = np.stack(queries["v"].to_numpy()).astype(np.float64)
        for a in range(0, len(q), WALK_ROWS):
            held = search(tree, q[a : a + WALK_ROWS], k, factor)
            for i in range(len(held)):
                at = held[i][held[i] >= 0]
                score = np.einsum("ij,j->i", tree["p"][at, : q.shape[1]], q[a + i])
                own = int(qid[a + i])
                near = [(-s, v) for s, j in zip(score.tolist(), at.tolist(), strict=True) for v in tree["own"][j].tolist() if v != own]
                out += [(own, v, -s) for s, v in sorted(near)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


class Forest:
    """Vectors (vec_id, v), v doubles as :func:`usable` gives them, in shards with a vantage-point tree each."""

    def __init__(self, vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> None:
        self.k = k
        vectors = stored(vectors.dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")))
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        extent = vectors.groupBy("dim").agg(F.count("*").alias("rows"), F.max(norm).alias("radius"))
        extent = extent.select("dim", "radius", F.ceil(F.col("rows") / F.lit(shard_rows)).cast("int").alias("shards"))
        radius = float(extent.agg(F.max("radius")).first()[0] or 1.0)  # of all lengths: any common radius keeps the order
        self.dims = F.broadcast(extent.select("dim", "shards"))  # one row per vector length
        self.trees = stored(
            vectors.join(self.dims, "dim")
            .withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
            .groupBy("dim", "shard")
            .applyInPandas(lambda key, pdf: _build(key, pdf, radius, k), "dim int, shard int, tree binary")
        )

    def ask(self, queries: DataFrame, factor: float) -> DataFrame:
        """(query_id, rank, vec_id, score) for queries (vec_id, v, dim)."""
        k = self.k
        blocks = max(1, -(-queries.count() // BLOCK_ROWS))
        # A stated query set, in blocks, against every shard: a task holds one tree and one block.
        at = ["dim", "shard", "block"]
        dealt = queries.join(self.dims, "dim").select(
            "dim",
            F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
            F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)).cast("int").alias("block"),
            "vec_id",
            "v",
        )
        spread = self.trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = (
            spread.groupBy(*at)
            .cogroup(dealt.groupBy(*at))
            .applyInPandas(lambda t, q: _answer(t, q, k, factor), "query_id long, vec_id long, score double")
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def recall(self, queries: DataFrame, factor: float, sample: int = SAMPLE) -> float:
        """The share of neighbours that ``factor`` finds for the first queries by a hash; 1 if they have none."""
        some = stored(queries.orderBy(F.xxhash64(F.lit("sample"), "vec_id"), "vec_id").limit(sample))
        both = self.ask(some, 1.0).join(self.ask(some, factor).select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
        found, wanted = both.agg(F.count("hit"), F.count(F.lit(1))).first()
        return found / wanted if wanted else 1.0


def search_all(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query among the other rows.

    Both tables hold (vec_id, v), v doubles as :func:`usable` gives them. Queries meet vectors of their own length only,
    and never rows of their own id; ties go to the smaller id; repeated rows count
    once, and a query id with several vectors asks with the smallest. Without a ``factor`` the recall of ``FACTOR``
    decides between it and one.
    """
    forest = Forest(vectors, k, shard_rows)
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    if factor is None:
        factor = FACTOR if forest.recall(queries, FACTOR) >= RECALL else 1.0
    return forest.ask(queries, factor)


def report(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = QUERY_EVERY, k: int = K, factor: float | None = None) -> DataFrame:
    """Every row whose id is divisible by ``every`` against all rows."""
    vectors = usable(df, id_col, vec_col)
    return search_all(vectors, vectors.filter(F.col("vec_id") % every == 0), k, factor)
