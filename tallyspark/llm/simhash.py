"""SimHash near-duplicate groups by a binary trie self-join.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 hashes of the document's word shingles. Two
fingerprints link at ``budget`` or fewer differing bits; groups are the connected components.

The join walks pairs of nodes of a binary trie together, from (root, root) down: a pair of nodes carries the bits in
which their paths differ and is dropped when that count exceeds the budget. To share the walk between tasks the trie is
laid out four times, each time with another 16 bits first: of four blocks at least one agrees whenever at most three
bits differ, so under that layout the first 16 levels need no error budget and the node pairs at depth 16 are the equal
ones. Pairs of nodes with more than ``GROUP`` fingerprints are walked down further as Spark joins, eight levels at a
time, until each is small enough for one task (a node at depth 64 is one fingerprint, so this ends). A task walks its
pairs bit by bit and hands out, for each, only a forest that connects the linked fingerprints, never all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import LOWER, UPPER, stored

SHINGLE = 3
BUDGET = 3
BLOCK = 16  # bits that agree in one of four layouts
GROUP = 4096  # fingerprints of a node pair that one task walks
TEXTS = 1000  # texts whose hashes a task holds at once
BATCH = 400_000  # fingerprints that a task holds at once (whole node pairs)


def shingle_hashes(text: Column, size: int = SHINGLE) -> tuple[Column, Column]:
    """(words, hashes given a column ``w`` of words): XXH64, seed 42, of each run of ``size`` words joined by spaces."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r" + UPPER, " " * 5 + LOWER)
    w = F.array_remove(F.split(plain, " "), "")
    runs = F.transform(
        F.sequence(F.lit(0), F.size("w") - size),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(F.col("w"), i + j) for j in range(size)])),
    )
    return w, (
        F.when(F.size("w") >= size, runs).when(F.size("w") > 0, F.array(F.xxhash64(F.array_join("w", " "))))
    )


def _majority(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The bits set in over half of each row's hashes; no hashes give zero."""
    for batch in hashes:
        out = np.zeros(len(batch), np.uint64)
        for row, h in enumerate(batch):
            if h is None or len(h) == 0:
                continue
            bits = np.zeros(64, np.int64)
            h = np.ascontiguousarray(h, np.int64).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(h), 8192):
                bits += np.unpackbits(h[at : at + 8192], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[row] = np.packbits(bits * 2 > len(h), bitorder="little").view(np.uint64)[0]
        yield pd.Series(out.view(np.int64))


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Each row of ``docs`` as a struct ``row``, with its fingerprint ``fp`` (the 64 bits as a long)."""
    w, hashes = shingle_hashes(F.col("row").getField(text_col), shingle)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.withColumn("w", w).withColumn("h", hashes).select("row", F.pandas_udf(_majority, T.LongType())("h").alias("fp"))


def walk(fp: np.ndarray, start: np.ndarray, end: np.ndarray, start2: np.ndarray, end2: np.ndarray, depth: int, err: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walk trie node pairs together; yields arrays of linked positions.

    ``fp`` holds the paths, sorted within each node; a node is a range of positions. Pairs of a node with itself keep
    both ranges equal.
    """
    frontier = (start, end, start2, end2, err)
    step = 200_000
    todo = [(depth, frontier)]
    while todo:
        depth, (a, b, c, d, e) = todo.pop()
        if len(a) > step:  # bound the memory of one level
            todo += [(depth, tuple(x[i : i + step] for x in (a, b, c, d, e))) for i in range(0, len(a), step)]
            continue
        one = (b - a == 1) & (d - c == 1)
        if one.any():  # two single paths: count the rest at once
            i, j = a[one], c[one]
            near = (i != j) & (np.bitwise_count(fp[i] ^ fp[j]) <= budget)
            yield i[near], j[near]
            a, b, c, d, e = (x[~one] for x in (a, b, c, d, e))
        if not len(a) or depth == 64:
            continue
        bit = np.uint64(63 - depth)
        m, n = _split(fp, a, b, bit), _split(fp, c, d, bit)
        same = (a == c) & (b == d)
        cross = ~same
        parts = [
            (a, m, c, n, e, np.ones(len(a), bool)),
            (m, b, n, d, e, np.ones(len(a), bool)),
            (a, m, n, d, e + 1, np.ones(len(a), bool)),
            (m, b, c, n, e + 1, cross),  # of a node with itself one of the two mixed pairs is enough
        ]
        keep = [tuple(x[ok] for x in (p, q, r, s, t)) for p, q, r, s, t, k in parts for ok in [k & (q > p) & (s > r) & (t <= budget)]]
        a, b, c, d, e = (np.concatenate(x) for x in zip(*keep, strict=True))
        live = ~((a == c) & (b == d) & (b - a == 1))  # a single path with itself has no partner
        if live.any():
            todo.append((depth + 1, tuple(x[live] for x in (a, b, c, d, e))))


def _split(fp: np.ndarray, a: np.ndarray, b: np.ndarray, bit: np.uint64) -> np.ndarray:
    """First position in each range [a, b) whose path has ``bit`` set (paths in a range agree above it, and are sorted)."""
    lo, hi = a.copy(), b.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = ((fp[np.minimum(mid, len(fp) - 1)] >> bit) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position of each position's component."""
    root = np.arange(n)
    for i, j in links:
        while len(i):
            ri, rj = root[i], root[j]
            lo, hi = np.minimum(ri, rj), np.maximum(ri, rj)
            open_ = lo != hi
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            np.minimum.at(root, hi[open_], lo[open_])
            while (root[root] != root).any():
                root = root[root]
    return root


def _task_links(budget: int, batch_rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size >= batch_rows:
                t = pd.concat(held, ignore_index=True)
                key = t[["layout", "depth", "pa", "pb"]].to_numpy()
                last = int((key != key[-1]).any(axis=1).nonzero()[0].max(initial=-1)) + 1
                if last:  # whole node pairs only; the last may go on in the next batch
                    yield _forest(t.iloc[:last], budget)
                held, size = [t.iloc[last:]], len(t) - last
        if size:
            yield _forest(pd.concat(held, ignore_index=True), budget)

    return run


def _forest(t: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Links (u, v) that connect what is linked within the node pairs of ``t``: rows by pair, side, path."""
    t = t.reset_index(drop=True)
    path = t["path"].to_numpy(np.int64).view(np.uint64)
    change = (t[["layout", "depth", "pa", "pb", "side"]].to_numpy()[1:] != t[["layout", "depth", "pa", "pb", "side"]].to_numpy()[:-1]).any(axis=1)
    a = np.concatenate([[0], change.nonzero()[0] + 1])
    b = np.concatenate([a[1:], [len(t)]])
    own = (t["pa"] == t["pb"]).to_numpy()[a]  # a node with itself has one side
    side = t["side"].to_numpy()[a]
    depth, err = t["depth"].to_numpy()[a], t["err"].to_numpy()[a].astype(np.int64)

    def links():
        for d in np.unique(depth):
            i = (own & (depth == d) & (b - a > 1)).nonzero()[0]
            yield from walk(path, a[i], b[i], a[i], b[i], int(d), err[i], budget)
            i = (~own & (depth == d) & (side == 0)).nonzero()[0]  # its other side follows
            yield from walk(path, a[i], b[i], a[i + 1], b[i + 1], int(d), err[i], budget)

    fp = t["fp"].to_numpy(np.int64)
    # One fingerprint stands in many node pairs: components are taken over fingerprints, not positions.
    values, at = np.unique(fp, return_inverse=True)
    root = _roots(len(values), ((at[i], at[j]) for i, j in links()))
    moved = (root != np.arange(len(values))).nonzero()[0]
    return pd.DataFrame({"u": values[moved], "v": values[root[moved]]})


def _top(path: str, depth: int) -> Column:
    """The first ``depth`` bits of a path, as a long."""
    return F.shiftrightunsigned(F.col(path), 64 - depth) if depth else F.lit(0).cast("long")


def links(fps: DataFrame, budget: int = BUDGET, group: int = GROUP, batch_rows: int = BATCH) -> DataFrame:
    """(u, v): links that connect every two of the distinct fingerprints ``fps.fp`` whose bits differ in 1..budget places.

    A superset of no component: only linked fingerprints are connected. Budgets over three would need more layouts.
    """
    if not 0 <= budget < 64 // BLOCK:
        raise ValueError(f"budget must be 0 to {64 // BLOCK - 1}")
    turned = [F.shiftleft("fp", r).bitwiseOR(F.shiftrightunsigned("fp", 64 - r)) if r else F.col("fp") for r in range(0, 64, BLOCK)]
    laid = stored(
        fps.select("fp", F.posexplode(F.array(*turned)).alias("layout", "path"))
    )
    counts = laid.groupBy("layout", _top("path", BLOCK).alias("p")).agg(F.count("*").alias("n"))
    pairs = counts.filter("n > 1").select("layout", F.lit(BLOCK).alias("depth"), F.col("p").alias("pa"), F.col("p").alias("pb"), F.lit(0).alias("err"), (F.col("n")).alias("n"))
    ready = None
    depth = BLOCK
    while True:
        pairs = stored(pairs)
        done = pairs.filter((F.col("n") <= group) | (F.col("depth") >= 64))
        ready = done if ready is None else ready.unionByName(done)
        large = pairs.filter((F.col("n") > group) & (F.col("depth") < 64))
        if large.isEmpty():
            break
        pairs = _deeper(laid, large, depth, budget)
        depth += 8
    ready = ready.filter("n > 1")
    out = None
    depths = sorted(r[0] for r in ready.select("depth").distinct().collect())
    for d in depths:
        here = ready.filter(F.col("depth") == d).select("layout", "pa", "pb", "err")
        sides = here.select("*", F.explode(F.when(F.col("pa") == F.col("pb"), F.array(F.struct(F.lit(0).alias("side"), F.col("pa").alias("p")))).otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("pa").alias("p")), F.struct(F.lit(1).alias("side"), F.col("pb").alias("p"))))).alias("s")).select("layout", "pa", "pb", "err", "s.side", "s.p")
        rows = laid.withColumn("p", _top("path", d)).join(sides, ["layout", "p"]).select("layout", F.lit(d).alias("depth"), "pa", "pb", "err", "side", "path", "fp")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).filter(F.lit(False))
    dealt = out.repartition("layout", "depth", "pa", "pb").sortWithinPartitions("layout", "depth", "pa", "pb", "side", "path")
    return stored(dealt.mapInPandas(_task_links(budget, batch_rows), "u long, v long").distinct())


def _deeper(laid: DataFrame, large: DataFrame, depth: int, budget: int) -> DataFrame:
    """The node pairs eight levels below ``large`` that are within the budget, with their sizes."""
    nodes = large.select("layout", F.explode(F.array_distinct(F.array("pa", "pb"))).alias("p")).distinct()
    kids = (
        laid.withColumn("p", _top("path", depth))
        .join(nodes, ["layout", "p"], "left_semi")
        .groupBy("layout", "p", _top("path", depth + 8).alias("kid"))
        .agg(F.count("*").alias("n"))
    )
    kids = stored(kids)
    a = kids.select("layout", F.col("p").alias("pa"), F.col("kid").alias("ka"), F.col("n").alias("na"))
    b = kids.select("layout", F.col("p").alias("pb"), F.col("kid").alias("kb"), F.col("n").alias("nb"))
    kin = large.select("layout", "pa", "pb", "err").join(a, ["layout", "pa"]).join(b, ["layout", "pb"])
    err = (F.col("err") + F.bit_count(F.col("ka").bitwiseXOR(F.col("kb")).bitwiseAND(F.lit(255)))).cast("int")
    same = F.col("pa") == F.col("pb")
    return (
        kin.withColumn("err", err)
        .filter((F.col("err") <= budget) & (~same | (F.col("ka") <= F.col("kb"))))
        .select(
            "layout",
            F.lit(depth + 8).alias("depth"),
            F.col("ka").alias("pa"),
            F.col("kb").alias("pb"),
            "err",
            F.when(F.col("ka") == F.col("kb"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n"),
        )
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(fp, root): the smallest fingerprint connected with each fingerprint that has a link.

    Alternating large-star and small-star steps over a stored edge table until nothing changes.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        # large star: link every larger neighbour of a node to the least of its neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: link a node and its smaller neighbours to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small_ = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        now = stored(small_)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
            )
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``; component_id is the smallest id connected, itself included.

    Texts without words (null, empty) have fingerprint zero and link like any other. Rows without an id take part but
    are never the smallest; a component of such rows alone has a null id. Repeated rows are each returned.
    """
    prints = stored(fingerprints(docs, text_col, shingle).select(F.col("row").getField(id_col).alias("doc_id"), "fp"), TEXTS)
    per_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(per_print.select("fp"), budget))
    named = per_print.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stored(named)
    ids = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one row of each group left: that with the smallest id, of repeated ids any one; rows without id come last."""
    prints = stored(fingerprints(docs, text_col, shingle).withColumn("rid", F.monotonically_increasing_id()), TEXTS)
    thin = prints.select("fp", "rid", F.col("row").getField(id_col).alias("id"))
    order = F.struct(F.col("id").isNull().alias("no"), "id", "rid")
    best = stored(thin.groupBy("fp").agg(F.min(order).alias("best")))
    roots = components(links(best.select("fp"), budget))
    rooted = best.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.rid")
    return prints.join(kept, "rid", "left_semi").select("row.*")
