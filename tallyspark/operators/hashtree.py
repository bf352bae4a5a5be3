"""Where two tables differ: a tree of digests over ranges of their rows, compared level by level.

Every row falls into a leaf by the hash of its key, so both sides deal rows alike whatever their order, files or
partitions; the leaves are equal ranges of that hash. A leaf's digest is the number of its rows and two sums of row
hashes, an inner node's is the sum of its children's: digests merge, so one aggregation of the rows gives the leaves and
the levels above follow from them. The walk begins at the root and looks only below nodes that differ. Then the keys and
hashes of the rows in differing leaves alone are compared, never whole rows.

A NULL is a value of its own; repeated rows count as often as they stand there; an empty table has an empty tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.shared import written

FANOUT = 16
DEPTH = 4
TREE = "level int, node long, rows long, sum_a string, sum_b string"
BROADCAST_LEAVES = 100_000  # of eight bytes each


def _parts(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    # A null flag beside each value: (NULL, 'a') and ('a', NULL) differ.
    return [p for c in cols for p in (F.col(c).isNull(), F.col(c))]


def row_hashes(df: DataFrame, keys: Sequence[str], leaves: int = FANOUT**DEPTH) -> DataFrame:
    """(leaf, the keys, a, b): two hashes of each whole row, and the leaf its key falls into."""
    leaf = F.pmod(F.xxhash64(F.lit("leaf"), *_parts(df, keys)), F.lit(leaves))
    every = _parts(df, df.columns)
    return df.select(leaf.alias("leaf"), *keys, F.xxhash64(*every).alias("a"), F.xxhash64(F.lit("second"), *every).alias("b"))


def tree(df: DataFrame, keys: Sequence[str], fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """The digest tree of a table: (level, node, rows, sum_a, sum_b), level 0 the root, ``depth`` the leaves."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    leaves = row_hashes(df, keys, fanout**depth).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(wide("a")).alias("sum_a"), F.sum(wide("b")).alias("sum_b")
    )
    # Each leaf counts for itself and every node above it.
    above = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    nodes = leaves.select("*", above).withColumn("node", F.expr(f"leaf div cast(pow({fanout}, {depth} - level) as bigint)"))
    out = nodes.groupBy("level", "node").agg(F.sum("rows").alias("rows"), *[F.sum(c).cast("decimal(38,0)").cast("string").alias(c) for c in ("sum_a", "sum_b")])
    return out.select(F.col("level").cast("int").alias("level"), "node", "rows", "sum_a", "sum_b")


def differing_leaves(left: DataFrame, right: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(node, left_rows, right_rows): leaves whose digests differ, found from the root down.

    Both are trees as :func:`tree` gives them; kept ones should be partitioned by ``level``, so that a step reads one level.
    """
    nodes = None
    for level in range(depth + 1):
        a = left.filter(F.col("level") == level).select("node", F.col("rows").alias("left_rows"), F.col("sum_a").alias("la"), F.col("sum_b").alias("lb"))
        b = right.filter(F.col("level") == level).select("node", F.col("rows").alias("right_rows"), F.col("sum_a").alias("ra"), F.col("sum_b").alias("rb"))
        if nodes is not None:
            below = nodes.select(F.col("node").alias("parent"))
            a, b = (x.join(below, F.expr(f"node div {fanout}") == F.col("parent"), "left_semi") for x in (a, b))
        both = a.join(b, "node", "full")
        same = F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("la").eqNullSafe(F.col("ra")) & F.col("lb").eqNullSafe(F.col("rb"))
        nodes = both.filter(~same)
    zero = F.lit(0).cast("bigint")
    return nodes.select("node", F.coalesce("left_rows", zero).alias("left_rows"), F.coalesce("right_rows", zero).alias("right_rows"))


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(the keys, status) of rows in the given leaves that one side lacks: 'missing' or 'extra' on the right, or 'changed'.

    Only leaf, keys and hashes of those leaves' rows are shuffled.
    """
    few = F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves
    sides = []
    for name, df in (("left", left), ("right", right)):
        rows = row_hashes(df, keys, fanout**depth).join(few.select(F.col("node").alias("leaf")), "leaf", "left_semi")
        sign = 1 if name == "left" else -1
        sides.append(rows.select(*keys, "a", "b", F.lit(sign).alias("sign")))
    per_row = sides[0].unionByName(sides[1]).groupBy(*keys, "a", "b").agg(F.sum("sign").alias("over")).filter("over <> 0")
    per_key = per_row.groupBy(*keys).agg(F.sum(F.greatest("over", F.lit(0))).alias("lost"), F.sum(F.greatest(-F.col("over"), F.lit(0))).alias("added"))
    status = F.when(F.col("added") == 0, "missing").when(F.col("lost") == 0, "extra").otherwise("changed")
    return per_key.select(*keys, status.alias("status"))


def locate(left: DataFrame, right: DataFrame, keys: Sequence[str], fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """Keys whose rows differ between the two tables, through their trees, each built once and written."""
    trees = [written(tree(df, keys, fanout, depth), "tree") for df in (left, right)]
    leaves = written(differing_leaves(*trees, fanout, depth), "leaves")
    return differing_rows(left, right, keys, leaves, fanout, depth)
