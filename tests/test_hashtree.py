"""Digest trees: one changed value among all lines is located, and nothing else."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import hashtree

from .conftest import SF_MID

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF_MID}/lineitem.parquet")


def test_one_changed_value_among_all_lines(spark, lines):
    victim = lines.orderBy(*KEYS).limit(1).first()
    at = F.lit(True)
    for k in KEYS:
        at = at & (F.col(k) == victim[k])
    copy = lines.withColumn("l_quantity", F.when(at, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).repartition(7)
    rows = hashtree.locate(lines, copy, KEYS).collect()
    assert [(*(r[k] for k in KEYS), r["status"]) for r in rows] == [(*(victim[k] for k in KEYS), "changed")]
    leaves = hashtree.differing_leaves(hashtree.tree(lines, KEYS), hashtree.tree(copy, KEYS))
    assert leaves.count() == 1 and leaves.first()["left_rows"] < lines.count() / 100


def test_missing_extra_and_repeated_rows(spark):
    rows = [(i, f"v{i % 5}" if i % 7 else None) for i in range(500)]
    left = spark.createDataFrame([*rows, rows[3], rows[3]], "k int, v string")
    right = spark.createDataFrame([r for r in rows if r[0] != 11] + [(900, "new"), (901, None), rows[3]], "k int, v string")
    got = {(r["k"], r["status"]) for r in hashtree.locate(left, right, ["k"], fanout=4, depth=3).collect()}
    assert got == {(11, "missing"), (900, "extra"), (901, "extra"), (3, "missing")}


def test_nulls_are_told_from_values_and_order_does_not_matter(spark):
    left = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    right = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert hashtree.locate(left, right, ["x"]).count() == 0
    moved = spark.createDataFrame([(None, None), ("a", "a")], "x string, y string")
    assert hashtree.locate(left, moved, ["x"]).count() == 2
    nothing = left.filter("false")
    assert hashtree.locate(nothing, nothing, ["x"]).count() == 0
    assert {r["status"] for r in hashtree.locate(left, nothing, ["x"]).collect()} == {"missing"}


def test_levels_add_up_and_kept_trees_can_be_compared(spark, lines, tmp_path):
    path = str(tmp_path / "tree")
    hashtree.tree(lines, KEYS).write.partitionBy("level").parquet(path)
    kept = spark.read.schema(hashtree.TREE).parquet(path)
    totals = {r["level"]: r["n"] for r in kept.groupBy("level").agg(F.sum("rows").alias("n")).collect()}
    assert set(totals.values()) == {lines.count()} and set(totals) == set(range(hashtree.DEPTH + 1))
    one_less = hashtree.tree(lines.exceptAll(lines.limit(1)), KEYS)
    assert hashtree.differing_leaves(kept, one_less).count() == 1
    assert hashtree.differing_leaves(kept, hashtree.tree(lines, KEYS)).count() == 0


def test_only_keys_and_hashes_are_shuffled(spark, lines):
    wide = lines.withColumn("pad", F.repeat(F.lit("x"), 100))
    leaves = spark.createDataFrame([(1,)], "node long")
    plan = hashtree.differing_rows(wide, wide, KEYS, leaves)._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("Scan parquet")]
    assert "pad" not in "".join(line for line in after.splitlines() if "Exchange" in line)
