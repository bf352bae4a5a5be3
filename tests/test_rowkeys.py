"""Duplicates by row keys and orphans by key bitmaps: same results as the plain forms, less shuffled."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import checks, keybits, reports, rowkeys
from tallyspark.sources import binding
from tallyspark.sources.statistics import read_footers

from .conftest import SF_MID, SF_SMALL


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def collide(_columns):
    """Keys of which all rows share two."""
    return F.pmod(F.xxhash64(F.col("x")), F.lit(2)), F.lit(1).cast("bigint")


ROWS = [(1, "a"), (1, "a"), (None, "a"), (None, "a"), ("1", None), (2, "b"), (3, None), (3, None), (3, None), (None, None), (4, "")]


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([(None if x is None else str(x), y) for x, y in ROWS], "x string, y string")


@pytest.mark.parametrize("key", [rowkeys.row_key, collide])
@pytest.mark.parametrize("broadcast_keys", [rowkeys.BROADCAST_KEYS, 0])
def test_distinct_rows_and_counts(spark, few, key, broadcast_keys):
    want = sorted(map(str, few.dropDuplicates().collect()))
    assert sorted(map(str, rowkeys.distinct_rows(few, key, broadcast_keys).collect())) == want
    blank = F.col("y").isNull()
    assert tuple(rowkeys.row_counts(few, blank, key, broadcast_keys).first()) == (len(ROWS), len(ROWS) - len(want), 5)
    none = few.filter("false")
    assert rowkeys.distinct_rows(none, key, broadcast_keys).count() == 0
    assert tuple(rowkeys.row_counts(none, blank, key, broadcast_keys).first()) == (0, 0, 0)


def test_rows_that_stand_once_are_not_shuffled(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = df.unionByName(df.filter("o_orderkey % 50 = 0"))
    out = rowkeys.distinct_rows(df)
    assert out.count() == df.dropDuplicates().count()
    # The only shuffle of whole rows stands above the semi-join with repeated keys.
    branches = _plan(out).split("LeftAnti")
    assert "Exchange hashpartitioning" not in branches[0].split("LeftSemi")[0] or "LeftSemi" in _plan(out)


@pytest.mark.parametrize("max_ranges", [keybits.MAX_RANGES, 0])
def test_orphans_equal_the_join_on_keys(spark, max_ranges):
    parent = spark.createDataFrame([(k,) for k in (1, 2, 32768, 32769, 65536, 0, -1, -32768, 10**12, None, 2)], "pk long")
    keys = [1, 2, 3, 32767, 32768, 32769, 32770, 65535, 65536, 65537, 0, -1, -2, -32767, -32768, -32769, 10**12, 10**12 + 1, None, 3]
    child = spark.createDataFrame([(k,) for k in keys], "ck long")
    want = checks.foreign_key(child, parent, "ck", "pk", "t").first()
    assert keybits.orphans(child, parent, "ck", "pk", "t", max_ranges).first() == want
    assert keybits.orphans(child, parent.filter("false"), "ck", "pk", "t", max_ranges).first()["violations"] == len(keys) - 1
    named = child.withColumn("ck", F.col("ck").cast("string"))
    assert keybits.orphans(named, parent.withColumn("pk", F.col("pk").cast("string")), "ck", "pk", "t").first() == want


def test_child_rows_are_not_shuffled_by_the_bitmap_check(spark):
    lines, orders = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("lineitem", "orders"))
    text = _plan(keybits.orphans(lines, orders, "l_orderkey", "o_orderkey", "lineitem"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    keyed = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    assert all("l_orderkey" not in k and "_key" not in k for k in keyed)


def test_date_range_reads_no_row_group(spark):
    table = read_footers(spark, binding.sales_location(spark, SF_SMALL))
    df = reports.date_range(table)
    assert re.search(r"PushedAggregation: \[MIN\(order_date\), MAX\(order_date\)\]", _plan(df))
    assert df.first() == reports.date_range(binding.sales_table(spark, SF_SMALL)).first()
    assert "PushedAggregation: [COUNT(*)]" in _plan(table.agg(F.count(F.lit(1))))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left alone


def test_year_filter_lists_one_folder(spark):
    text = _plan(reports.year_filter(binding.sales_table(spark, SF_SMALL, with_year=True), 1997))
    assert re.search(r"PartitionFilters: \[.*order_year.* = 1997", text)
    files = binding.sales_table(spark, SF_MID, with_year=True).filter("order_year = 1997").inputFiles()
    assert files  # folders hold few files each, as rows are dealt by ranges of the date
    per_year = [f for f in files if "order_year=1997" in f]
    assert 0 < len(per_year) <= 4
