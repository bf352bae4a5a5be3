"""Kept partial states: reports from them equal the full scan, and a refresh reads only what changed."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import partials, reports
from tallyspark.sources import binding

from .conftest import SF_MID

REPORTS = ("region_summary", "null_counts", "value_ranges", "loss_orders")


@pytest.fixture(scope="module")
def sales(spark):
    rows = binding.sales_table(spark, SF_MID).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    # NULLs in grouped, summed and counted columns.
    return rows.withColumns({c: F.when(F.col("order_id") % m != 0, F.col(c)) for c, m in (("region", 41), ("sales", 37), ("profit", 31), ("discount", 29))})


def _same(state, rows):
    for name in REPORTS:
        got = [tuple(r) for r in getattr(partials, name)(state).collect()]
        assert got == [tuple(r) for r in getattr(reports, name)(rows).collect()], name


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / x) for x in ("rows", "state", "snapshots")]


def _refresh(spark, sales, folders):
    return partials.refresh(spark, folders[0], sales.schema, "order_month", folders[1], folders[2], partials.SALES, partials.with_losses)


def _put(rows, path):
    rows.repartitionByRange("order_month").write.mode("append").partitionBy("order_month").parquet(path)


def test_refresh_reads_the_changed_month_only(spark, sales, folders):
    month = "1996-03"
    late = (F.col("order_month") == month) & (F.col("line_number") > 2)
    assert sales.filter(late).count()
    _put(sales.filter(~late), folders[0])
    first = _refresh(spark, sales, folders)
    assert len(first.partitions) > 50
    _same(first.state, sales.filter(~late))
    before = {p: p.stat().st_mtime_ns for p in Path(folders[1]).rglob("part-*")}
    assert _refresh(spark, sales, folders).partitions == []
    _put(sales.filter(late), folders[0])
    # The other months' rows can't even be read now.
    for p in Path(folders[0]).rglob("part-*.parquet"):
        if month not in str(p):
            stat = p.stat()
            hidden = p.read_bytes()
            p.write_bytes(b"x" * len(hidden))
            os.utime(p, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    second = _refresh(spark, sales, folders)
    assert second.partitions == [month]
    _same(second.state, sales)
    after = {p: p.stat().st_mtime_ns for p in Path(folders[1]).rglob("part-*")}
    assert {p for p in before if month not in str(p)} == {p for p in after if month not in str(p)}
    assert all(after[p] == t for p, t in before.items() if p in after)


def test_a_month_that_goes_takes_its_states_along(spark, sales, folders):
    some = sales.filter(F.col("order_month") < "1995-06")
    _put(some, folders[0])
    _refresh(spark, sales, folders)
    for p in Path(folders[0], "order_month=1995-03").iterdir():
        p.unlink()
    done = _refresh(spark, sales, folders)
    assert done.partitions == ["1995-03"]
    _same(done.state, some.filter("order_month <> '1995-03'"))


def test_a_refresh_that_died_is_done_again(spark, sales, folders, monkeypatch):
    some = sales.filter(F.col("order_month") < "1995-04")
    _put(some, folders[0])
    monkeypatch.setattr(partials.manifest, "keep", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        _refresh(spark, sales, folders)
    monkeypatch.undo()
    done = _refresh(spark, sales, folders)
    assert len(done.partitions) == 3
    _same(done.state, some)


def test_merged_sketches_stay_within_their_bound(spark):
    """Ids that repeat across partitions are counted once; the error is that of one sketch, not of their number."""
    spec = partials.Spec(distinct=("a", "b", "c"))
    df = spark.range(300_000).select(
        F.concat(F.lit("p"), F.col("id") % 40).alias("part"),
        (F.col("id") % 100_003).alias("a"),
        F.when(F.col("id") % 3 == 0, (F.col("id") % 500).cast("string")).alias("b"),
        F.lit(None).cast("int").alias("c"),
    )
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in "abc"]).first()
    for rows in (df, df.withColumn("part", F.lit("all"))):
        got = {r["column_name"]: r["estimate"] for r in partials.distinct_estimates(partials.states(rows, "part", spec), spec).collect()}
        for c in "abc":
            assert abs(got[c] - exact[c]) <= 4 * partials.SKETCH_ERROR * exact[c]


def test_no_states_at_all(spark, sales):
    state = partials.states(partials.with_losses(sales.filter("false")), "order_month", partials.SALES)
    assert partials.region_summary(state).count() == 0
    assert partials.null_counts(state).first()["null_sales"] == 0
    assert {r["estimate"] for r in partials.distinct_estimates(state).collect()} == {0}
