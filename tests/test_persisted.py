"""Derived tables are built once per plan and source version; older versions go by a retention rule."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.sources import persisted

from .conftest import SF_SMALL


@pytest.fixture
def name(tmp_path):
    return f"probe-{os.getpid()}-{tmp_path.name}"


@pytest.fixture
def src(spark, tmp_path):
    path = str(tmp_path / "region_src")
    spark.read.parquet(f"{SF_SMALL}/region.parquet").coalesce(1).write.parquet(path)
    return path


def test_build_once_and_again_when_the_source_changes(spark, src, name):
    def build():
        return spark.read.parquet(src)

    first = persisted.location(spark, name, [src], build)
    assert persisted.location(spark, name, [src], build) == first
    assert spark.read.parquet(first).count() == 5
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.mode("overwrite").parquet(src)
    assert persisted.persisted(spark, name, [src], build).count() == 25
    assert persisted.location(spark, name, [src], build) != first


def test_two_builders_under_one_name_get_two_tables(spark, src, name):
    a = persisted.persisted(spark, name, [src], lambda: spark.read.parquet(src).filter("r_regionkey < 3"))
    b = persisted.persisted(spark, name, [src], lambda: spark.read.parquet(src).filter("r_regionkey < 4"))
    c = persisted.persisted(spark, name, [src], lambda: spark.read.parquet(src).filter("r_regionkey < 3").withColumn("x", F.lit(1)))
    assert (a.count(), b.count(), c.columns[-1]) == (3, 4, "x")


def test_a_file_rewritten_with_the_same_length_is_seen(spark, tmp_path, name):
    deep = tmp_path / "deep" / "p=1"
    deep.mkdir(parents=True)
    file = deep / "part-0.csv"
    file.write_text("1\n")
    os.utime(file, (1_000_000, 1_000_000))
    path = str(tmp_path / "deep")

    def build():
        return spark.read.schema("v int, p int").csv(path)

    assert persisted.persisted(spark, name, [path], build).first()["v"] == 1
    file.write_text("2\n")
    os.utime(file, (2_000_000, 2_000_000))
    assert persisted.persisted(spark, name, [path], build).first()["v"] == 2


def test_rebuild_leaves_readers_their_version_and_an_unfinished_build_is_not_read(spark, src, name):
    def build():
        return spark.read.parquet(src)

    old = persisted.location(spark, name, [src], build)
    reader = spark.read.parquet(old)
    new = persisted.location(spark, name, [src], build, rebuild=True)
    assert new > old and reader.count() == 5
    assert persisted.location(spark, name, [src], build) == new
    p, fs = persisted._hadoop_fs(spark, f"{new}/_SUCCESS")
    fs.delete(p, False)
    assert persisted.location(spark, name, [src], build) == old


def test_superseded_versions_go_after_their_time(spark, src, name):
    def build():
        return spark.read.parquet(src)

    old = persisted.location(spark, name, [src], build)
    new = persisted.location(spark, name, [src], build, rebuild=True)
    folder = new.rsplit("/", 1)[0]
    assert persisted.prune(spark, folder, keep=[new]) == []
    gone = persisted.prune(spark, folder, keep=[new], keep_seconds=-10)
    assert len(gone) == 1 and gone[0].endswith(old.rsplit("/", 1)[1])
    assert spark.read.parquet(new).count() == 5


def test_csv_table_round_trip(spark, tmp_path, name):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, " a "), (2, None), (3, 'say "hi", ok'), (4, "two\nlines")], "id int, t string").write.parquet(src)
    out = persisted.persisted(spark, name, [src], lambda: spark.read.parquet(src), csv_schema="id int, t string")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, spark.read.parquet(src).collect()))


def test_plans_that_differ_past_the_columns_that_are_printed(spark, src, name):
    """Forty columns: builders that differ in the 36th, as a column and inside one expression of forty arguments."""

    def wide(value):
        return lambda: spark.range(3).select(*[(F.lit(value) * F.col("id") if i == 36 else F.col("id") + i).alias(f"c{i}") for i in range(40)])

    def deep(value):
        return lambda: spark.range(3).select(F.array(*[F.col("id") * (value if i == 36 else i) for i in range(40)]).alias("a"))

    sums = [persisted.persisted(spark, name, [src], wide(v)).agg(F.sum("c36")).first()[0] for v in (2, 99)]
    assert sums == [6, 297]
    sums = [persisted.persisted(spark, f"{name}-deep", [src], deep(v)).agg(F.sum(F.col("a")[36])).first()[0] for v in (2, 99)]
    assert sums == [6, 297]
    assert persisted.location(spark, name, [src], wide(2)) == persisted.location(spark, name, [src], wide(2))


def test_a_remembered_builder_is_planned_once_per_version_of_its_sources(spark, src, name):
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src)

    for _ in range(3):
        assert persisted.persisted(spark, name, [src], build, remember="region").count() == 5
    assert len(calls) == 1
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.mode("overwrite").parquet(src)
    assert persisted.persisted(spark, name, [src], build, remember="region").count() == 25
    assert persisted.persisted(spark, name, [src], build, remember="region", rebuild=True).count() == 25
    assert len(calls) == 3


def test_many_source_files_are_digested_by_a_job(spark, tmp_path):
    from tallyspark.sources import shared

    deep = tmp_path / "a" / "p=1"
    deep.mkdir(parents=True)
    for i in range(5):
        (deep / f"f-{i}").write_text(str(i))
        os.utime(deep / f"f-{i}", (1_000_000, 1_000_000))
    for listed in (10, 2):
        kept = shared.source_digest(spark, [str(tmp_path / "a")], listed)
        assert shared.source_digest(spark, [str(tmp_path / "a")], listed) == kept
        os.utime(deep / "f-3", (2_000_000 + listed, 2_000_000))
        changed = shared.source_digest(spark, [str(tmp_path / "a")], listed)
        (deep / "f-9").write_text("x")
        assert len({kept, changed, shared.source_digest(spark, [str(tmp_path / "a")], listed)}) == 3
        (deep / "f-9").unlink()
        os.utime(deep / "f-3", (1_000_000, 1_000_000))


def test_csv_tables_say_whether_a_record_is_a_line(spark, tmp_path, name):
    from tallyspark.sources.files import ONE_LINE

    src = str(tmp_path / "src")
    for rows, one_line in ((["a", "b,c", 'd"'], True), (["a", "b\nc"], False), (["a", "b\rc"], False), (["a", " "], False), (["a", None], False)):
        spark.createDataFrame([(r,) for r in rows], "t string").write.mode("overwrite").parquet(src)
        path = persisted.location(spark, name, [src], lambda: spark.read.parquet(src), csv_schema="t string")
        assert os.path.exists(f"{path.removeprefix('file:')}/{ONE_LINE}") == one_line
