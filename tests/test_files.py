"""File sources and sinks: CSV round trip, metadata scan, verified copy, streaming copy, run log."""

from __future__ import annotations

from tallyspark.sources import files, runlog
from tallyspark.streaming import copy as stream_copy

from .conftest import SF_SMALL

REGION_SCHEMA = "r_regionkey int, r_name string"


def test_csv_round_trip_and_metadata(spark, tmp_path):
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    out = str(tmp_path / "region_csv")
    files.write_delimited(region, out)
    back = files.read_delimited(spark, out, schema=REGION_SCHEMA)
    assert sorted(back.collect()) == sorted(region.collect())
    meta = files.file_metadata(spark, out, "*.csv").collect()
    assert meta and all(m.length > 0 for m in meta)
    assert set(files.file_metadata(spark, out).columns) == {"path", "length", "modificationTime"}


def test_copy_verified(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    files.write_delimited(orders, src)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    r = files.copy_verified(spark, src, dst, schema).first()
    assert r.matched and r.source_rows == orders.count() == r.dest_rows


def test_fingerprint_sees_a_lost_row(spark):
    df = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    a = files.table_fingerprint(df).first()
    b = files.table_fingerprint(df.filter("r_regionkey <> 2")).first()
    c = files.table_fingerprint(df.repartition(3)).first()
    assert a.checksum != b.checksum and a.checksum == c.checksum


def test_streaming_copy_is_incremental(spark, tmp_path):
    from pyspark.sql import functions as F

    # Padded names check that the stream copies text verbatim.
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet").withColumn("r_name", F.concat(F.lit(" "), "r_name", F.lit(" ")))
    src, dst, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    files.write_delimited(region.filter("r_regionkey < 3").coalesce(1), src, mode="append")
    first = stream_copy.copy_new_files(spark, src, dst, REGION_SCHEMA, ck)
    files.write_delimited(region.filter("r_regionkey >= 3").coalesce(1), src, mode="append")
    second = stream_copy.copy_new_files(spark, src, dst, REGION_SCHEMA, ck)
    third = stream_copy.copy_new_files(spark, src, dst, REGION_SCHEMA, ck)
    assert (first, second, third) == (3, 2, 0)
    assert stream_copy.verify_copy(spark, src, dst, REGION_SCHEMA).first().matched


def test_run_log(spark, tmp_path):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    log = str(tmp_path / "log")
    n = runlog.logged_write(nation, str(tmp_path / "t"), "load_nation", log)
    assert n == 25
    rows = runlog.read_log(spark, log).collect()
    assert [(r.step_name, r.records_processed, r.status) for r in rows] == [("load_nation", 25, "SUCCEEDED")]


def test_copy_keeps_padded_text(spark, tmp_path):
    df = spark.createDataFrame([(1, " west "), (2, "east  "), (3, None)], "id int, region string")
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    files.write_delimited(df, src)
    back = files.read_delimited(spark, src, schema="id int, region string", normalise_nulls=False)
    assert sorted(back.collect()) == sorted(df.collect())
    r = files.copy_verified(spark, src, dst, "id int, region string").first()
    assert r.matched and r.source_rows == 3


FOUR = 'id,age,note\r\n1,abc,"say ""hi"", ok"\r\n2,41,"two\nlines"\r\n3,,plain\r\n4,7,"a,b"\r\n'


def test_copy_of_untyped_quoted_and_multi_line_records_is_whole(spark, tmp_path):
    import pandas as pd

    src = tmp_path / "src"
    src.mkdir()
    (src / "f.csv").write_bytes(FOUR.encode())
    schema = "id INT, age INT, note STRING"
    r = files.copy_verified(spark, str(src), str(tmp_path / "dst"), schema).first()
    assert r.matched and r.source_rows == r.dest_rows == 4
    want = pd.read_csv(src / "f.csv", dtype=str, keep_default_na=False)
    got = pd.concat([pd.read_csv(f, dtype=str, keep_default_na=False) for f in (tmp_path / "dst").glob("*.csv")])
    assert sorted(map(tuple, got.to_numpy())) == sorted((a, b, c.replace("\r\n", "\n")) for a, b, c in want.to_numpy())
    stream_copy.copy_new_files(spark, str(src), str(tmp_path / "out"), schema, str(tmp_path / "ck"))
    assert stream_copy.verify_copy(spark, str(src), str(tmp_path / "out"), schema).first().matched


def test_records_that_do_not_fit_fail_the_copy(spark, tmp_path):
    import pytest

    src = tmp_path / "src"
    src.mkdir()
    (src / "f.csv").write_text("id,name\n1,a\n2,b,c,d\n")
    with pytest.raises(Exception, match="(?i)malformed|csv"):
        files.copy_verified(spark, str(src), str(tmp_path / "dst"), "id INT, name STRING").collect()


def test_damage_and_swapped_nulls_change_the_match(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    rows = [(None, "a", 1), ("b", None, 2), ("c", "d", 3)]
    files.write_delimited(spark.createDataFrame(rows, "x string, y string, n int"), src)
    for damaged in ([("a", None, 1), *rows[1:]], rows[:2], [*rows[:2], ("c", "e", 3)]):
        files.write_delimited(spark.createDataFrame(damaged, "x string, y string, n int"), dst)
        r = stream_copy.verify_copy(spark, src, dst, "x string, y string, n int").first()
        assert not r.matched
    a = files.table_fingerprint(spark.createDataFrame([(None, "a")], "x string, y string")).first()
    b = files.table_fingerprint(spark.createDataFrame([("a", None)], "x string, y string")).first()
    assert a.checksum != b.checksum


def test_stream_copy_counts_every_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    files.write_delimited(spark.range(230).repartition(115), src)
    n = stream_copy.copy_new_files(spark, src, str(tmp_path / "out"), "id BIGINT", str(tmp_path / "ck"), max_files_per_trigger=1)
    assert n == 230  # more batches than the 100 that a query remembers by default


def test_copy_of_transaction_file_matches(spark):
    import __spark_entry__ as E

    r = E.queries()["f_copy_verify"](spark, SF_SMALL).first()
    assert r.matched and r.source_rows == r.dest_rows > 0


def test_registered_stream_copy_matches(spark):
    import __spark_entry__ as E

    r = E.queries()["f_copy_stream"](spark, SF_SMALL).first()
    assert r.matched and r.source_rows == r.dest_rows > 0


def test_metadata_reads_the_transaction_file_too(spark):
    from tallyspark.plans.registry import QUERIES
    from tallyspark.sources import binding

    rows = QUERIES["f_metadata"](spark, SF_SMALL).collect()
    lines = binding.retail_file(spark, SF_SMALL).count()
    assert len(rows) == 14 and all(r.length > 0 for r in rows)
    assert {(r.file_set, r.every_part_listed, r.total_rows) for r in rows} == {("retail", True, lines)}
