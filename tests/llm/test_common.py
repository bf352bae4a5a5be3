from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.llm import common


def test_stored_cuts_lineage_keeps_the_setting_and_can_be_dropped(spark):
    before = spark.conf.get(common._BATCH)
    df = common.stored(spark.range(5).withColumn("t", F.lit("x")), batch_rows=2)
    assert spark.conf.get(common._BATCH) == before
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert common.stored(spark.createDataFrame([], "a int, b string")).columns == ["a", "b"]
    path = spark._jvm.org.apache.hadoop.fs.Path(common.scratch(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(path)
    common.drop_scratch(spark)
    assert not fs.exists(path)


def test_small_changes_only_the_join_strategy(spark):
    left, right = spark.range(2000), spark.range(0, 2000, 7).withColumn("x", F.lit(1))
    few, many = (left.join(common.small(right, rows), "id") for rows in (10_000, 10))
    assert "ResolvedHint" in few._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_small_counts_the_bytes_of_long_texts(spark, monkeypatch):
    words = spark.createDataFrame([("a" * 40,), ("ö" * 40,), (None,)], "word string")
    hinted = lambda: "ResolvedHint" in common.small(words, text="word")._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 120)
    assert hinted()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 119)
    assert not hinted()


def test_row_keys_tell_nulls_from_values(spark):
    rows = [(None, "a"), ("a", None), (None, None), ("", "a"), ("a", ""), ("a", "a"), ("a", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [tuple(r) for r in df.select(*common.row_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 6 and keys[5] == keys[6]
