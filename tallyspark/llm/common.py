"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BROADCAST_ROWS = 100_000  # a small row each; larger sides are joined by shuffle
BROADCAST_BYTES = 16 << 20  # of a text column, where its texts may be long


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: lineage is cut, nothing is kept in memory.

    ``batch_rows`` bounds the rows that a Python worker gets at once in this job. The tables live until
    :func:`drop_scratch`.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    try:
        spark.conf.set(_BATCH, str(batch_rows or before))
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results still to be computed from them are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, text: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted); otherwise as it is, for a shuffle join.

    The values of the column ``text``, where named, must also have at most ``BROADCAST_BYTES`` bytes together.
    Only the join strategy differs, never the result. Call it on stored tables or cheap plans: counting runs a job.
    """
    if text is None:
        return F.broadcast(df) if df.count() <= rows else df
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= rows and size["b"] <= BROADCAST_BYTES else df


def row_key(*cols: Column) -> tuple[Column, Column]:
    """128 hash bits of the given columns, nulls told from values: names a row in joins.

    Rows equal in all these columns share the key, so tables joined on it must be unique by it.
    """
    parts = [p for c in cols for p in (c.isNull(), c)]
    return F.xxhash64(F.lit("a"), *parts), F.xxhash64(F.lit("b"), F.lit(len(cols)), *parts)


BITS = 1 << 27  # 16 MB at most
_RANGE = 1 << 15  # bits of one bitmap of Spark's bitmap functions


def may_hold(rows: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """``rows`` with a boolean ``_may``: False where the row's ``key`` (a hash) surely isn't in ``keys``.

    A bitmap of the keys' lowest bits is broadcast, of ``bits`` bits however many keys there are, so rows that can't meet
    a partner needn't be shuffled to find that out. Those that may are for an exact join.
    """
    place = F.pmod(F.col(key), F.lit(bits))
    number, at = F.floor(place / F.lit(_RANGE)), F.pmod(place, F.lit(_RANGE))
    maps = keys.select(number.alias("_number"), at.alias("_bit")).groupBy("_number").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    met = rows.withColumn("_number", number).join(F.broadcast(maps), "_number", "left")
    byte = F.conv(F.hex(F.substring("_map", (F.floor(at / F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
    return met.withColumn("_may", F.coalesce(hit, F.lit(False))).drop("_number", "_map")
