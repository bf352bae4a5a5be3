"""Duplicate rows by 128-bit row keys: whole rows are shuffled only where keys repeat.

A row's key is two hashes of all its columns. Counting rows per key shuffles sixteen bytes a row; a row whose key stands
once is no duplicate. The others are compared column by column, so a collision of keys changes nothing. Repeated keys
are broadcast up to ``BROADCAST_KEYS``; beyond that most rows repeat and Spark's own distinct, which combines copies
before its shuffle, is the better plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.shared import written

BROADCAST_KEYS = 500_000  # of sixteen bytes each


def row_key(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of the columns; NULLs are told from values."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def _keyed(df: DataFrame, key: Callable) -> tuple[DataFrame, list[str]]:
    a, b = key(df.columns)
    names = ["_key_a", "_key_b"]
    return df.select("*", a.alias(names[0]), b.alias(names[1])), names


def _repeated(keyed: DataFrame, names: list[str], *more: Column) -> DataFrame:
    return written(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *more), "row-keys")


def distinct_rows(df: DataFrame, key: Callable = row_key, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One of each distinct row."""
    keyed, names = _keyed(df, key)
    repeated = written(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*names), "row-keys")
    if repeated.count() > broadcast_keys:
        return df.dropDuplicates()
    few = F.broadcast(repeated)
    once = keyed.join(few, names, "left_anti").select(*df.columns)
    again = keyed.join(few, names, "left_semi").select(*df.columns)
    return once.unionByName(again.dropDuplicates())


def row_counts(df: DataFrame, blank: Column, key: Callable = row_key, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(total_rows, duplicate_rows, blank_rows): all rows, rows beyond the first of their like, rows where ``blank`` holds."""
    keyed, names = _keyed(df.withColumn("_blank", blank.cast("int")), lambda _: key(df.columns))
    per_key = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.sum("_blank").alias("_b"))
    # Keys that stand once are summed up; the others are kept, as they name the rows to compare.
    some = F.when(F.col("_n") > 1, F.lit(True))
    kept = written(
        per_key.withColumn("_a", F.when(some, F.col(names[0]))).withColumn("_c", F.when(some, F.col(names[1]))).groupBy("_a", "_c").agg(
            F.sum("_n").alias("_n"), F.sum("_b").alias("_b"), F.count(F.lit(1)).alias("_keys")
        ),
        "row-keys",
    )
    repeated = kept.filter("_a IS NOT NULL").select(F.col("_a").alias(names[0]), F.col("_c").alias(names[1]))
    if repeated.count() <= broadcast_keys:
        like = keyed.join(F.broadcast(repeated), names, "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        distinct = F.coalesce(F.sum(F.when(F.col("_a").isNull(), F.col("_keys"))), F.lit(0)) + like.agg(F.count(F.lit(1))).scalar()
    else:
        distinct = F.lit(0) + df.dropDuplicates().agg(F.count(F.lit(1))).scalar()
    return kept.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        distinct.alias("_distinct"),
        F.coalesce(F.sum("_b"), F.lit(0)).cast("bigint").alias("blank_rows"),
    ).select("total_rows", (F.col("total_rows") - F.col("_distinct")).cast("bigint").alias("duplicate_rows"), "blank_rows")
