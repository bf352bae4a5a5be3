"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups against collisions.

One pass over the texts writes a thin table of (id, hash, digest). Hashes that occur once are settled by it. The texts of
the others are read again and grouped by (hash, text), that is by their bytes; copies are combined before the shuffle,
so a group of any size sends one text a task. A hash with a single text is a true group: who stays is read from the thin
table. The rows of a hash with several texts (a collision) are grouped by the texts themselves instead.

Built from SQL functions alone. Defined cases: a null text is an empty one; rows with a null id come after all ids, and
keep a null ``keep_id`` when no row of their group has an id; of repeated rows (same id, same text) exactly one is kept;
an empty table gives an empty result; further columns are carried by :func:`keep_one` only and never looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small, stored

SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_KEYS = 500_000  # of 16 bytes each


def normalised(text: Column) -> Column:
    """The text with each run of white space as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_key(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of a stored table, each with a place that orders it among its group: ids first, then position in the table."""
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    return rows.select("*", at.alias("at"))


def _first(placed: DataFrame, by: list[str]) -> DataFrame:
    return placed.groupBy(*by).agg(F.count(F.lit(1)).alias("group_size"), F.min("at").alias("stays"))


def _decided(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("stays").isNull() | (F.col("at") == F.col("stays"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(["row"] if "row" in rows.columns else []),
    )


def mark(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: Callable[[Column], Column] = content_key,
    whole: bool = False,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, with ``whole`` also the row itself as ``row``.

    ``key`` gives the content hash of a normalised text; results don't depend on it.
    """
    carried = [F.struct("*").alias("row")] if whole else []
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("t"), *carried).withColumn("k", key(F.col("t")))
    digest = F.unhex(F.sha2("t", 256)).alias("digest")
    thin = _placed(stored(texts.select("doc_id", "k", digest, *(["row"] if whole else []))))
    groups = stored(_first(thin, ["k"]).filter("group_size > 1"))
    repeated = groups.select("k")
    again = texts.select("k", "t")
    if groups.count() <= broadcast_keys:
        # Beyond the bound all texts are grouped: a shuffled semi-join would bring a group's copies to one task.
        again = again.join(F.broadcast(repeated), "k", "left_semi")
    collided = stored(again.groupBy("k", "t").agg(F.lit(1).alias("one")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k"))
    if collided.isEmpty():
        return _decided(thin.join(small(groups), "k", "left"))
    true_groups = groups.join(collided, "k", "left_anti")
    single = thin.join(collided, "k", "left_anti").join(true_groups, "k", "left")
    mixed = _placed(stored(texts.join(collided, "k", "left_semi").select("doc_id", "k", "t", digest, *(["row"] if whole else []))))
    return _decided(single).unionByName(_decided(mixed.join(_first(mixed, ["k", "t"]), ["k", "t"])))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The decision on every row."""
    return mark(docs, id_col, text_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Callable[[Column], Column] = content_key) -> DataFrame:
    """The rows that stay, one of each group, with all their columns."""
    return mark(docs, id_col, text_col, key, whole=True).filter("kept").select("row.*")
