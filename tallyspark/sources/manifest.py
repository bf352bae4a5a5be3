"""File manifests: what stands in a set of files, kept as snapshots, and what changed between two of them.

A manifest has one row per file: its path below the root, length, modification time and, if asked for, a digest of its
lines (their number and two sums of line hashes, taken by a text scan that splits large files). Snapshots are Parquet
folders named by the time they were taken; one counts once its ``_SUCCESS`` marker is there, so a snapshot that died
half-way is never compared with. Differences are joins on the path: nothing is listed or compared on the driver. Files
of no bytes, which Spark's scans skip, aren't in a manifest: a file that was emptied has vanished.

:func:`copy_changes` is the copy activity with its checks before and after: the source must exist, files that are
unchanged since the last copy are not read again, each source file owns a folder of the destination, and the sides are
compared line digest by line digest.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.sources.shared import file_rows, hadoop_fs, scanned_file, written

COLUMNS = "path string, length long, modification_time timestamp, lines long, digest string"
STATUSES = ("new", "changed", "vanished", "touched", "same")


def _root(spark: SparkSession, path: str) -> str:
    """The path as the file system names it, so that listed paths begin with it."""
    p, fs = hadoop_fs(spark, path)
    return str(fs.makeQualified(p)).rstrip("/")


def _name(path: Column, root: str) -> Column:
    """A file's path below the root; of a root that is a file, its name."""
    # Listings name local paths as file:/a, metadata columns as file:///a.
    plain = re.sub(r"^file:/+", "/", root)
    below = F.regexp_replace(F.regexp_replace(path, r"^file:/+", "/"), "^" + re.escape(plain) + "/?", "")
    return F.coalesce(F.nullif(below, F.lit("")), F.element_at(F.split(path, "/"), -1))


def take(spark: SparkSession, root: str, glob: str = "*", contents: bool = False) -> DataFrame:
    """The manifest of the files under ``root`` now; ``contents`` adds a digest of each file's lines.

    A path that doesn't exist raises an error, an empty folder gives no rows.
    """
    base = _root(spark, root)
    p, fs = hadoop_fs(spark, root)
    if not fs.exists(p):
        raise FileNotFoundError(root)
    files = file_rows(spark, [root], glob).select(
        _name(F.col("path"), base).alias("path"), "length", F.col("modificationTime").alias("modification_time")
    )
    none = F.lit(None)
    if not contents:
        return files.select("*", none.cast("bigint").alias("lines"), none.cast("string").alias("digest"))
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("lineSep", "\n").text(root)
    own = lines.select(_name(scanned_file(), base).alias("path"), "value").groupBy("path").agg(*_digest_of(F.col("value")))
    empty = _digest_text(F.lit(0), F.lit(0), F.lit(0))
    joined = files.join(own, "path", "left")
    return joined.select(
        "path", "length", "modification_time", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("digest", empty).alias("digest")
    )


def _digest_text(n: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(":", n.cast("string"), a.cast("string"), b.cast("string"))


def _digest_of(value: Column) -> list[Column]:
    """Number of values and a text of two sums of their hashes: neither order nor partitioning matters."""
    a = F.sum(F.xxhash64(value).cast("decimal(20,0)"))
    b = F.sum(F.xxhash64(F.lit("second"), value).cast("decimal(20,0)"))
    n = F.count(F.lit(1))
    return [n.alias("lines"), _digest_text(n, a, b).alias("digest")]


def keep(manifest: DataFrame, folder: str) -> str:
    """Write a manifest as a snapshot below ``folder``; returns the snapshot's folder."""
    target = f"{folder.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    manifest.write.parquet(target)
    return target


def snapshots(spark: SparkSession, folder: str) -> list[str]:
    """Complete snapshots below ``folder``, oldest first."""
    p, fs = hadoop_fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if fs.exists(hadoop_fs(spark, f"{n}/_SUCCESS")[0]))


def read(spark: SparkSession, snapshot: str | None) -> DataFrame:
    """A snapshot's rows; none at all without one."""
    return spark.createDataFrame([], COLUMNS) if snapshot is None else spark.read.schema(COLUMNS).parquet(snapshot)


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, status, old_length, new_length): every file of either manifest.

    With a digest on both sides a file is changed when its digest is, and touched when only its time is; otherwise it is
    changed when its length or time is.
    """
    names = ("length", "modification_time", "digest")
    o = old.select("path", *[F.col(c).alias(f"old_{c}") for c in names], F.lit(True).alias("was"))
    n = new.select("path", *[F.col(c).alias(f"new_{c}") for c in names], F.lit(True).alias("stands"))
    same_stat = (F.col("old_length") == F.col("new_length")) & (F.col("old_modification_time") == F.col("new_modification_time"))
    known = F.col("old_digest").isNotNull() & F.col("new_digest").isNotNull()
    equal = (F.col("old_digest") == F.col("new_digest")) & (F.col("old_length") == F.col("new_length"))
    status = (
        F.when(F.col("was").isNull(), "new")
        .when(F.col("stands").isNull(), "vanished")
        .when(known & ~equal, "changed")
        .when(same_stat, "same")
        .when(known, "touched")
        .otherwise("changed")
    )
    return o.join(n, "path", "full").select("path", status.alias("status"), "old_length", "new_length")


def copy_changes(
    spark: SparkSession,
    source: str,
    destination: str,
    snapshots_folder: str,
    glob: str = "*",
    contents: bool = False,
) -> DataFrame:
    """Copy what changed since the last copy, line by line, and compare the sides.

    Returns one row per source or copied file: (path, status, copied, source_lines, dest_lines, matched). Each file's
    lines stand in a folder ``source_file=<path>`` of the destination, which is replaced when the file is copied and
    emptied when it has vanished; others aren't touched. The new snapshot is kept only after the copy, so a copy that
    died is redone. A missing source raises an error before anything is written.
    """
    now = written(take(spark, source, glob, contents), "manifest")
    kept = snapshots(spark, snapshots_folder)
    changes = written(difference(read(spark, kept[-1] if kept else None), now), "changes")
    base = _root(spark, source)
    at = _name(scanned_file(), base)
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("lineSep", "\n").text(source)
    wanted = changes.filter(F.col("status").isin("new", "changed")).select("path")
    # The list of changed files joins the scan by broadcast only if it is small; rows of other files leave the plan early.
    few = F.broadcast(wanted) if wanted.count() <= 10_000 else wanted
    moved = lines.select("value", at.alias("path")).join(few, "path", "left_semi").withColumn("source_file", F.col("path"))
    _replace_folders(moved.select("value", "source_file"), destination)
    _clear(spark, destination, changes.filter("status = 'vanished'").select("path"))
    there = _destination_lines(spark, destination)
    mine = lines.select(at.alias("path"), "value").groupBy("path").agg(*_digest_of(F.col("value")))
    sides = mine.select("path", F.col("lines").alias("source_lines"), F.col("digest").alias("source_digest")).join(
        there.select("path", F.col("lines").alias("dest_lines"), F.col("digest").alias("dest_digest")), "path", "full"
    )
    out = changes.join(sides, "path", "full").select(
        "path",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.col("status").isin("new", "changed").alias("copied"),
        F.coalesce("source_lines", F.lit(0)).alias("source_lines"),
        F.coalesce("dest_lines", F.lit(0)).alias("dest_lines"),
        F.col("source_digest").eqNullSafe(F.col("dest_digest")).alias("matched"),
    )
    result = written(out, "copied")
    keep(now, snapshots_folder)
    return result


def _replace_folders(rows: DataFrame, destination: str) -> None:
    """Write text rows by ``source_file``, replacing only the folders that they belong to."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").partitionBy("source_file").text(destination)


def _clear(spark: SparkSession, destination: str, gone: DataFrame) -> None:
    """Delete the folders of vanished files, a bounded number at a time."""
    p, fs = hadoop_fs(spark, destination)
    if not fs.exists(p):
        return
    for row in gone.toLocalIterator():
        escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(row["path"])
        fs.delete(hadoop_fs(spark, f"{destination.rstrip('/')}/source_file={escaped}")[0], True)


def _destination_lines(spark: SparkSession, destination: str) -> DataFrame:
    """Lines and digest of each copied file."""
    p, fs = hadoop_fs(spark, destination)
    kinds = StructType.fromDDL("value string, source_file string")
    if not fs.exists(p):
        rows = spark.createDataFrame([], kinds)
    else:
        rows = spark.read.schema(kinds).option("lineSep", "\n").text(destination)
    return rows.groupBy(F.col("source_file").alias("path")).agg(*_digest_of(F.col("value")))


def changed_paths(changes: DataFrame, statuses: Sequence[str] = ("new", "changed")) -> DataFrame:
    """Paths of the files with one of these statuses."""
    return changes.filter(F.col("status").isin(*statuses)).select("path")
