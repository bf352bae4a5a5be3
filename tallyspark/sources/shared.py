"""The cluster's shared folder: paths, retention, intermediate tables, and what stands in a set of source files."""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

KEEP_SECONDS = 24 * 3600
LISTED_FILES = 64  # up to so many files the driver lists the sources itself; more are digested by a job


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def tables_root(spark: SparkSession) -> str:
    """The shared folder for derived tables.

    The configured ``spark.checkpoint.dir`` itself (not the per-application
    subfolder Spark creates inside it), so later applications find tables
    written by earlier ones.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = configured or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tallyspark-tables"


def prune(spark: SparkSession, folder: str, keep: Sequence[str] = (), keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Delete what has stood directly in ``folder`` for longer than ``keep_seconds``, but ``keep``; returns what went."""
    p, fs = hadoop_fs(spark, folder)
    gone = []
    if fs.exists(p):
        kept = {hadoop_fs(spark, k)[0].toUri().getPath() for k in keep}
        for s in fs.listStatus(p):
            old = s.getModificationTime() < (time.time() - keep_seconds) * 1000
            if old and s.getPath().toUri().getPath() not in kept:
                fs.delete(s.getPath(), True)
                gone.append(str(s.getPath()))
    return gone


def fresh(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh folder below ``kind`` in the shared folder; those of earlier runs go after a day."""
    root = f"{tables_root(spark)}/{kind}"
    prune(spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, its rows stay the same however often it's read."""
    path = fresh(df.sparkSession, "steps", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_rows(spark: SparkSession, paths: Sequence[str], glob: str = "*") -> DataFrame:
    """path, length and modificationTime of every file under ``paths``; contents are never read."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return scan.load(list(paths)).select("path", "length", "modificationTime")


def scanned_file() -> Column:
    """The path of the file that a scan's row comes from, as listings name it (the metadata column escapes it)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _listing(spark: SparkSession, path: str) -> list[str]:
    """Path, length and time of the files under ``path`` as texts."""
    p, fs = hadoop_fs(spark, path)
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        told = files.next().toString()
        out.append("|".join(re.search(f"{part}=(.*?);", told)[0] for part in ("path", "length", "modification_time")))
    return out


def source_digest(spark: SparkSession, paths: Sequence[str], listed_files: int = LISTED_FILES) -> str:
    """A digest of path, length and time of every file under ``paths``.

    A few files (their number costs one call a path) are listed by the driver; more are digested by a job, as a sum of
    row hashes, so the driver's calls don't grow with them.
    """
    counts = [(lambda p, fs: fs.getContentSummary(p).getFileCount())(*hadoop_fs(spark, path)) for path in paths]
    if sum(counts) <= listed_files:
        text = "\n".join(sorted(x for path in paths for x in _listing(spark, path)))
    else:
        row = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
        other = F.xxhash64(F.lit("b"), "path", "length", "modificationTime").cast("decimal(20,0)")
        text = repr(tuple(file_rows(spark, paths).agg(F.count(F.lit(1)), F.sum(row), F.sum(other)).first()))
    return hashlib.sha256(text.encode()).hexdigest()
