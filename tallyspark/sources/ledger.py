"""Appending each batch exactly once.

A table kept by this module is a folder of batch folders, ``batch=<id>/attempt=<time>``, each written by one job. An
attempt counts through its claim alone, the file ``_claims/<id>`` made after the job has ended, whose content is the
attempt. A retried or doubled insert of a batch finds the claim and adds nothing; one that dies leaves files that no
reader opens. Readers scan the claimed folders together, so a scan is as wide as the table.

Two attempts that end at the same moment are told apart by the file system: a claim is a rename to a name that must not
exist yet, and each attempt reads back whose claim stands there. Batches are few (one per load), files are many.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.sources.schema import checked_rows, layout
from tallyspark.sources.shared import hadoop_fs

BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _claim_path(path: str, batch_id: str) -> str:
    return f"{path.rstrip('/')}/_claims/{batch_id}"


def claimed(spark: SparkSession, path: str, batch_id: str) -> str | None:
    """The attempt that counts for a batch, if there is one."""
    p, fs = hadoop_fs(spark, _claim_path(path, batch_id))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") or None
    finally:
        stream.close()


def _claim(spark: SparkSession, path: str, batch_id: str, attempt: str) -> bool:
    """Make ``attempt`` the one that counts; False if another attempt was first.

    The claim is written under a name of its own and then linked by a rename that doesn't replace what stands there.
    """
    p, fs = hadoop_fs(spark, _claim_path(path, batch_id))
    draft, _ = hadoop_fs(spark, f"{path.rstrip('/')}/_drafts/{batch_id}-{attempt}")
    out = fs.create(draft, False)
    out.write(bytearray(attempt.encode()))
    out.close()
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        return False
    try:
        return bool(fs.rename(draft, p)) and claimed(spark, path, batch_id) == attempt
    except Exception:  # noqa: BLE001 - some file systems raise where others return false
        return claimed(spark, path, batch_id) == attempt


def append_batch(
    df: DataFrame, path: str, schema: str | StructType, batch_id: str, defaults: Mapping[str, Column] | None = None
) -> bool:
    """Insert a batch by name; True if this call added it, False if it had been added before.

    Columns are matched, cast, defaulted and checked as by :func:`tallyspark.sources.schema.append_by_name`; a NULL in a
    NOT NULL column fails the insert and nothing of it counts.
    """
    if not BATCH_ID.fullmatch(batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    spark = df.sparkSession
    if claimed(spark, path, batch_id) is not None:
        return False
    attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    checked_rows(df, schema, defaults).write.parquet(f"{path.rstrip('/')}/batch={batch_id}/attempt={attempt}")
    return _claim(spark, path, batch_id, attempt)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, attempt): the batches that count."""
    p, fs = hadoop_fs(spark, f"{path.rstrip('/')}/_claims")
    kinds = "batch_id string, attempt string"
    if not fs.exists(p):
        return spark.createDataFrame([], kinds)
    # Folders that begin with an underscore aren't scanned unless they're named.
    scan = spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/_claims")
    return scan.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("batch_id"), F.col("value").alias("attempt"))


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of the batches that count, with ``batch_id``; attempts that don't count are never opened."""
    kinds = layout(schema)
    root = path.rstrip("/")
    counted = [f"{root}/batch={r['batch_id']}/attempt={r['attempt']}" for r in batches(spark, path).toLocalIterator()]
    whole = StructType.fromDDL(f"{kinds.toDDL()}, batch string, attempt string")
    if not counted:
        return spark.createDataFrame([], whole).drop("attempt").withColumnRenamed("batch", "batch_id")
    rows = spark.read.schema(whole).option("basePath", root).parquet(*counted)
    return rows.drop("attempt").withColumnRenamed("batch", "batch_id")


def drop_leftovers(spark: SparkSession, path: str, older_than_seconds: float = 24 * 3600) -> list[str]:
    """Delete attempts that don't count and have stood for so long; returns what went."""
    p, fs = hadoop_fs(spark, path)
    gone = []
    if not fs.exists(p):
        return gone
    for batch in fs.listStatus(p):
        name = batch.getPath().getName()
        if not name.startswith("batch="):
            continue
        counts = claimed(spark, path, name.removeprefix("batch="))
        for attempt in fs.listStatus(batch.getPath()):
            old = attempt.getModificationTime() < (time.time() - older_than_seconds) * 1000
            if old and attempt.getPath().getName() != f"attempt={counts}":
                fs.delete(attempt.getPath(), True)
                gone.append(str(attempt.getPath()))
    return gone
