"""Incremental delimited-file copy with Structured Streaming.

A scheduled copy activity becomes a file-source stream run with
``trigger(availableNow=True)``: each run copies every file that arrived
since the last run and stops. The checkpoint (in the shared folder) records
which files were taken and the file sink's log records which output files
were committed, so a run that dies mid-way is redone exactly once, and
readers of the destination never see half-written output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.sources.files import CSV_OPTIONS, read_delimited, table_fingerprint, text_schema, with_match

# Progress records kept by a run: one per batch of files.
KEPT_BATCHES = 1_000_000


def copy_new_files(
    spark: SparkSession,
    source: str,
    destination: str,
    schema: StructType | str,
    checkpoint: str,
    sep: str = ",",
    max_files_per_trigger: int | None = None,
) -> int:
    """Copy files not yet copied, every column as text; returns the number of rows this run wrote."""
    reader = spark.readStream.schema(text_schema(schema)).options(**CSV_OPTIONS).option("sep", sep).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source)
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(setting)
    spark.conf.set(setting, KEPT_BATCHES)  # by default only 100 batches are remembered
    try:
        query = (
            stream.observe("copied", F.count(F.lit(1)).alias("rows"))
            .writeStream.format("csv")
            .options(**CSV_OPTIONS)
            .option("sep", sep)
            .option("path", destination)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        progress = query.recentProgress
    finally:
        spark.conf.set(setting, before)
    if len(progress) >= KEPT_BATCHES:
        raise RuntimeError(f"a run of {KEPT_BATCHES} or more batches can't be counted; raise max_files_per_trigger")
    return sum(int(p.observedMetrics["copied"]["rows"]) for p in progress if "copied" in p.observedMetrics)


def verify_copy(spark: SparkSession, source: str, destination: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Row counts and order-independent checksums of both sides, compared as text, and whether they agree."""
    names = text_schema(schema)
    src = table_fingerprint(read_delimited(spark, source, schema=names, sep=sep, normalise_nulls=False))
    dest = table_fingerprint(read_delimited(spark, destination, schema=names, sep=sep, normalise_nulls=False))
    both = src.select(
        F.col("rows").alias("source_rows"),
        F.col("checksum").alias("source_checksum"),
        dest.select("rows").scalar().alias("dest_rows"),
        dest.select("checksum").scalar().alias("dest_checksum"),
    )
    return with_match(both)
