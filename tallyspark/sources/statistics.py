"""Ranges and counts from the footers of Parquet files: no row group is read.

Spark pushes ungrouped MIN, MAX and COUNT into its second Parquet scan when that is switched on. The settings belong to
a session of their own, beside the caller's, which keeps what it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",  # Parquet through the scan that takes aggregates
    "spark.sql.parquet.aggregatePushdown": "true",
}


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path``, for aggregates that file statistics can answer."""
    beside = spark.newSession()
    for name, value in {**_SETTINGS, "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone")}.items():
        beside.conf.set(name, value)
    return beside.read.parquet(path)
