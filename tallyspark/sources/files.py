"""File sources and sinks: delimited scans, file metadata, CSV export, verified copy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyspark.functions.text import NULL_TOKENS, null_tokens_to_null
from tallyspark.sources import records
from tallyspark.sources.schema import layout
from tallyspark.sources.shared import file_rows, hadoop_fs, written

# Standard quoting: a quote inside a quoted value is doubled, a quoted value may span lines, text is kept verbatim.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
MAX_ROWS_PER_FILE = 5_000_000
ONE_LINE = "_ONE_LINE"  # marker in a folder whose files hold one record a line; kept by those who write the folder


def text_schema(schema: StructType | str) -> StructType:
    """The same column names, all strings: what a file holds before any cast."""
    return StructType([StructField(f.name, StringType()) for f in layout(schema).fields])


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    normalise_nulls: bool = True,
    mode: str = "FAILFAST",
    one_line: bool | None = None,
) -> DataFrame:
    """Delimited text scan with header and standard quoting.

    With ``schema`` the scan needs no inference pass (the production path);
    without it Spark infers types with one extra pass over the files
    (exploration only). A record that doesn't fit the schema fails the scan;
    pass ``mode="PERMISSIVE"`` to get NULLs instead. String columns get
    pandas-style missing-value tokens turned into NULL.

    Files are split however large they are. Whether a record is one line is told by
    ``one_line`` or a marker of the writer, else found by a scan; then Spark's
    scan splits them. Files with line breaks inside values are cut into records
    by ranges (:mod:`tallyspark.sources.records`). One task reads a whole file
    only without ``schema``, in encodings not like ASCII, with single carriage
    returns outside quotes, and with ``mode="DROPMALFORMED"``.
    """
    if one_line is None and schema is not None and records.splittable(encoding):
        if (lambda p, fs: fs.exists(p))(*hadoop_fs(spark, f"{path.rstrip('/')}/{ONE_LINE}")):
            one_line = True
        else:
            found = records.shape(spark, path, sep, encoding)
            one_line = found.lines_are_records
            if not one_line and not found.stray_returns and mode != "DROPMALFORMED":
                df = records.read_records(
                    spark, path, layout(schema), CSV_OPTIONS, lambda x: written(x, "records"), sep, header, encoding, mode
                )
                return normalised(df) if normalise_nulls else df
    reader = spark.read.options(**CSV_OPTIONS).option("header", header).option("sep", sep).option("encoding", encoding)
    reader = reader.option("mode", mode).option("multiLine", not one_line)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return normalised(df) if normalise_nulls else df


def mark_one_line(spark: SparkSession, path: str) -> None:
    """Say that every file in the folder holds one record a line."""
    p, fs = hadoop_fs(spark, f"{path.rstrip('/')}/{ONE_LINE}")
    fs.create(p, True).close()


def normalised(df: DataFrame) -> DataFrame:
    """String columns with missing-value tokens as NULL."""
    return df.select(
        *[
            null_tokens_to_null(F.col(f.name), NULL_TOKENS).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """CSV sink with a header and no index column (a folder of part files).

    Values are written verbatim (Spark's writer trims spaces unless told not
    to) and quotes are doubled, so any standard reader gets them back.
    """
    writer = df.write.mode(mode).options(**CSV_OPTIONS).option("sep", sep).option("encoding", encoding)
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).csv(path)


def file_metadata(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name, size and modification time of every file under ``path``.

    Only metadata columns are selected, so file contents are never read.
    """
    return file_rows(spark, [path], glob)


def _row_hash(df: DataFrame, cols: list[str]) -> Column:
    # A null flag beside each value: (NULL, 'a') and ('a', NULL) differ.
    parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c).cast("string"))]
    return F.xxhash64(*parts).cast("decimal(20,0)")


def table_fingerprint(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Row count and an order-independent checksum of the rows, in one pass.

    Each row hashes to 64 bits; the sum is taken as DECIMAL so it neither
    overflows nor depends on partitioning or row order.
    """
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*_fingerprint_columns(df.select(*cols)))


def _fingerprint_columns(df: DataFrame) -> list[Column]:
    checksum = F.coalesce(F.sum(_row_hash(df, df.columns)), F.lit(0).cast("decimal(30,0)")).cast("string")
    return [F.count(F.lit(1)).alias("rows"), checksum.alias("checksum")]


def copy_verified(
    spark: SparkSession,
    source: str,
    destination: str,
    schema: StructType | str,
    sep: str = ",",
) -> DataFrame:
    """Copy a delimited folder to ``destination`` and compare both sides.

    Every column is copied as text (``schema`` gives the names), so no value is
    cast; a record that doesn't have these columns fails the copy. The source
    fingerprint is observed while the copy is written (one read of the
    source); verification re-reads the written files, so a lost or doubled
    part file or a changed value shows up as a count or checksum mismatch.
    """
    names = text_schema(schema)
    src = read_delimited(spark, source, schema=names, sep=sep, normalise_nulls=False)
    seen = Observation("copy_source")
    write_delimited(src.observe(seen, *_fingerprint_columns(src)), destination, sep=sep)
    metrics = seen.get
    dst = read_delimited(spark, destination, schema=names, sep=sep, normalise_nulls=False)
    # Source metrics are two observed numbers; the destination side is one aggregate.
    dest = table_fingerprint(dst).select(F.col("rows").alias("dest_rows"), F.col("checksum").alias("dest_checksum"))
    both = dest.select(
        F.lit(int(metrics["rows"])).cast("bigint").alias("source_rows"),
        F.lit(str(metrics["checksum"])).alias("source_checksum"),
        "dest_rows",
        "dest_checksum",
    )
    return with_match(both)


def with_match(both: DataFrame) -> DataFrame:
    """Counts and checksums of both sides, and whether they agree."""
    same = (F.col("source_rows") == F.col("dest_rows")) & (F.col("source_checksum") == F.col("dest_checksum"))
    return both.select("source_rows", "dest_rows", "source_checksum", "dest_checksum", same.alias("matched"))
