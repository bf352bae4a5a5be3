"""Derived tables written once to the shared folder and reused.

The flat ``sales`` table is an ETL product: reports in the source read an
already-loaded flat table. Building it (a six-way join) inside every report
would repeat the same join per query, so it is written once as Parquet under
``spark.checkpoint.dir`` (the cluster's shared folder) and read back.

The folder name carries a fingerprint of the whole plan that builds the table
(every expression, however many columns), its schema, the write options and
every source file (path, length, time), so a changed builder or a changed
input gets a fresh table. Each build writes a
version folder of its own below it; a version counts once Spark's ``_SUCCESS``
marker is there and the newest counting version is the one that is read, so
nothing is renamed or replaced under a reader. Versions that have been
superseded for ``KEEP_SECONDS`` are deleted by later builds.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Hashable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallyspark.sources.files import CSV_OPTIONS, MAX_ROWS_PER_FILE, mark_one_line, read_delimited
from tallyspark.sources.shared import hadoop_fs, prune, source_digest, tables_root

__all__ = ["KEEP_SECONDS", "location", "persisted", "prune", "tables_root"]

_hadoop_fs = hadoop_fs
# What this process knows: key of a remembered builder -> (folder of its table, schema).
_KNOWN: dict[tuple, tuple[str, StructType]] = {}


def plan_text(df: DataFrame) -> str:
    """The whole analysed plan and schema of ``df``; ids that change from run to run are numbered as they come."""
    plan = df._jdf.queryExecution().analyzed()
    numbers: dict[str, str] = {}
    tree = re.sub(r"plan_id=\d+|@[0-9a-f]+|#\d+L?", "", plan.toString())
    whole = re.sub(r'"jvmId":"[^"]*"', "", plan.toJSON())  # printed plans leave out what stands past some 25 fields
    whole = re.sub(r'"id":(\d+)', lambda m: '"id":' + numbers.setdefault(m[1], str(len(numbers))), whole)
    return "\n".join([tree, whole, df.schema.json()])


def fingerprint(spark: SparkSession, df: DataFrame, sources: Sequence[str], *options: object) -> str:
    text = "\n".join([plan_text(df), source_digest(spark, sources), *map(repr, options)])
    return hashlib.sha256(text.encode()).hexdigest()[:20]


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Complete versions below ``folder``, oldest first (their names begin with the time of the build)."""
    p, fs = hadoop_fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if fs.exists(hadoop_fs(spark, f"{n}/_SUCCESS")[0]))


def persisted(
    spark: SparkSession,
    name: str,
    sources: Sequence[str],
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    rebuild: bool = False,
    sort_within: Sequence[str] = (),
    max_records_per_file: int | None = None,
    csv_schema: str | None = None,
    remember: Hashable = None,
    range_by: Sequence[str] = (),
) -> DataFrame:
    """Read ``name`` from the shared folder, writing it with ``build()`` first if needed (or always, with ``rebuild``).

    ``sort_within`` orders each file (tight Parquet min/max statistics for
    filters on those columns, no global sort); ``max_records_per_file`` keeps
    files near a gigabyte however large the shuffle partitions are. With
    ``csv_schema`` the table is a delimited text file with a header instead,
    written verbatim and read back with that declared schema, failing on any
    malformed record. ``range_by`` deals rows to tasks by ranges of these columns,
    so that folders of a ``partition_by`` column that follows them get few files
    each. ``remember`` names the builder with all that it depends
    on besides the sources: this process then builds its plan once per version
    of the sources, not per call.
    """
    folder, schema = _located(spark, name, sources, build, partition_by, rebuild, sort_within, max_records_per_file, csv_schema, remember, range_by)
    path = _versions(spark, folder)[-1]
    if csv_schema is None:
        return spark.read.schema(schema).parquet(path)
    return read_delimited(spark, path, csv_schema, normalise_nulls=False)


def location(
    spark: SparkSession,
    name: str,
    sources: Sequence[str],
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    rebuild: bool = False,
    sort_within: Sequence[str] = (),
    max_records_per_file: int | None = None,
    csv_schema: str | None = None,
    remember: Hashable = None,
    range_by: Sequence[str] = (),
) -> str:
    """The folder of the newest version of the table (see :func:`persisted`), built first if there is none."""
    folder, _ = _located(spark, name, sources, build, partition_by, rebuild, sort_within, max_records_per_file, csv_schema, remember, range_by)
    return _versions(spark, folder)[-1]


def _located(spark, name, sources, build, partition_by, rebuild, sort_within, max_records_per_file, csv_schema, remember, range_by) -> tuple[str, StructType]:
    """The folder that holds the table's versions, one at least, and the table's schema."""
    rows = max_records_per_file or (20_000_000 if csv_schema is None else MAX_ROWS_PER_FILE)
    options = (tuple(partition_by), tuple(sort_within), rows, csv_schema, tuple(range_by))
    sources_now = source_digest(spark, sources)
    known = (tables_root(spark), name, tuple(sources), options, remember, sources_now)
    if remember is not None and not rebuild and known in _KNOWN and _versions(spark, _KNOWN[known][0]):
        return _KNOWN[known]
    data = build()
    key = hashlib.sha256("\n".join([plan_text(data), sources_now, *map(repr, options)]).encode()).hexdigest()[:20]
    folder = f"{tables_root(spark)}/{name}/{key}"
    schema = data.schema
    if rebuild or not _versions(spark, folder):
        target = f"{folder}/{time.time_ns():020d}-{uuid.uuid4().hex}"
        if range_by:
            data = data.repartitionByRange(*range_by)
        if sort_within:
            data = data.sortWithinPartitions(*sort_within)
        if csv_schema is not None:
            seen = Observation("line_breaks")
            data = data.observe(seen, F.count_if(_breaks_lines(data)).alias("rows"))
        writer = data.write.option("maxRecordsPerFile", rows)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if csv_schema is None:
            writer.parquet(target)
        else:
            writer.options(**CSV_OPTIONS).csv(target)
            if not seen.get["rows"]:
                mark_one_line(spark, target)
        prune(spark, folder, keep=[target])
        prune(spark, f"{tables_root(spark)}/{name}", keep=[folder])
    # Columns that the table is partitioned by come back last.
    found = folder, StructType([f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by])
    if remember is not None:
        _KNOWN[known] = found
    return found


def _breaks_lines(df: DataFrame):
    """Whether a written row is not exactly one line with something in it."""
    texts = [F.coalesce(F.col(f.name), F.lit("")) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    out = F.lit(False)
    for t in texts:
        out = out | t.rlike("[\\n\\r]")
    if len(df.columns) == 1:
        only = F.coalesce(F.col(df.columns[0]).cast("string"), F.lit(""))
        out = out | only.rlike(r"\A[\x00-\x20]*\z")
    return out
