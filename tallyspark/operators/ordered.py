"""Global order without a single task.

A plain ``Window.orderBy(...)`` (no partition) or a window partitioned by a
key that holds a third of all rows sends those rows to one task. The
operators here keep every step distributed:

1. ``global_positions`` sorts by a *total* order (Spark range-partitions the
   sort, so equal-sized ranges even for a hot key, because the order keys are
   unique), cuts lineage with a reliable checkpoint, reads each row's
   partition number and index inside the partition from
   ``monotonically_increasing_id`` and adds the row counts of all earlier
   partitions. The offset table has one row per sort partition (a proven
   bound), so it is broadcast.
2. Dense rank = the running count of changes of the sort value.
3. Running totals (RANGE frame, ties share a value) = grand total minus what
   stands before a value's ties in the opposite order: prefix sums inside
   chunks of positions plus the totals of earlier chunks.
4. Row numbers within a group = position minus the group's first position;
   group starts are found where the previous row has another group, inside
   a chunk or carried from earlier chunks, so nothing is keyed by the group.
5. Row-frame windows within a group (e.g. a 3-row moving average) run inside
   chunks of positions, each chunk carrying the last rows of the previous
   chunk as a halo.

Chunk size comes from the row count: about two chunks per core, at most
``DEFAULT_CHUNK_ROWS`` rows per chunk and at most ``MAX_CHUNKS`` chunks. Every
window over rows is partitioned by a chunk id, hashed into the session's
shuffle partitions, so no task holds more than a chunk (+ halo) whatever the
key distribution. There is one plan for every input size.

The operators run jobs when they are called (the sort is checkpointed and its
partitions counted); the frames they return are lazy from there on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tallyspark.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition index in the low 33 bits
DEFAULT_CHUNK_ROWS = 1 << 20
MAX_CHUNKS = 1 << 20  # bound on the chunk-offset table

POS = "_pos"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _positioned(df: DataFrame, order: Sequence[str | Column], pos_col: str) -> tuple[DataFrame, int]:
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.orderBy(*_cols(order)).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select(
        "*",
        F.shiftright(mid, _LOCAL_BITS).alias("_pid"),
        mid.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_local"),
    )
    # One row per sort partition (the session's shuffle partitions); written
    # once so later references do not recount the checkpoint.
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    out = tagged.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(pos_col, F.col("_offset") + F.col("_local")).drop("_pid", "_local", "_offset")
    return out, int(total)


def global_positions(df: DataFrame, order: Sequence[str | Column], pos_col: str = POS) -> DataFrame:
    """Add consecutive 0-based positions following ``order``.

    ``order`` must be a total order (unique keys); otherwise positions of
    tied rows are arbitrary, exactly as for ``row_number``. The sorted rows
    are checkpointed with every column of ``df``, so callers project first.
    """
    return _positioned(df, order, pos_col)[0]


def chunk_size(spark, total_rows: int, cap: int = DEFAULT_CHUNK_ROWS, floor: int = 1024) -> int:
    """Rows per window chunk: about two chunks per core, at most ``cap`` rows,
    and never more than ``MAX_CHUNKS`` chunks.

    The cap bounds the rows one window task holds; the chunk-count bound keeps
    the chunk-offset table (broadcast, and windowed in one task) at most
    ``MAX_CHUNKS`` rows. Both hold up to ``cap * MAX_CHUNKS`` (about 10^12)
    rows; beyond that chunks grow past ``cap`` (window buffers spill to disk)
    rather than the offset table growing.
    """
    per_core = -(-total_rows // max(1, 2 * spark.sparkContext.defaultParallelism))
    at_least = -(-total_rows // MAX_CHUNKS)
    return int(max(at_least, min(cap, max(floor, per_core))))


def _chunk_of(pos: Column, chunk_rows: int) -> Column:
    return F.call_function("div", pos, F.lit(chunk_rows).cast("bigint"))


def _sort_key(value: str, descending: bool) -> Column:
    # SQL default null placement: NULLS FIRST ascending, NULLS LAST descending.
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()


def dense_rank(
    df: DataFrame,
    value: str,
    descending: bool = True,
    out: str = "dense_rank",
    tiebreak: Sequence[str] | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY value [DESC])`` over the whole table.

    Rows are positioned by (value, tiebreak) and the rank is the running count
    of value changes, counted inside chunks and carried across them, so nothing
    is keyed by the value. The tiebreak only has to split a hot value across
    sort partitions (tied rows share a rank whatever their order); by default
    it is a hash of the row.
    """
    positioned, total = _positioned(df, [_sort_key(value, descending), *_tiebreak(df, tiebreak)], POS)
    chunk_rows = chunk_rows or chunk_size(df.sparkSession, total)
    chunked = _with_halo(positioned, chunk_rows, 1)
    w = Window.partitionBy("_chunk").orderBy(POS)
    marked = chunked.withColumn("_new", _changed(F.col(value), w).cast("bigint")).filter(~F.col("_halo"))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumn("_local", F.sum("_new").over(upto))
    # Changes in all earlier chunks (one row per chunk, at most MAX_CHUNKS).
    per_chunk = marked.groupBy("_chunk").agg(F.sum("_new").alias("_n"))
    carry = per_chunk.select("_chunk", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_carry"))
    ranked = local.join(F.broadcast(carry), "_chunk")
    return ranked.withColumn(out, F.col("_carry") + F.col("_local")).drop(POS, "_chunk", "_halo", "_new", "_local", "_carry")


def _earlier():
    """All earlier rows of a table with one row per chunk."""
    return Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)


def _changed(value: Column, w) -> Column:
    """Whether a row's value differs from the previous row's (true for the first row)."""
    previous = F.lag(F.struct(value.alias("v")), 1).over(w)
    return previous.isNull() | ~previous["v"].eqNullSafe(value)


def _tiebreak(df: DataFrame, tiebreak: Sequence[str] | None) -> list[Column]:
    """Secondary sort keys that split a run of equal values: the given columns, else a row hash."""
    if tiebreak:
        return _cols(list(tiebreak))
    # Map columns cannot be hashed; any other column may serve to split a run.
    hashable = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return [F.xxhash64(*[F.col(c) for c in hashable])] if hashable else []


def running_total(
    df: DataFrame,
    value: str,
    measure: str | None = None,
    descending: bool = True,
    out: str = "running_total",
    chunk_rows: int | None = None,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """``SUM(measure) OVER (ORDER BY value [DESC])`` with the default RANGE frame.

    Rows tied on ``value`` share one running total that includes all of them;
    it is NULL only while every measure of the frame is NULL. Use a DECIMAL
    measure for a partition-independent exact result.

    Nothing is keyed by the value. Rows are positioned in the *opposite* order;
    the total in the requested order is the grand total minus the sum of all
    rows before the value's ties in the opposite order. That "before" sum is
    read at the ties' first row (found by comparing neighbours) and carried
    forward inside the chunk or from earlier chunks. Sums and counts of the
    non-NULL measures travel together. ``tiebreak`` (default: a row hash) only
    splits a hot value across sort partitions.
    """
    measure = measure or value
    positioned, total = _positioned(df, [_sort_key(value, not descending), *_tiebreak(df, tiebreak)], POS)
    chunk_rows = chunk_rows or chunk_size(df.sparkSession, total)
    chunked = _with_halo(positioned, chunk_rows, 1)
    w = Window.partitionBy("_chunk").orderBy(POS)
    zero = F.lit(0).cast(df.schema[measure].dataType)
    own = ~F.col("_halo")  # the copied row shows the previous value, it isn't summed again
    added = chunked.withColumns(
        {
            "_starts": _changed(F.col(value), w),
            "_m": F.when(own, F.coalesce(F.col(measure), zero)).otherwise(zero),
            "_c": (own & F.col(measure).isNotNull()).cast("bigint"),
        }
    )
    earlier_rows = w.rowsBetween(Window.unboundedPreceding, -1)
    before = added.withColumns(
        {
            "_sum": F.coalesce(F.sum("_m").over(earlier_rows), F.lit(0)),
            "_cnt": F.coalesce(F.sum("_c").over(earlier_rows), F.lit(0)),
        }
    )
    at_start = F.when(F.col("_starts") & own, F.struct(F.col("_sum").alias("s"), F.col("_cnt").alias("c")))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = before.withColumn("_at", at_start).withColumn("_last", F.last("_at", ignorenulls=True).over(upto)).filter(own)
    # One row per chunk (at most MAX_CHUNKS): its totals and the last start of ties in it.
    per_chunk = local.groupBy("_chunk").agg(
        F.sum("_m").alias("_ms"),
        F.sum("_c").alias("_cs"),
        F.max_by("_at", F.when(F.col("_at").isNotNull(), F.col(POS))).alias("_end"),
    )
    placed = per_chunk.select(
        "_chunk",
        "_end",
        F.coalesce(F.sum("_ms").over(_earlier()), F.lit(0)).alias("_so"),
        F.coalesce(F.sum("_cs").over(_earlier()), F.lit(0)).alias("_co"),
        F.sum("_ms").over(Window.partitionBy()).alias("_grand"),
        F.sum("_cs").over(Window.partitionBy()).alias("_grand_n"),
    )
    moved = F.when(
        F.col("_end").isNotNull(), F.struct((F.col("_so") + F.col("_end.s")).alias("s"), (F.col("_co") + F.col("_end.c")).alias("c"))
    )
    carry = placed.select("_chunk", "_so", "_co", "_grand", "_grand_n", F.last(moved, ignorenulls=True).over(_earlier()).alias("_carry"))
    joined = local.join(F.broadcast(carry), "_chunk")
    skipped = F.coalesce(F.col("_so") + F.col("_last.s"), F.col("_carry.s"))
    skipped_n = F.coalesce(F.col("_co") + F.col("_last.c"), F.col("_carry.c"))
    result = F.when(F.col("_grand_n") > skipped_n, F.col("_grand") - skipped)
    return joined.withColumn(out, result).select(*df.columns, out)


def row_number_within(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str | Column],
    out: str = "row_number",
    chunk_rows: int | None = None,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition ORDER BY order)``, skew-safe.

    No step is keyed by the group: rows are positioned in (group, order) order and cut into chunks; a row starts a group when
    the previous row (from the halo at a chunk edge) has another group; each
    row's group start is the last start at or before it, found inside its
    chunk or carried from the last start of earlier chunks (a table of one
    row per chunk). ``order`` should make rows unique within a group.
    """
    positioned, total = _positioned(df, [*_cols(list(partition)), *_cols(order)], POS)
    chunk_rows = chunk_rows or chunk_size(df.sparkSession, total)
    group = F.struct(*[F.col(k) for k in partition])
    chunked = _with_halo(positioned, chunk_rows, 1)
    w = Window.partitionBy("_chunk").orderBy(POS)
    starts = chunked.withColumn("_is_start", _changed(group, w)).filter(~F.col("_halo"))
    # Within a chunk: the latest start at or before the row (NULL if the group began earlier).
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = starts.withColumn("_start", F.max(F.when(F.col("_is_start"), F.col(POS))).over(upto))
    # Carry: the latest start in all earlier chunks (one row per chunk, at most MAX_CHUNKS).
    last = starts.groupBy("_chunk").agg(F.max(F.when(F.col("_is_start"), F.col(POS))).alias("_last"))
    carry = last.select("_chunk", F.max("_last").over(_earlier()).alias("_carry"))
    joined = local.join(F.broadcast(carry), "_chunk")
    start = F.coalesce(F.col("_start"), F.col("_carry"))
    return joined.withColumn(out, F.col(POS) - start + F.lit(1)).drop(POS, "_chunk", "_halo", "_is_start", "_start", "_carry")


def _with_halo(positioned: DataFrame, chunk_rows: int, halo: int) -> DataFrame:
    """Rows tagged with their chunk, plus copies of each chunk's last ``halo`` rows in the
    next chunk (``_halo`` true). Windows partitioned by the chunk hash it into the shuffle partitions."""
    chunk = _chunk_of(F.col(POS), chunk_rows)
    own = positioned.withColumn("_chunk", chunk).withColumn("_halo", F.lit(False))
    copies = (
        positioned.filter(F.col(POS) % F.lit(chunk_rows) >= F.lit(chunk_rows - halo))
        .withColumn("_chunk", chunk + F.lit(1))
        .withColumn("_halo", F.lit(True))
    )
    return own.unionByName(copies)


def rolling_rows(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    preceding: int,
    sum_out: str = "_roll_sum",
    count_out: str = "_roll_count",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Sum and count of ``value`` over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``
    inside each partition group, without a per-group task.

    Rows are positioned in (partition, order) order, cut into chunks of
    ``chunk_rows`` positions; the last ``preceding`` rows of each chunk are
    copied into the next chunk as a halo. Within a chunk the frame is an
    ordinary row frame per group.
    """
    positioned, total = _positioned(df, [*_cols(list(partition)), *_cols(order)], POS)
    chunk_rows = chunk_rows or max(preceding, chunk_size(df.sparkSession, total))
    if preceding < 0 or preceding > chunk_rows:
        raise ValueError("need 0 <= preceding <= chunk_rows")
    both = _with_halo(positioned, chunk_rows, preceding)
    frame = Window.partitionBy("_chunk", *partition).orderBy(POS).rowsBetween(-preceding, Window.currentRow)
    rolled = both.select("*", F.sum(value).over(frame).alias(sum_out), F.count(value).over(frame).alias(count_out))
    return rolled.filter(~F.col("_halo")).drop("_chunk", "_halo", POS)


def sequential_ids(df: DataFrame, order: Sequence[str | Column], out: str, start: int = 1) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` following a total ``order``."""
    return global_positions(df, order).withColumn(out, F.col(POS) + F.lit(start)).drop(POS)


def surrogate_keys(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Dense consecutive integer keys 1..n over the distinct ``keys``, ordered by them.

    Deterministic (a pure function of the key set), so reloading gives the
    same numbering.
    """
    keyed = sequential_ids(df.select(*keys).distinct(), [F.col(k).asc_nulls_first() for k in keys], out)
    return keyed.select(*keys, F.col(out).cast("bigint").alias(out))
