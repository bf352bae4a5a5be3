"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring at ``VNODES`` places. A row belongs to the first virtual node at or after its own place.
Each shard has a bound; the bounds add up to the number of rows and differ by one at most, so counts end at most one
apart. Rows beyond a shard's bound continue clockwise to the next virtual node whose shard has room.

Only the number of rows per arc (``shards * VNODES`` arcs, whatever the data) goes to the driver, where the ring is
filled; the result is a list of rank ranges per arc. A row's rank within its arc then gives its shard and its slot.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import stored

SHARDS = 16
VNODES = 256
_BITS = 48


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) of the virtual nodes, clockwise; a shard's places don't depend on how many shards there are."""
    places = {}
    for s in range(shards):
        for v in range(vnodes):
            place = int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[: _BITS // 8], "big")
            places.setdefault(place, s)
    return sorted(places.items())


def bounds(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def fill(arcs: list[int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) so that every row of every arc has a shard with room.

    First each virtual node keeps its own rows while its shard has room (clockwise), then what is left of each arc
    continues clockwise.
    """
    used = [0] * len(room)
    out, left = [], []

    def take(arc: int, rank: int, n: int, shard: int) -> int:
        n = min(n, room[shard] - used[shard])
        if n > 0:
            out.append((arc, rank, rank + n, shard, used[shard]))
            used[shard] += n
        return max(n, 0)

    for arc, n in enumerate(arcs):
        kept = take(arc, 0, n, nodes[arc][1])
        if kept < n:
            left.append((arc, kept, n))
    for arc, rank, n in left:
        step = arc
        while rank < n:
            step = (step + 1) % len(nodes)
            rank += take(arc, rank, n - rank, nodes[step][1])
    return out


def place(*key: Column) -> Column:
    """Where a key stands on the ring."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("ring"), *key), 64 - _BITS)


def assign(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row: row counts of the shards differ by one at most.

    A row's place comes from its id, size and checksum, so copies under other ids, rows without id and hot sources
    spread over the ring. Null texts have size 1 and checksum 0. Repeated rows each get a slot; which of them gets which is
    arbitrary. An empty table gives no rows. Other columns are left out.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    nodes = ring(shards, vnodes)
    cells = 1 << 12
    arcs_by_cell = spark.createDataFrame(arc_cells(nodes, cells), "cell long, lo long, hi long, arc int")  # cells + nodes rows
    at = place(F.col("doc_id"), F.col("size"), F.col("text_crc32"))
    placed = stored(
        rows.withColumn("at", at)
        .withColumn("cell", F.shiftright("at", _BITS - 12))
        .join(F.broadcast(arcs_by_cell), "cell")
        .filter((F.col("lo") <= F.col("at")) & (F.col("at") <= F.col("hi")))
        .drop("cell", "lo", "hi")
    )
    count = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}  # one row per virtual node at most
    arcs = [count.get(i, 0) for i in range(len(nodes))]
    cuts = fill(arcs, nodes, bounds(sum(arcs), shards))
    table = spark.createDataFrame(cuts, "arc int, lo long, hi long, shard int, slot0 long")  # at most nodes + shards * shards rows
    per_arc = table.groupBy("arc").agg(F.collect_list(F.struct("lo", "hi", "shard", "slot0")).alias("cuts"))
    rank = F.row_number().over(Window.partitionBy("arc").orderBy("at", "doc_id", "size", "text_crc32")).cast("long") - 1
    ranked = placed.withColumn("rank", rank).join(F.broadcast(per_arc), "arc")
    cut = F.filter("cuts", lambda c: (c.lo <= F.col("rank")) & (F.col("rank") < c.hi))
    return ranked.withColumn("cut", F.get(cut, 0)).select(
        "doc_id", "size", "text_crc32", F.col("cut.shard").alias("shard"), (F.col("cut.slot0") + F.col("rank") - F.col("cut.lo")).alias("slot")
    )


def arc_cells(nodes: list[tuple[int, int]], cells: int) -> list[tuple[int, int, int, int]]:
    """(cell, lo, hi, arc): the arcs cut along ``cells`` equal parts of the ring, so that arcs can be looked up by equality."""
    width = (1 << _BITS) // cells
    out, i = [], 0
    for c in range(cells):
        lo, end = c * width, (c + 1) * width - 1
        while i < len(nodes) and nodes[i][0] <= end:
            out.append((c, lo, nodes[i][0], i))
            lo = nodes[i][0] + 1
            i += 1
        if lo <= end:
            out.append((c, lo, end, i % len(nodes)))
    return out


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every row under the law ``rows`` (counts at most one apart)."""
    return assign(docs, id_col, text_col, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
