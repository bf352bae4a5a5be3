from __future__ import annotations

import zlib
from collections import Counter

import pytest

from tallyspark.llm import sharding


def _check(docs, shards=16):
    n = docs.count()
    rows = sharding.assign(docs, shards=shards).collect()
    assert len(rows) == n
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.select("doc_id", "text").collect()}
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]))
    count = Counter(r["shard"] for r in rows)
    assert all(count.get(s, 0) == n // shards + (s < n % shards) for s in range(shards))
    for s in count:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(count[s]))
    return {r["doc_id"]: r["shard"] for r in rows}


def test_odd_rows(odd):
    _check(odd)
    _check(odd, 3)


def test_empty_table(no_docs):
    assert sharding.report(no_docs).collect() == []


def test_report_columns_and_law(real):
    got = sharding.report(real)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r["law"], r["grown_shard"]) for r in got.collect()} == {("rows", None)}


def test_result_does_not_depend_on_the_order_or_partitions_of_the_input(real):
    again = _check(real.repartition(7))
    assert _check(real.coalesce(1)) == again


@pytest.fixture(scope="module")
def many(spark):
    from pyspark.sql import functions as F

    return spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))


def test_equal_texts_spread_and_one_more_shard_moves_few(many):
    before, after = _check(many), _check(many, 17)
    moved = sum(before[i] != after[i] for i in before) / len(before)
    assert moved < 0.12  # a new ring of 17 needs 1/17 at least


def test_fill_sends_what_overflows_clockwise():
    nodes = [(10, 0), (20, 1), (30, 0), (40, 2)]
    cuts = sharding.fill([6, 0, 1, 0], nodes, [3, 2, 2])
    # arc 0: three rows stay, two go on to node 20, one passes the full shard 0 and reaches node 40; arc 2: shard 0 is full
    assert sorted(cuts) == [(0, 0, 3, 0, 0), (0, 3, 5, 1, 0), (0, 5, 6, 2, 0), (2, 0, 1, 2, 1)]


def test_cells_cover_the_ring_once():
    nodes = sharding.ring(5, 8)
    cells = sharding.arc_cells(nodes, 64)
    assert cells[0][1] == 0 and cells[-1][2] == (1 << 48) - 1
    assert all(b[1] == a[2] + 1 for a, b in zip(cells, cells[1:], strict=False))
    for _, lo, hi, arc in cells:
        want = next((i for i, (p, _) in enumerate(nodes) if p >= hi), 0)
        assert arc == want and next((i for i, (p, _) in enumerate(nodes) if p >= lo), 0) == arc
