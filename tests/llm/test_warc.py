from __future__ import annotations

import base64
import hashlib

import pytest

from tallyspark.llm import warc

SCHEMA = "page_id long, url string, html string"
ODD = [
    (1, "http://a/ \r\nX: y", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"),
    (2, None, None),
    (3, "", ""),
    (4, "http://b", "same"),
    (9, "http://c", "same"),
    (7, "http://c", "same"),
    (12, "http://é", "é😀\n\n"),
    (13, "http://d", "x" * 400_000),
    (14, "http://d", "\r\n\r\n"),
]


def brute(rows, least=0):
    out, payload = [], {i: (h or "").encode() for i, _, h in rows}
    for i, p in payload.items():
        best = max(j for j, q in payload.items() if q == p)
        own = best == i or len(p) < least
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if own else "revisit", None if own else best))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 3, 5])
def test_archives_give_back_every_capture(spark, least):
    got = warc.report(spark.createDataFrame(ODD, SCHEMA), min_bytes=least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect())) == brute(ODD, least)


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "u", "p"), (5, "u", "p"), (5, "u", "p"), (None, "v", "q")]
    got = sorted(map(tuple, warc.report(spark.createDataFrame(rows, SCHEMA)).select("page_id", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([(5, "response", None), (5, "response", None), (None, "revisit", 5), (None, "response", None)], key=str)


def test_empty_table(spark):
    assert warc.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_generated_pages_with_copies(spark):
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    pages += [(10_000 + i, f"http://copy/{i}", pages[i % 3][2]) for i in range(40)]
    assert sorted(map(tuple, warc.report(spark.createDataFrame(pages, SCHEMA)).collect())) == brute(pages)


def test_transactions_are_nested_rows(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.write(spark.createDataFrame(ODD, SCHEMA), path)
    recs = warc.records(spark, path)
    assert recs.count() == 3 * len(ODD)
    for r in warc.transactions(recs).collect():
        assert r["request"]["head"].startswith("GET ") and "page-id: " in r["metadata"]["head"]
        assert r["response"]["target"] == r["request"]["target"] == r["metadata"]["target"]
        if r["response"]["type"] == "response":
            assert hashlib.sha1(r["response"]["payload"]).digest() == base64.b32decode(r["response"]["declared"])


def test_missing_parts_give_nulls(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.write(spark.createDataFrame(ODD[3:6], SCHEMA), path)
    recs = warc.records(spark, path)
    no_request = warc.transactions(recs.filter("type <> 'request'")).collect()
    assert len(no_request) == 3 and all(r["request"] is None and r["metadata"] for r in no_request)
    lost = warc.captures(warc.transactions(recs.filter("type <> 'response'"))).collect()
    assert {(r["record_type"], r["payload_bytes"], r["refers_to"]) for r in lost} == {("revisit", None, None)}


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.parse(b"nonsense\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 90\r\n\r\nshort"))


def test_payloads_reach_the_nested_rows_of_the_report(spark, monkeypatch):
    """The digest columns come from the payloads of the nested rows: change those and the columns follow."""
    real = warc.transactions
    from pyspark.sql import functions as F

    def shortened(recs):
        return real(recs).withColumn("response", F.col("response").withField("payload", F.substring("response.payload", 1, 2)))

    rows = [(i, "u", h) for i, h in enumerate(("abcd", "xyz", "q"))]
    monkeypatch.setattr(warc, "transactions", shortened)
    got = sorted(map(tuple, warc.report(spark.createDataFrame(rows, SCHEMA)).select("page_id", "payload_bytes").collect()))
    assert got == [(0, 2), (1, 2), (2, 1)]


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"{i} " * 20_000) for i in range(60)]
    path = tmp_path / "archive"
    warc.write(spark.createDataFrame(rows, SCHEMA), f"file://{path}", file_bytes=500_000)
    files = [p for p in path.iterdir() if p.name.startswith("part-")]
    total = sum(len(h) + 1500 for _, _, h in rows)
    assert len(files) > total / 500_000 / 2
    import gzip

    assert max(len(gzip.decompress(p.read_bytes())) for p in files) < 4 * 500_000
    assert warc.records(spark, f"file://{path}").count() == 180


def test_large_pages_are_read_as_a_stream(tmp_path):
    """Forty pages of four megabytes in one file: the parser holds a few records, not the file."""
    import gzip
    import tracemalloc

    import pandas as pd

    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"page text " * 400_000
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    batch = pd.DataFrame({"path": ["a.gz"], "content": [gzip.compress(record * 40, 1)]})
    names = [f.split()[0] for f in warc._FIELDS.split(", ")]
    tracemalloc.start()
    seen = 0
    for out in warc._records(batch, names, True):
        seen += len(out)
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 40 and peak < 60_000_000 < 40 * len(block)


def test_columns_of_clashing_names(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    more = df.withColumns({c: F.lit(f"extra {c}") for c in ("k1", "k2", "digest", "bytes", "of", "o1", "value", "record_id", "type", "no_url")})
    assert sorted(map(tuple, warc.report(more).collect())) == brute(ODD)
