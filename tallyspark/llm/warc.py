"""WARC archives: write captures as request, response or revisit, and metadata records; read them back as transactions.

Writing is a Spark text job whose line separator is the blank line that ends a WARC record, so files are committed like any
other Spark output; files are bounded by the bytes of their records. Reading inflates a file as a stream and follows
Content-Length, so payloads may hold anything, record headers included, and a task holds a compressed file and a few
records. Spark's text writer makes one gzip member of a file, not one of each record. Transactions are assembled by joining the three record types through WARC-Concurrent-To, one nested row each.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import may_hold, row_key, scratch, small, stored

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 64_000_000  # of the records of one file before compression, about
BATCH_BYTES = 8_000_000  # of records that a reading task hands on at once
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # RFC 4648
BASE32HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 bits become eight digits, four times."""
    h = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32HEX, BASE32)


def _record(kind: str, record_id: Column, block: Column, **fields: Column | None) -> Column:
    """Text of one record without the blank line at its end; fields that are null are left out."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Date: {DATE}{CRLF}WARC-Record-ID: <"), record_id, F.lit(f">{CRLF}")]
    for name, value in fields.items():
        lines.append(F.coalesce(F.concat(F.lit(f"{name.replace('_', '-')}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2), block)


def _urn(k1: Column, k2: Column, part: str) -> Column:
    """Record id made of the row key: the same capture always has the same id."""
    h = F.lower(F.concat(F.lpad(F.hex(k1), 16, "0"), F.lpad(F.hex(F.xxhash64(k1, k2, F.lit(part))), 16, "0")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES
) -> None:
    """Write every row of ``pages`` as a capture under ``path``.

    Of captures with equal payloads of ``min_bytes`` or more, that with the largest id is a response and the others are
    revisits of it; rows that repeat the same id, url and payload are the same capture and all of its type. Null html is
    an empty payload, a null url an empty target; control characters in urls are percent-encoded. Other columns are
    left out.
    """
    clean = F.coalesce(F.col(url_col), F.lit(""))
    for c in "\r\n\t ":
        clean = F.replace(clean, F.lit(c), F.lit(f"%{ord(c):02X}"))
    named = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).isNull().alias("no_url"), clean.alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    k1, k2 = row_key(F.col("page_id"), F.col("no_url"), F.col("url"), F.col("html"))
    rows = named.withColumns({"k1": k1, "k2": k2, "digest": base32_sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    thin = rows.select("k1", "k2", "page_id", "digest", "bytes")
    first = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "k1", "k2")).alias("of")
    owner = thin.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(first)
    # Small columns meet on the digest, which may be hot; the payloads then meet on the row key, which can't be.
    revisits = (
        thin.join(owner, "digest")
        .filter((F.col("of.k1") != F.col("k1")) | (F.col("of.k2") != F.col("k2")))
        .filter(F.col("bytes") >= min_bytes)
        .select("k1", "k2", F.col("of.k1").alias("o1"), F.col("of.k2").alias("o2"))
        .distinct()
    )
    # Rows that surely aren't revisits needn't be shuffled to find no partner.
    told = may_hold(rows, revisits, "k1")
    none = F.lit(None).cast("long")
    alone = told.filter("NOT _may").drop("_may").withColumns({"o1": none, "o2": none})
    both = alone.unionByName(told.filter("_may").drop("_may").join(revisits, ["k1", "k2"], "left"))
    # Records of a file follow from the mean bytes of a capture, which adds some 1,500 of its own.
    captures_all, total = thin.agg(F.count(F.lit(1)), F.sum(F.col("bytes") + 1500)).first()
    per_file = max(3, int(3 * file_bytes * captures_all / total)) if captures_all else 3
    own, of = _urn(F.col("k1"), F.col("k2"), "response"), _urn(F.col("o1"), F.col("o2"), "response")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2)
    )
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    target = F.col("url")
    response = _record(
        "response", own, F.concat(http, F.col("html")), WARC_Target_URI=target, WARC_Payload_Digest=digest, Content_Type=F.lit("application/http; msgtype=response")
    )
    revisit = _record(
        "revisit",
        own,
        http,
        WARC_Target_URI=target,
        WARC_Payload_Digest=digest,
        WARC_Refers_To=F.concat(F.lit("<"), of, F.lit(">")),
        WARC_Profile=F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        Content_Type=F.lit("application/http; msgtype=response"),
    )
    concurrent = F.concat(F.lit("<"), own, F.lit(">"))
    request = _record(
        "request",
        _urn(F.col("k1"), F.col("k2"), "request"),
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF * 2}")),
        WARC_Target_URI=target,
        WARC_Concurrent_To=concurrent,
        Content_Type=F.lit("application/http; msgtype=request"),
    )
    about = F.concat(
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
        F.when(F.col("no_url"), F.lit(f"no-url: 1{CRLF}")).otherwise(""),
    )
    metadata = _record(
        "metadata",
        _urn(F.col("k1"), F.col("k2"), "metadata"),
        about,
        WARC_Target_URI=target,
        WARC_Concurrent_To=concurrent,
        Content_Type=F.lit("application/warc-fields"),
    )
    records = F.array(request, F.when(F.col("o1").isNull(), response).otherwise(revisit), metadata)
    (
        both.select(F.explode(records).alias("value"))
        .write.option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


def parse(data: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of one uncompressed WARC file, read as a stream."""
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    while True:
        line = stream.readline()
        while line == b"\r\n":
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            if not line.endswith(b"\r\n"):
                raise ValueError("a WARC record ends early")
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a WARC record ends early")
        yield fields, block


_FIELDS = "type string, record_id string, concurrent_to string, refers_to string, target string, declared string, bytes long, digest string, head string, payload binary"


def _reader(payloads: bool):
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _records(batch, names, payloads)

    return run


def _records(batch: pd.DataFrame, names: list[str], payloads: bool) -> Iterator[pd.DataFrame]:
    for path, content in zip(batch["path"], batch["content"], strict=True):
        rows, size = [], 0
        raw = io.BytesIO(content)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if path.endswith(".gz") else raw
        for fields, block in parse(stream):
            kind, head, payload = fields.get("warc-type"), block, None
            if kind in ("response", "revisit"):
                head, _, payload = block.partition(b"\r\n\r\n")
            rows.append(
                (
                    kind,
                    fields.get("warc-record-id", "").strip("<>"),
                    fields.get("warc-concurrent-to", "").strip("<>") or None,
                    fields.get("warc-refers-to", "").strip("<>") or None,
                    fields.get("warc-target-uri"),
                    fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    len(payload) if kind == "response" else None,
                    base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else None,
                    head.decode("utf-8", "replace"),
                    payload if payloads and kind == "response" else None,
                )
            )
            size += len(block)
            if size > BATCH_BYTES:
                yield pd.DataFrame(rows, columns=names)
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=names)


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; without ``payloads`` only their sizes and digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(_reader(payloads), _FIELDS).withColumn("bytes", F.col("bytes").cast("long"))


def transactions(recs: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit record, and the request and metadata records concurrent to it.

    A capture without request or metadata has null there. Records that occur twice (the same id) count once.
    """
    part = {k: recs.filter(F.col("type") == k).dropDuplicates(["record_id"]) for k in ("request", "metadata")}
    main = recs.filter(F.col("type").isin("response", "revisit"))
    out = main.select("record_id", F.struct("type", "target", "refers_to", "declared", "bytes", "digest", "head", "payload").alias("response"))
    for name, p in part.items():
        side = p.filter("concurrent_to is not null").select(
            F.col("concurrent_to").alias("record_id"), F.struct("record_id", "target", "head").alias(name)
        )
        out = out.join(side, "record_id", "left")
    return out


def captures(trans: DataFrame) -> DataFrame:
    """Per transaction: the page id of its metadata, payload size and digest, type, and the page id that it refers to.

    Size and digest are those of the payload in the nested row, or of the record where payloads were left out when it was
    read. A revisit has those of the response it refers to (null if that record is missing).
    """
    page = F.regexp_extract(F.col("metadata.head"), r"(?:^|\r\n)page-id: (-?\d+)", 1)
    flat = stored(
        trans.select(
            "record_id",
            F.when(page != "", page.cast("long")).alias("page_id"),
            F.col("response.type").alias("record_type"),
            F.col("response.refers_to").alias("of"),
            F.coalesce(F.octet_length("response.payload").cast("long"), "response.bytes").alias("payload_bytes"),
            F.coalesce(base32_sha1(F.col("response.payload")), "response.digest").alias("payload_digest"),
        )
    )
    own, revisits = flat.filter("record_type = 'response'"), flat.filter("record_type = 'revisit'")
    # Only revisits need a partner; a hot one is one row on its side, and the side is broadcast or the join split.
    source = stored(
        own.join(revisits.select(F.col("of").alias("record_id")).distinct(), "record_id", "left_semi")
        .dropDuplicates(["record_id"])
        .select(F.col("record_id").alias("of"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    )
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    referring = revisits.drop("payload_bytes", "payload_digest").join(small(source), "of", "left").select(*cols)
    return own.withColumn("refers_to", F.lit(None).cast("long")).select(*cols).unionByName(referring)


def report(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and return one row per capture."""
    spark = pages.sparkSession
    path = f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, id_col, url_col, html_col, min_bytes)
    return captures(transactions(records(spark, path)))
