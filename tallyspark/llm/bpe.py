"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a whole vocabulary entry is resolved by a minimal perfect hash: n keys, n slots, one comparison.
Any other pre-token is merged: its bytes form a doubly linked list, a heap holds the rank of each adjacent pair, and the
lowest rank (leftmost on ties) is merged until no pair is in the vocabulary.

The tables are built on the driver from the rank file (bounded by the vocabulary) and broadcast; a Python worker keeps
the ids of the pre-tokens it has met in a bounded memo.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMO = 300_000  # pre-tokens of up to MEMO_CHARS characters in each of the two generations that a Python worker remembers
MEMO_CHARS = 64


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: each bucket's displacement sends its keys to free slots."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        n = self.n = len(keys)
        self.buckets = max(1, n // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)
        self.key: list[bytes] = [b""] * n
        self.value = np.zeros(n, np.int64)  # the position of the slot's key in ``keys``
        taken = np.zeros(n, bool)
        held: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            held[h % self.buckets].append(i)
        free = None
        for b in sorted(range(self.buckets), key=lambda b: -len(held[b])):
            own = held[b]
            if not own:
                break
            if len(own) == 1:  # the rest are single keys: give each a free slot by its number
                if free is None:
                    free = iter(np.flatnonzero(~taken).tolist())
                slots = [next(free)]
                self.shift[b] = -slots[0] - 1
            else:
                d = 0
                while True:
                    slots = [self._slot(hashes[i], d) for i in own]
                    if len(set(slots)) == len(slots) and not taken[slots].any():
                        break
                    d += 1
                self.shift[b] = d
            for i, s in zip(own, slots, strict=True):
                taken[s] = True
                self.key[s] = keys[i]
                self.value[s] = i
        self.shift_list, self.value_list = self.shift.tolist(), self.value.tolist()

    def _slot(self, h: int, d: int) -> int:
        return ((h >> 20) + d * ((h >> 40) | 1)) % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh64_intdigest(key)
        d = self.shift_list[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.value_list[s] if self.key[s] == key else None


class Vocabulary:
    """Ids and bytes of a rank file; ids need not be gapless."""

    def __init__(self, lines: bytes, pattern: str):
        entries = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, lines.splitlines()) if t)
        self.pattern = pattern
        self.ids = [r for r, _ in entries]
        self.table = PerfectHash([t for _, t in entries])
        self.token = {r: t for r, t in entries}
        self.rank_of = {t: r for r, t in entries}  # for the pairs met while merging
        self.pair = [self.rank_of.get(bytes((a, b))) for a in range(256) for b in range(256)]  # and those of single bytes
        self.name = hashlib.sha256(lines + pattern.encode()).hexdigest()

    def rank(self, piece: bytes) -> int | None:
        at = self.table.get(piece)
        return None if at is None else self.ids[at]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank(piece)
        return [whole] if whole is not None else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        n, rank_of = len(piece), self.rank_of.get
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0 once it is merged into another
        before = list(range(-1, n - 1))
        pair = self.pair
        heap = [(r, i, i + 2) for i, (a, b) in enumerate(zip(piece, piece[1:], strict=False)) if (r := pair[a << 8 | b]) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j in (0, n) or end[j] != stop:
                continue  # a part of this pair has been merged since
            end[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := rank_of(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (b := before[i]) >= 0 and (r := rank_of(piece[b:stop])) is not None:
                heapq.heappush(heap, (r, b, stop))
        out, i = [], 0
        while i < n:
            out.append(rank_of(piece[i : end[i]]))
            i = end[i]
        return out


class _Memo(dict):
    """Ids of recent pre-tokens, as 32-bit bytes; when full, it becomes the old generation and a new one starts."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.vocabulary.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


_worker: dict[str, _Memo] = {}  # the memo of this Python worker, kept from task to task


def _memo(shared) -> _Memo:
    vocabulary = shared.value
    memo = _worker.get(vocabulary.name)
    if memo is None:
        _worker.clear()
        memo = _worker[vocabulary.name] = _Memo(vocabulary)
    return memo


def _ids(memo: _Memo, pieces: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(map(memo.__getitem__, pieces)), "<u4")


def load(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read(), pattern)


def _encoder(shared):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _memo(shared)
        split = regex.compile(memo.vocabulary.pattern).findall
        for batch in texts:
            yield pd.Series([_ids(memo, split(t or "")).astype(np.int32) for t in batch], dtype=object)

    return run


def _decoder(shared):
    def run(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = shared.value.token
        for batch in ids:
            yield pd.Series([None if x is None else b"".join([token[i] for i in x.tolist()]) for x in batch], dtype=object)

    return run


def _digests(shared):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = _memo(shared)
        split = regex.compile(memo.vocabulary.pattern).findall
        token = memo.vocabulary.token.__getitem__
        for batch in texts:
            rows = []
            for text in batch:
                ids = _ids(memo, split(text or ""))
                back = hashlib.sha256()
                for at in range(0, len(ids), 1 << 16):
                    back.update(b"".join(map(token, ids[at : at + (1 << 16)].tolist())))
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), back.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode(df: DataFrame, text: Column, path: str, pattern: str) -> Column:
    """Array of ids of each text (null: empty array), for ``df.withColumn``."""
    shared = df.sparkSession.sparkContext.broadcast(load(path, pattern))
    return F.pandas_udf(_encoder(shared), T.ArrayType(T.IntegerType()))(text)


def decode(df: DataFrame, ids: Column, path: str, pattern: str) -> Column:
    """Bytes of each array of ids (null: null)."""
    shared = df.sparkSession.sparkContext.broadcast(load(path, pattern))
    return F.pandas_udf(_decoder(shared), T.BinaryType())(ids)


def report(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: number of ids, digest of the ids (little-endian 32-bit), digest of the bytes decoded from them.

    Null and empty texts have no ids; every row of ``docs`` gives one row, repeated ones too; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path, pattern))
    kind = T.StructType(
        [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    )
    digests = F.pandas_udf(_digests(shared), kind)
    return docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col)).alias("d")).select("doc_id", "d.*")
