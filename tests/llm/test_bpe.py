from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyspark.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH, P.PATTERN)


def test_perfect_hash_is_minimal_and_rejects_other_keys(vocabulary):
    table = vocabulary.table
    assert len(set(table.key)) == table.n == len(vocabulary.token)
    assert all(vocabulary.rank(t) == r for r, t in vocabulary.token.items())
    assert vocabulary.rank(b"no such token in there") is None and vocabulary.rank(b"") is None


def test_pieces_encode_as_the_library_does(vocabulary, known):
    rng = random.Random(2)
    parts = ["a", "aa", "é", "漢", " ", "\n", "1", "😀", "ab", "‍", "'s", "zz", "\x1c", "  ", "ing", "́"]
    memo = bpe._Memo(vocabulary)
    split = bpe.regex.compile(P.PATTERN).findall
    for _ in range(2000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert bpe._ids(memo, split(s)).tolist() == known.encode_ordinary(s)


def test_one_very_long_piece(vocabulary, known):
    s = "ab" * 50_000
    assert vocabulary.encode_piece(s.encode()) == known.encode_ordinary(s)


def test_memo_generations(vocabulary, known, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    memo = bpe._Memo(vocabulary)
    for i in list(range(20)) * 3:
        assert bpe._ids(memo, [f" wordy{i:03d}z"]).tolist() == list(known._core_bpe.encode_single_piece(f" wordy{i:03d}z".encode()))
    assert len(memo) <= 5


def test_report(odd, real, known):
    for docs in (odd, real):
        texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
        want = []
        for i, t in texts:
            ids = known.encode_ordinary(t)
            raw = b"".join(x.to_bytes(4, "little") for x in ids)
            want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
        got = bpe.report(docs, PATH, P.PATTERN)
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_round_trip_in_spark(odd, known):
    ids = odd.select("text", bpe.encode(odd, F.col("text"), PATH, P.PATTERN).alias("ids"))
    back = ids.select("text", "ids", bpe.decode(odd, F.col("ids"), PATH, P.PATTERN).alias("back")).collect()
    assert all(bytes(r["back"]).decode() == (r["text"] or "") and r["ids"] == known.encode_ordinary(r["text"] or "") for r in back)


def test_empty_table(no_docs):
    assert bpe.report(no_docs, PATH, P.PATTERN).collect() == []
