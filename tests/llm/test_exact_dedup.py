from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import exact_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and the number kept per text."""
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str), len(groups)


def by_length(t):
    """A poor hash: texts of equal length collide."""
    return F.length(t) % 7


@pytest.mark.parametrize("key", [exact_dedup.content_key, by_length])
@pytest.mark.parametrize("broadcast_keys", [500_000, 0])
def test_equals_brute_force_whatever_the_hash(spark, odd, real, key, broadcast_keys):
    for df in (odd, real.unionByName(real.filter("doc_id % 3 = 0"))):
        rows = exact_dedup.mark(df, key=key, broadcast_keys=broadcast_keys).collect()
        want, texts = brute([tuple(r) for r in df.select("doc_id", "text").collect()])
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str) == want
        kept = [r for r in rows if r["kept"]]
        assert len(kept) == texts == len({r["text_sha256"] for r in kept})
        assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_white_space_runs_are_one_blank(spark):
    rows = [(3, "a  b"), (1, "a\t\nb"), (2, "a b"), (4, "a b"), (5, " a b"), (6, "ab"), (7, "a\x0b\x0c\rb"), (8, None), (9, ""), (10, " ")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        **{i: (1, 4, i == 1) for i in (1, 2, 3, 7)},
        **{i: (i, 1, True) for i in (4, 5, 6, 10)},
        **{i: (8, 2, i == 8) for i in (8, 9)},
    }


@pytest.mark.parametrize("key", [exact_dedup.content_key, by_length])
def test_rows_that_stay_carry_their_columns(spark, odd, no_docs, key):
    kept = exact_dedup.keep_one(odd, key=key)
    assert kept.columns == odd.columns
    texts = [SPACE.sub(" ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == brute([tuple(r) for r in odd.select("doc_id", "text").collect()])[1]
    assert exact_dedup.keep_one(no_docs).count() == 0 and exact_dedup.report(no_docs).count() == 0


def test_main_path_is_native(spark, real):
    plan = exact_dedup.report(real)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
