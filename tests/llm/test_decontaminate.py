from __future__ import annotations

import hashlib
import re

from tallyspark.llm import decontaminate

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (s or "").translate(LOW))


def brute(docs, items):
    wins = {}
    for i, s in items:
        w = _words(s)
        for k in range(max(1, len(w) - 9)):
            if w and i is not None:
                wins.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for d, s in docs:
        w, hit, held = _words(s), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if own := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    held |= own
        listed = ",".join(sorted(map(str, held)))
        out.append((d, len(w), len(hit), len(held), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _check(spark, docs, items):
    got = decontaminate.report(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], items)
    assert sorted(map(tuple, got.collect()), key=str) == want
    return want


def test_odd_rows_and_items_of_every_length(spark, odd):
    items = [
        (1, "fox jumps OVER the lazy dog and runs away from the big"),
        (2, "same text here"),
        (3, "text here"),
        (4, "Word"),
        (5, None),
        (6, "..."),
        (1, "fox jumps OVER the lazy dog and runs away from the big"),
        (None, "quick brown fox"),
        (9, "word word word word word word word word word word word word"),
        (10, "the big bad wolf"),
        (11, "not in any document at all, really not in one of them"),
    ]
    want = _check(spark, odd, items)
    assert sum(r[-1] for r in want) > 4


def test_a_hot_rare_token_shared_by_many_windows(spark):
    text = " ".join(f"w{i % 7}" for i in range(60))
    docs = spark.createDataFrame([(i, text + f" tail{i}") for i in range(30)], "doc_id long, text string")
    _check(spark, docs, [(i, " ".join(f"w{(i + j) % 7}" for j in range(12))) for i in range(8)])


def test_empty_tables(spark, odd, no_docs):
    _check(spark, no_docs, [(1, "a b c")])
    _check(spark, odd, [])


def test_generated_documents(spark, real):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    assert any(r[-1] for r in _check(spark, real, [(r["item_id"], r["text"]) for r in items]))


def test_no_python_in_the_plan(spark, real):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = decontaminate.report(real, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_rows_that_stay_keep_all_columns(spark, odd):
    kept = decontaminate.keep_clean(odd, spark.createDataFrame([(1, "same text here")], "item_id long, text string"))
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "7", "8"]
    assert decontaminate.keep_clean(odd, spark.createDataFrame([], "item_id long, text string")).count() == odd.count()


def test_more_than_a_hundred_thousand_item_shingles(spark, real, monkeypatch):
    """Results are the same whether the shingles are broadcast or a bitmap holds back the others."""
    texts = [r["text"] for r in real.select("text").collect() if len(_words(r["text"])) > 30]
    items = [(i, " ".join(f"word{i} of{j} item{i * 31 + j}" for j in range(8))) for i in range(5000)]
    items += [(10_000 + i, " ".join(_words(t)[i % 9 : i % 9 + 14])) for i, t in enumerate(texts[:20])]
    assert sum(max(0, len(_words(t)) - 2) for _, t in items) > 100_000
    want = _check(spark, real, items)
    assert sum(r[-1] for r in want) >= 20
    monkeypatch.setattr(decontaminate, "LISTED", 10)
    assert _check(spark, real, items) == want


def test_a_bitmap_lets_every_partner_through(spark):
    from tallyspark.llm.common import may_hold

    rows = spark.range(-3000, 3000).selectExpr("xxhash64(id) AS k", "id")
    keys = rows.filter("id % 37 = 0").select("k")
    for bits in (1 << 27, 1 << 15):
        told = may_hold(rows, keys, "k", bits)
        assert told.filter("id % 37 = 0 AND NOT _may").count() == 0
        assert told.filter("id % 37 <> 0 AND _may").count() < 60
    assert may_hold(rows, keys.filter("false"), "k").filter("_may").count() == 0
