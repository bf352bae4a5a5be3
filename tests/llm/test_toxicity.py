from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import toxicity

RUDE = ["grobash", "plimkor", "vantruk"]


def _texts(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmnrst") * 2 + rng.choice("aeiou") for _ in range(rng.randrange(20, 200))]
        toxic = i % 5 == 0
        for _ in range(rng.randrange(2, 12) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE) + rng.choice(["", "a", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = _texts(600, 1)
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_judged_right(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert model.theta == sorted(model.theta) and len(model.theta) == toxicity.GRADES
    rows = docs.filter("doc_id % 2 = 1").join(labels, "doc_id").select("toxic", toxicity.severity(F.col("text"), model).alias("s")).collect()
    right = sum((r["s"]["severity"] >= toxicity.REJECT) == bool(r["toxic"]) for r in rows)
    assert right / len(rows) >= 0.98
    assert all(0 <= r["s"]["severity"] <= toxicity.GRADES and 0 <= r["s"]["grade"] <= toxicity.GRADES for r in rows)


def test_more_evidence_is_graded_higher(spark, corpus):
    model = toxicity.fit(*corpus)
    texts = spark.createDataFrame([(n, "bakka " * 30 + " ".join(RUDE * n)) for n in (0, 1, 3)], "n int, text string")
    got = [r["s"]["severity"] for r in texts.orderBy("n").select(toxicity.severity(F.col("text"), model).alias("s")).collect()]
    assert got == sorted(got) and got[0] < toxicity.REJECT < got[2]


def test_every_row_is_scored(odd, corpus):
    labels = corpus[1]
    got = toxicity.report(odd, labels)
    assert got.columns == ["doc_id", "expected_severity", "grade", "toxic"]
    assert got.count() == odd.count()


def test_odd_labels(spark, odd, no_docs, corpus):
    schema = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, 1)], [(None, 1, 1), (5, None, None), (6, 0, 0), (6, 0, 1), (6, 0, 0)]):
        got = toxicity.report(odd, spark.createDataFrame(rows, schema)).collect()
        assert len(got) == odd.count() and not any(r["toxic"] for r in got)
    assert toxicity.report(no_docs, corpus[1]).collect() == []


def test_keep_clean_keeps_columns_and_clean_rows(corpus):
    docs, labels = corpus
    extra = docs.withColumns({"s": F.lit(1), "row": F.lit("x"), "severity": F.lit(2.0)})
    kept = toxicity.keep_clean(extra, labels, docs)
    assert kept.columns == extra.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {i for i in range(600) if i % 5}) >= 475 and len(ids & {i for i in range(0, 600, 5)}) <= 3


def test_no_feature_is_left_out(spark):
    # 1,500 toxic words, each in thirty toxic documents and in no clean one
    words = ["zu" + "".join("bcdfghklmn"[int(c)] + "a" for c in f"{i:04d}") for i in range(1500)]
    rows = [(i, "plain text here " + " ".join(words[j] for j in range(i % 50, 1500, 50))) for i in range(1500)]
    rows += [(2000 + i, "plain text here and there") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") < 2000).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert set(words) <= set(model.weight)


def test_the_model_does_not_depend_on_the_order_of_entries(corpus):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    everyone = pd.DataFrame({"id": [str(i) for i in range(40)], "toxic": [int(i % 2 == 0) for i in range(40)]})
    held = pd.DataFrame([(str(i), f, int(rng.integers(1, 6))) for i in range(40) for f in "abcde" if rng.random() < (0.6 if i % 2 == 0 else 0.1)], columns=["id", "feature", "n"])
    one, two = toxicity._fit(everyone, held), toxicity._fit(everyone.sample(frac=1, random_state=1), held.sample(frac=1, random_state=2))
    assert one == two
    # The fitted weights are near the least loss, computed plainly from a dense matrix.
    x = np.zeros((40, 5))
    for i, f, n in held.itertuples(index=False):
        x[int(i), "abcde".index(f)] = n
    toxic = np.array([i % 2 == 0 for i in range(40)])
    cuts = np.quantile(x.sum(axis=1)[toxic], [1 / 3, 2 / 3])
    y = np.where(toxic, 1 + (x.sum(axis=1)[:, None] > cuts).sum(axis=1), 0)

    def loss(w, theta):
        z = np.log1p(x) @ w
        total = 0.0
        for k in range(3):
            p = 1 / (1 + np.exp(-(z - theta[k])))
            each = -np.where(y > k, np.log(p), np.log(1 - p))
            total += 0.5 * each[toxic].mean() + 0.5 * each[~toxic].mean()
        return total + 0.5 * 5e-4 * (w**2).sum()

    w, theta = np.array([one.weight.get(f, 0.0) for f in "abcde"]), np.array(one.theta)
    least = loss(w, theta)
    for k in range(5):
        for step in (-0.3, 0.3):
            assert loss(w + step * (np.arange(5) == k), theta) > least - 1e-3


def test_too_many_entries_are_an_error(corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "ENTRIES", 10)
    with pytest.raises(ValueError, match="lower per_class"):
        toxicity.fit(*corpus)
