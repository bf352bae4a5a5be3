"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

P(grade > k) = sigmoid(w . x - theta_k) with one weight vector for all ordered thresholds theta_1 < theta_2 < ...; the
expected severity is the sum over k. Features are words and word beginnings that labelled toxic documents hold more
often than clean ones, every one that passes the tests below; x is log(1 + count). Feature counts and the fit use a bounded sample of labelled documents
(``per_class`` of either class, chosen by a hash of the id); scoring covers whole texts of every row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import small, stored

PER_CLASS = 5000  # labelled documents of either class in the fit, at most
ENTRIES = 2_000_000  # (document, feature) pairs of the fit that the driver takes; more is an error, none is left out
STEMS = (4, 5, 6)  # lengths of the word beginnings
LIFT = 15.0  # a feature is this many times as frequent in toxic documents, at least
CHI2 = 24.0  # and its association with the label is far beyond chance among all features tried
MIN_DOCS = 4  # toxic documents that hold a feature, at least
GRADES = 3  # toxic grades; 0 is clean
REJECT = 0.4  # expected severity from which a document is toxic

_word = re.compile(r"[^\W\d_]+")


def counts(text: str | None) -> Counter:
    """Occurrences of each word of the whole text, in lower case."""
    return Counter(_word.findall((text or "").lower()))


def names(word: str) -> list[str]:
    """The features of a word: itself and its beginnings (marked by a star)."""
    return [word, *[f"{word[:n]}*" for n in STEMS if len(word) > n]]


@dataclass
class Model:
    theta: list[float]  # ordered thresholds, none if nothing could be learnt
    weight: dict[str, float] = field(default_factory=dict)


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc, toxic, text in zip(b["id"], b["toxic"], b["text"], strict=True):
            total: Counter = Counter()
            for w, n in counts(text).items():
                for f in names(w):
                    total[f] += n
            rows += [(doc, toxic, f, n) for f, n in total.items()]
        yield pd.DataFrame(rows, columns=["id", "toxic", "feature", "n"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Model from the labelled documents; without both classes it has no features and calls nothing toxic.

    Labels are 0 and 1 (the table grades no finer): toxic rows are graded 1..GRADES by how many occurrences of toxic
    features they hold, cut at the quantiles of the sample. Ids with several labels count as toxic if one says so; null
    ids and labels are left out. Of rows that share an id, the largest count of a feature holds. A sample with more than
    ``ENTRIES`` pairs of a document and a chosen feature raises ValueError: fit it with a smaller ``per_class``.
    """
    marked = (
        labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .filter("id is not null and toxic is not null")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("id"), "id"]
    sample = marked.filter("toxic > 0").orderBy(*order).limit(per_class).unionByName(marked.filter("toxic <= 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    rows = stored(
        texts.join(F.broadcast(sample), "id")  # at most 2 * per_class ids
        .mapInPandas(_feature_rows, "id string, toxic int, feature string, n long")
        .groupBy("id", "toxic", "feature")
        .agg(F.max("n").alias("n"))
    )
    size = rows.select("id", "toxic").distinct().groupBy("toxic").count().collect()
    bad = sum(r["count"] for r in size if r["toxic"] > 0)
    good = sum(r["count"] for r in size if r["toxic"] <= 0)
    if not bad or not good:
        return Model([])
    a, b = F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.sum(F.when(F.col("toxic") > 0, 0).otherwise(1))
    n = float(bad + good)
    chi2 = n * F.pow(F.col("a") * good - F.col("b") * bad, 2) / (
        F.lit(float(bad) * good) * (F.col("a") + F.col("b")) * (F.lit(n) - F.col("a") - F.col("b") + 0.5)
    )
    chosen = (
        rows.groupBy("feature")
        .agg(a.cast("double").alias("a"), b.cast("double").alias("b"))
        .filter((F.col("a") >= MIN_DOCS) & (F.col("a") / bad >= LIFT * (F.col("b") + 0.5) / good))
        .withColumn("chi2", chi2)
        .filter(F.col("chi2") >= CHI2)
        .select("feature")
    )
    entries = stored(rows.join(small(stored(chosen), text="feature"), "feature").select("id", "feature", "n"))
    if (held := entries.count()) > ENTRIES:
        raise ValueError(f"{held} pairs of a document and a feature in the fit; the driver takes {ENTRIES}: lower per_class")
    everyone = rows.select("id", "toxic").distinct().toPandas()
    return _fit(everyone, entries.toPandas())


def _fit(everyone: pd.DataFrame, held: pd.DataFrame, steps: int = 400, rate: float = 0.1, l2: float = 5e-4) -> Model:
    everyone = everyone.sort_values("id").reset_index(drop=True)
    held = held.sort_values(["feature", "id"])  # sums in one order, so that the model doesn't depend on partitions
    vocab, c = np.unique(held["feature"].to_numpy(str), return_inverse=True)
    if not len(vocab):
        return Model([])
    r = np.searchsorted(everyone["id"].to_numpy(str), held["id"].to_numpy(str))
    count = held["n"].to_numpy(float)
    by_doc = lambda values: np.bincount(r, values, minlength=len(everyone))
    toxic = everyone["toxic"].to_numpy() > 0
    amount = by_doc(count)
    cuts = np.quantile(amount[toxic], np.arange(1, GRADES) / GRADES)
    y = np.where(toxic, 1 + (amount[:, None] > cuts[None, :]).sum(axis=1), 0)
    x = np.log1p(count)  # of the entries (r, c)
    above = (y[:, None] > np.arange(GRADES)[None, :]).astype(float)  # column k: grade > k
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())[:, None]  # classes weigh alike
    w = np.zeros(len(vocab))
    theta0, gap = 1.0, np.zeros(GRADES - 1)  # theta_k = theta0 + sum of exp(gap): ordered by construction
    m, v = np.zeros(len(w) + GRADES), np.zeros(len(w) + GRADES)
    for t in range(1, steps + 1):
        theta = theta0 + np.concatenate([[0.0], np.cumsum(np.exp(gap))])
        p = 1 / (1 + np.exp(-np.clip(by_doc(x * w[c]), -30, 30)[:, None] + theta[None, :]))
        d = (p - above) * share
        by_theta = -d.sum(axis=0)
        g = np.concatenate([np.bincount(c, x * d.sum(axis=1)[r], minlength=len(w)) + l2 * w, [by_theta.sum()], [by_theta[k + 1 :].sum() * np.exp(gap[k]) for k in range(GRADES - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, theta0, gap = w - step[: len(w)], theta0 - step[len(w)], gap - step[len(w) + 1 :]
    theta = theta0 + np.concatenate([[0.0], np.cumsum(np.exp(gap))])
    return Model([round(float(z), 6) for z in theta], {str(f): round(float(z), 6) for f, z in zip(vocab, w, strict=True) if abs(z) > 1e-4})


def _scorer(model: Model):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        theta = np.array(model.theta)
        own: dict[str, list[str]] = {}  # words with features of the model; others map to an empty list
        for batch in texts:
            score = np.zeros(len(batch))
            for i, text in enumerate(batch):
                total: dict[str, int] = {}
                for w, n in counts(text).items():
                    if (fs := own.get(w)) is None:
                        if len(own) >= 200_000:
                            own.clear()
                        fs = own[w] = [f for f in names(w) if f in model.weight]
                    for f in fs:
                        total[f] = total.get(f, 0) + n
                score[i] = sum(model.weight[f] * np.log1p(total[f]) for f in sorted(total))
            if not len(theta):
                yield pd.DataFrame({"severity": np.zeros(len(batch)), "grade": np.zeros(len(batch), np.int32)})
                continue
            above = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -50, 50)))
            each = np.concatenate([np.ones((len(batch), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(batch), 1))], axis=1)
            yield pd.DataFrame({"severity": np.round(above.sum(axis=1), 6), "grade": each.argmax(axis=1).astype(np.int32)})

    return run


def severity(text: Column, model: Model) -> Column:
    """Struct (severity: expected grade, grade: most probable grade) of each whole text; null reads as empty."""
    kind = T.StructType([T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])
    return F.pandas_udf(_scorer(model), kind)(text)


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """Per row of ``docs``: expected severity, most probable grade, and whether the document is rejected.

    Repeated rows are each scored. Null and empty texts hold no feature and get the severity of such a text, null ids stay.
    Without labelled documents of both classes every severity is 0. Other columns of ``docs`` play no part.
    """
    model = fit(docs, labels, id_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), severity(F.col(text_col), model).alias("s")).select(
        "doc_id", F.col("s.severity").alias("expected_severity"), "s.grade", (F.col("s.severity") >= reject).alias("toxic")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model fitted on ``labelled_docs`` doesn't reject."""
    model = fit(labelled_docs, labels, id_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = docs.select(row.alias("row")).withColumn("s", severity(F.col("row").getField(text_col), model))
    return scored.filter(F.col("s.severity") < reject).select("row.*")
