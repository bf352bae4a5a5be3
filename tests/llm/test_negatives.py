from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100):
    """Every anchor against all rows, by Python integers."""
    seen = set()
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    rows = sorted(seen, key=lambda r: (r[0], r[1], r[2]))
    out, asked = set(), set()
    for a, label, q in rows:
        if a % every or a in asked:
            continue
        asked.add(a)
        scored = sorted(((-sum(x * y for x, y in zip(q, v, strict=False)), i, other) for i, other, v in rows if i != a))
        for ps, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 30 * -ps <= 100 * -r[0] <= 90 * -ps][:10]
            out |= {(a, p, n + 1, i, -ps, -s) for n, (s, i, _) in enumerate(fit)}
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"extra {c}") for c in ("v", "x", "n", "cell", "tag", "shard", "score")})


def rows_of(v, labels, ids=None):
    v = np.asarray(v, dtype=np.float32)
    ids = range(len(v)) if ids is None else ids
    return [(int(i), [float(c) for c in x], int(y)) for i, x, y in zip(ids, v, labels, strict=True)]


def answers(df, **how):
    got = [tuple(r) for r in negatives.report(df, **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


def cases():
    rng = np.random.default_rng(5)
    n = 900
    centres = rng.normal(size=(9, 12))
    clustered = centres[rng.integers(9, size=n)] + rng.normal(size=(n, 12)) * 0.2
    lengths = clustered * rng.lognormal(sigma=1.0, size=(n, 1))
    pareto = rng.normal(size=(n, 4)) * rng.pareto(1.5, size=(n, 1))
    coarse = rng.integers(0, 2, size=(n, 8)) / 256  # many ties
    hot = np.where(rng.random((n, 1)) < 0.4, centres[:1], clustered)
    labels = rng.integers(10, size=n)
    one_label = np.where(rng.random(n) < 0.6, 3, labels)
    return {
        "random": rows_of(rng.normal(size=(n, 24)), labels),
        "clustered": rows_of(clustered, labels),
        "log-normal lengths": rows_of(lengths, labels, rng.permutation(n)),
        "pareto lengths": rows_of(pareto, one_label, rng.permutation(n)),
        "ties": rows_of(coarse, labels, rng.permutation(n)),
        "hot vector and label": rows_of(hot, one_label, rng.permutation(n)),
    }


CASES = cases()


@pytest.mark.parametrize(("name", "how"), [(n, {"shard_rows": 60, "max_centres": 4}) for n in CASES] + [("random", {}), ("hot vector and label", {"shard_rows": 60})])
def test_equals_brute_force(spark, name, how):
    want = brute(CASES[name])
    assert want and answers(table(spark, CASES[name]), **how) == want


def test_nodes_outside_the_windows_are_skipped():
    """On clusters far apart the search verifies a small part of the candidates."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 2560
    x = np.floor(centres[rng.integers(40, size=4000)] + rng.normal(size=(4000, 8)) * 25).astype(np.int64)
    x = np.unique(x, axis=0)
    radius = float(np.sqrt((x * x).sum(axis=1).max())) * (1 + 1e-9)
    tree = negatives.build(x, radius)
    members = sorted(i for n in tree["nodes"] for c, f, e in zip(n[2], n[3], n[4], strict=True) if c < 0 for i in tree["order"][f:e])
    assert members == list(range(len(x)))  # each candidate in one leaf
    p = negatives._lifted(x, radius)
    for centre, reach, _child, first, last in tree["nodes"]:
        for c, r, f, e in zip(centre, reach, first, last, strict=True):
            assert negatives._distances(p[[c]], p[tree["order"][f:e]]).max() <= r
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            looked.append(np.size(at))
            return np.asarray(self)[at]

    tree |= {"x": x.astype(float).view(Counted), "wide": None, "radius": radius, "first": np.arange(len(x))}
    q, fits = x[7], np.ones(len(x), dtype=bool)
    full = x @ q
    top = int(full.max())
    for low, high in ((-math.inf, math.inf), (0.3 * top, 0.5 * top), (top + 1, math.inf)):
        looked.clear()
        best = negatives.search(tree, q, fits, [(low, high)], 10)[0]
        want = sorted((-s, i) for i, s in enumerate(full.tolist()) if low <= s <= high)[:10]
        assert list(zip((-best.score).tolist(), best.at.tolist(), strict=True)) == want
        assert sum(looked) < len(x) / 2


def test_rows_that_take_no_part_and_repeats(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [2.0, 0.5], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [1.0, float("nan")], 1), (4, [float("inf"), 1.0], 1), (5, [1.0, 1.0], None)]
    rows += [(8, [1.0, 0.5], 2), (9, [0.9, 0.5], 2), (9, [0.9, 0.5], 2), (9, [0.5, 0.5], 2), (10, [], 2), (11, [0.5], 3), (12, [0.25, 0.25], 3), (13, [0.25, 0.25], 2), (100, [0.0, 0.0], 2), (200, [-1.0, 0.0], 2)]
    want = brute(rows)
    assert want and {r[0] for r in want} >= {0, 100}
    assert answers(table(spark, rows)) == want
    assert answers(table(spark, [])) == set()
    assert answers(table(spark, [(0, [1.0], 1)])) == set()


def test_large_integers(spark):
    rng = np.random.default_rng(2)
    rows = rows_of(rng.normal(size=(300, 3)) * 2.0**18, rng.integers(3, size=300))  # squares beyond 52 bits
    want = brute(rows)
    assert want and answers(table(spark, rows), shard_rows=50) == want
    with pytest.raises(Exception, match="62 bits"):
        answers(table(spark, [(0, [1e12], 1), (1, [1e12], 1)]))


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    assert want and answers(df) == want
