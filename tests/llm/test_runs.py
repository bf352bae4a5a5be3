from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tallyspark.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute(w):
    """Every stretch, its smallest period by trial, and whether a neighbour extends it."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *top, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("seed", range(40))
def test_random_words_with_planted_runs(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcde"
    w = []
    while len(w) < rng.choice([0, 5, 30, 120, 200]):
        part = [rng.choice(letters) for _ in range(rng.randint(1, 17))]
        w += part * rng.choice([1, 1, 3, 4, 5, 9]) + part[: rng.randint(0, len(part))]
    assert runs.find_runs(w) == brute(w)


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_bounds_of_length_at_every_period(period, extra):
    length = max(6, 4 * period) + extra
    w = ["x"] + [str(i % period) for i in range(length)] + ["y", "z"]
    assert runs.find_runs(w) == ([(1, length, period)] if extra >= 0 else [])


def test_nested_runs_and_kept_words():
    w = list("aaaaaab" * 4 + "c")
    found = runs.find_runs(w)
    assert found == brute(w) and (0, 28, 7) in found and (0, 6, 1) in found
    assert "".join(runs.kept_words(w, found)) == "abc"  # of each a-run the first stays, unless the long run drops it


def test_long_texts_stay_fast():
    w = [b"same"] * 300_000
    assert runs.find_runs(w) == [(0, 300_000, 1)]
    v = [str(i % 70_000) for i in range(300_000)]
    assert runs.find_runs(v) == [(0, 300_000, 70_000)]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(list("aabb"), periods=3)


def test_report_equals_brute_force(spark, odd, real, no_docs):
    for df in (odd.filter("doc_id <> 4 OR doc_id IS NULL"), real.filter("length(text) < 6000")):
        rows = df.select("doc_id", "text").collect()
        got = [tuple(r) for r in runs.report(df).collect()]
        assert sorted(got, key=str) == sorted((brute_row(*r) for r in rows), key=str)
    assert runs.report(no_docs).count() == 0
    four = runs.report(odd.filter("doc_id = 4")).first()
    assert (four["start"], four["length"], four["period"], four["exponent_milli"]) == (0, 5000, 1, 5_000_000)


def test_words_part_at_the_named_characters_only(spark):
    t = "a\x1c\x85  b \t\n\x0b\x0c\rc\x00d"
    row = runs.report(spark.createDataFrame([(3, t)], "doc_id long, text string")).first()
    assert tuple(row) == brute_row(3, t) and t.encode().split() == [w.encode() for w in WORD.findall(t)]
