from __future__ import annotations

from collections import Counter, deque

import hashlib
import random
import re

import pytest

from tallyspark.llm import pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_plain_forms():
    rng = random.Random(3)
    parts = ["a", "@", ".", "1", "23", "255", "300", "+", "-", " ", "(", ")", "x.y", "4111111111111111", "é😀", "b@c.d", "1.2.3.4", "+1 555 123 4567"]
    for _ in range(20_000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert pii.base_spans(s) == plain(s), s


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 200_000, "+" * 200_000, "a@" * 100_000, "+1 " * 60_000, "1 " * 100_000])
def test_very_long_texts_take_linear_time(text):
    deque(pii.occurrences(text, pii.base_spans(text)), maxlen=0)


def _listed(spans):
    names = list(FORMS)
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def test_report(odd, real):
    for docs in (odd, real):
        got = pii.report(docs)
        rows = got.collect()
        texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        assert len(rows) == docs.count()
        for r in rows:
            want = plain(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(_listed(want).encode()).hexdigest()
            assert [r[f"n_{k}"] for k in FORMS] == [sum(x[1] == i for x in want) for i in range(4)]
            assert set(_listed(want).split(",")) <= set(r["spans"].split(",")) or not want


def test_empty_table(no_docs):
    assert pii.report(no_docs).collect() == []
    assert pii.mask(no_docs).collect() == []


@pytest.fixture(scope="module")
def calls(spark):
    rows = [(i, f"please call me, my number is +1 555 {100 + i} 9{i:03d} thanks") for i in range(30)]
    rows += [(100 + i, f"well my number is 555-77{i:02d}-12 thanks") for i in range(4)]
    rows += [(200, "parcel 555-7712-12 was sent"), (201, "order 998877665 shipped"), (202, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_context_finds_unseen_numbers_and_leaves_others(calls):
    got = {r["doc_id"]: r for r in pii.report(calls).collect()}
    assert all(got[100 + i]["spans"] == "phone:18:29" and got[100 + i]["n_learnt"] == 1 for i in range(4))
    assert got[201]["spans"] == "" and got[202]["spans"] == "" and got[200]["spans"] == ""


def test_mask_replaces_base_and_learnt_spans(calls):
    got = {r["doc_id"]: r["text"] for r in pii.mask(calls).collect()}
    assert got[1] == "please call me, my number is [PHONE] thanks"
    assert got[100] == "well my number is [PHONE] thanks"
    assert got[201] == "order 998877665 shipped" and got[202] is None


def test_mask_keeps_columns_and_counts_characters(odd):
    got = pii.mask(odd)
    assert got.columns == odd.columns
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got.collect())


def _candidates(text):
    return {(kind, text[start:end]) for seed, kind, start, end, *_ in pii.occurrences(text, pii.base_spans(text)) if not seed}


@pytest.mark.parametrize(
    "kind, value",
    [
        (3, "(838) 555-7235"),
        (2, "4111 1111 1111 1112"),
        (3, "01.23.45.67.89"),
        (3, "12-34-56-78-90"),
        (3, "838/555 72 35"),
        (1, "fe80::1:2"),
        (1, "2001:db8::"),
        (1, "300.1.2.3"),
        (0, "x" * 60 + "@host"),
        (0, "a@b"),
    ],
)
def test_every_shape_is_a_candidate_as_a_whole(kind, value):
    for text in (value, f"so it is {value} they said", f"at:{value}, then", f"({value})", f"7 {value} 9"):
        assert (kind, value) in _candidates(text), text


def test_words_and_digests_are_no_candidates():
    assert _candidates("sha a1234567b std::vector feed 12 ab@ @cd e3b0c44298fc1c149afbf4c8996fb924 1 2 3") == set()


@pytest.mark.parametrize("text", ["a:" * 100_000, "1.1.1.1." * 30_000, "a@[" * 60_000, '"' * 200_000, "(" * 100_000 + "1", "1-" * 100_000, "1(" * 100_000, "1" + " " * 200_000 + "a"])
def test_candidates_take_linear_time(text):
    deque(pii.occurrences(text, pii.base_spans(text)), maxlen=0)


def test_whole_spaced_and_short_grouped_numbers_are_masked(spark):
    rows = [(i, f"please call me, my number is +1 555 {100 + i} 9{i:03d} thanks") for i in range(30)]
    new = ["(838) 555-7235", "838 555 7236", "12-34-56-78-90", "01.23.45.67.89"]
    rows += [(100 + i, f"well my number is {v} thanks") for i, v in enumerate(new)]
    rows += [(200 + i, f"reach cell via 10.0.0.{i} now") for i in range(30)] + [(300, "reach cell via fe80::1:2 now")]
    rows += [(400, "at noon 838 555 7236 2024 we left")]  # known from elsewhere
    got = {r["doc_id"]: r["text"] for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[100 + i] for i in range(3)] == ["well my number is [PHONE] thanks"] * 3
    assert got[103] == "well my number is [IP] thanks"  # the first of overlapping spans names it, all of it goes
    assert got[300] == "reach cell via [IP] now" and got[400] == "at noon [PHONE] 2024 we left"


def test_contexts_are_two_whole_words_however_far_away():
    far = "w" * 100
    text = f"alpha {far}  {' ' * 300} 10.0.0.1 {' ' * 90} omega tail"
    (_, _, _, _, value, patterns), *_ = pii.occurrences(text, pii.base_spans(text))
    assert value == "10.0.0.1" and patterns == [f"L alpha {far}", f"B {far} _ omega"]
    glued = "x" * 2000 + ":10.0.0.1/" + "y" * 2000
    (*_, patterns), *_ = pii.occurrences(glued, pii.base_spans(glued))
    assert patterns == [f"B {'x' * (pii.WORD - 1)}: _ /{'y' * (pii.WORD - 1)}"]


def test_a_text_of_numbers_keeps_memory_bounded():
    """Two megabytes of digits: the candidates leave in small batches."""
    import tracemalloc

    import pyarrow as pa

    text = "7 3 " * 25_000
    batch = pa.RecordBatch.from_pydict({"k1": [1], "k2": [2], "text": [text]}, schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("text", pa.string())]))
    tracemalloc.start()
    n = sum(b.num_rows for b in pii._scan(iter([batch])))
    small = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 8 * 50_000  # nothing is left out
    # A hundred thousand characters take a few tens of megabytes, in proportion to the digits, not to the candidates.
    assert small < 45_000_000
    whole = "7 3 " * 500_000
    stream = pii.occurrences(whole, pii.base_spans(whole))
    tracemalloc.start()
    for _ in range(200_000):
        next(stream)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 600_000_000


def _score(edges, rounds=3):
    """The scorer in plain Python: (kind, value, pattern) edges with a seed flag."""
    belief = {}
    for _ in range(rounds):
        good, n, seeds = Counter(), Counter(), Counter()
        for kind, value, pattern, seed in edges:
            good[pattern, kind] += 1.0 if seed else belief.get((kind, value), 0.0)
            n[pattern, kind] += 1
            seeds[pattern, kind] += seed
        confidence = {}
        for pattern, kind in n:
            others = sum(c for (p, k), c in seeds.items() if p == pattern and k != kind)
            share = good[pattern, kind] / (n[pattern, kind] + others)
            if good[pattern, kind] >= pii.MIN_SEEDS and share >= pii.MIN_PATTERN:
                confidence[pattern, kind] = share
        doubt = {}
        for kind, value, pattern, seed in edges:
            if not seed and (pattern, kind) in confidence:
                doubt[kind, value] = doubt.get((kind, value), 1.0) * max(1.0 - confidence[pattern, kind], 1e-6)
        belief = {x: round(1.0 - d, 6) for x, d in doubt.items() if round(1.0 - d, 6) >= pii.MIN_INSTANCE}
    return belief


def test_the_graph_scores_equal_a_plain_scorer(spark):
    texts = []
    for i in range(40):
        texts.append(f"please call me on +1 555 010 {1000 + i} today")
        texts.append(f"server address is 10.0.{i}.7 today")
    for i in range(12):
        texts.append(f"please call me on 838-555-{7200 + i} today")  # no plus sign: learnt from the context
        texts.append(f"ring soon at 838-555-{7200 + i} again")  # and this context from those
    texts += [f"ring soon at 838-555-{8300 + i} again" for i in range(6)]
    texts += [f"order number 444-555-{8300 + i} shipped" for i in range(30)]
    texts += [f"order number +1 555 020 {1000 + i} shipped" for i in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    edges = set()
    for t in texts:
        for seed, kind, _, _, value, patterns in pii.occurrences(t, pii.base_spans(t)):
            edges |= {(kind, value, p, seed) for p in patterns}
    want = _score(edges)
    got = {(r["kind"], r["value"]): r["belief"] for r in pii.learn(pii.scan(docs)).collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-5 for x in want)
    assert (3, "838-555-7205") in got and (3, "838-555-8301") in got and (3, "444-555-8301") not in got
    learnt = {r["doc_id"]: r["n_learnt"] for r in pii.report(docs).collect()}
    assert sum(learnt.values()) >= 30
