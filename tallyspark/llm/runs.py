"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least four periods and ``LEAST`` words long, that no neighbouring
word extends. The dictionary names the factors of each length L = 1, 2, 4, ...: two places get one name when their L
words are equal, a name of 2L being a pair of names of L. Only places whose name occurs again are carried to the next length.

Per length, the successor of a place is the next place with its name. Three places in equal steps d, all within 2L of
the first, propose the period d. A length looks at the steps in (L/2, L]: inside a run of period q in that interval the
successor is exactly q away (a factor that holds a whole primitive period recurs at multiples of it only), and four
periods leave room for i + 2q + L. So no run is missed, and a proposed step is the smallest period of its stretch.
Places in a row with one step are one proposal, which is extended at both ends and deduplicated.

Rows are independent: no shuffle; time is n log n of a text's words, memory in proportion to them. Defined cases: a null
text has no words; a null id leaves the words as they are; an empty text has no run, four nulls and the digest of
nothing; repeated rows give equal rows; an empty table gives an empty result; further columns aren't looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6
PERIODS = 4
RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def find_runs(words: Sequence, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start and period. ``periods`` is 4 or more."""
    if periods < 4:
        raise ValueError("the steps of a length need four periods")
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], dtype=np.int64)
    n = len(w)
    found: set[tuple[int, int, int]] = set()
    at, name, span = np.arange(n), w, 1
    while len(at) > 2 and 2 * span < n:
        order = np.argsort(name, kind="stable")  # by name, then place
        place, named = at[order], name[order]
        again = named[1:] == named[:-1]
        step = np.where(again, place[1:] - place[:-1], 0)
        three = np.flatnonzero((step[:-1] == step[1:]) & (step[:-1] <= span) & (2 * step[:-1] > span))
        for a, b, d in _in_a_row(place[three], step[three]):
            b += 2 * d + span
            while a and w[a - 1] == w[a - 1 + d]:
                a -= 1
            while b < n and w[b] == w[b - d]:
                b += 1
            if b - a >= max(least, periods * d):
                found.add((a, b - a, d))
        # Of a name that occurs once nothing longer occurs twice.
        twice = np.zeros(len(at), dtype=bool)
        twice[1:] |= again
        twice[:-1] |= again
        names = np.full(n, -1, dtype=np.int64)
        names[place[twice]] = named[twice]
        at = np.sort(place[twice])
        at = at[at + span < n]
        at = at[names[at + span] >= 0]
        _, name = np.unique(names[at] * (int(names.max(initial=0)) + 1) + names[at + span], return_inverse=True)
        span *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _in_a_row(place: np.ndarray, step: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, step) of neighbouring places with one step."""
    if not len(place):
        return []
    order = np.lexsort((place, step))
    place, step = place[order], step[order]
    cut = np.flatnonzero((step[1:] != step[:-1]) | (place[1:] != place[:-1] + 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]]) - 1
    return list(zip(place[first].tolist(), place[last].tolist(), step[first].tolist(), strict=True))


def kept_words(words: Sequence, found: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def rewritten(words: list, doc_id: str | None) -> list:
    """One document in ten, chosen by its id, with a tail that repeats a stretch of its words."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(doc_id.encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * -(-(n - a) // p))[: n - a]


def summary(words: list) -> tuple:
    """The values of ``RESULT`` for words as UTF-8 bytes."""
    found = find_runs(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    whole = b" ".join(kept_words(words, found))
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(found), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(whole).hexdigest()


def _summaries(doc_id: pd.Series, text: pd.Series) -> pd.DataFrame:
    # bytes.split() parts at blanks and the control characters 9 to 13, no others.
    rows = [summary(rewritten((t or "").encode().split(), i)) for i, t in zip(doc_id, text, strict=True)]
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = {c: "Int64" for c in names[:5]}
    return pd.DataFrame(rows, columns=names).astype(kinds)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of every document: how many, the longest, digests of all runs and of the text without their repeats."""
    told = F.pandas_udf(_summaries, RESULT)(F.col(id_col).cast("string"), F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), told.alias("r")).select("doc_id", "r.*")
