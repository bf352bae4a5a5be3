"""Personal data by bootstrapped contextual extraction.

Regular forms give the seeds (the base spans). Around each seed, and around every other range of the same shape (digit
groups joined by blank, dot, dash, slash or parenthesis; hex-colon runs; local@host), two lexical patterns are read: the
two words to its left, and the word on either side. They form a bipartite graph of
patterns and instances, which Spark scores in turns: a pattern's confidence for a kind is the confidence-weighted share
of its distinct instances that are of that kind (seeds count 1, seeds of other kinds and tokens not believed yet count
against it), an instance's is the noisy-or of the accepted patterns it stands in. Instances that end above the threshold
are identifiers that the regular forms don't know; all their occurrences become spans of that kind.

Occurrences leave the scan one by one in small batches, so a text of numbers, which has nearly a candidate per digit and
length, costs disk but not memory. Context words are found however far away they stand; a word counts by the ``WORD``
code points nearest to the span, so that a text that is one long word keeps short patterns.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import row_key, small, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SEEDS = 5  # distinct believed instances that an accepted pattern has, at least
MIN_PATTERN = 0.6  # confidence of an accepted pattern
MIN_INSTANCE = 0.6  # confidence of an accepted instance
WORD = 256  # code points of a context word, those nearest to the span
BATCH = 2000  # occurrences that leave the scan at once

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_nondigit = re.compile(r"[^0-9]+")
_digit = re.compile(r"[0-9]+")
_run = re.compile(r"[0-9]++(?:[ ().+/-]++[0-9]++)*")
_piece = re.compile(r"[0-9]++(?:[().+-]++[0-9]++)*")  # of a run, between blanks and slashes
_hex_run = re.compile(r"[0-9A-Fa-f:]++")
_L = r"""[^\s@<>,;:()\[\]{}|"]"""
_address = re.compile(rf"""(?:(?<!{_L}){_L}++|"[^"@\n]++")(?:@++(?:{_L}++|\[[^\s\[\]]*+\]))+""")
_word = re.compile(r"\S+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the whole run of local characters before it: leftmost matches, found in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _domain.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the regular forms, sorted; code points, end exclusive."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _ip.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _card.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _nondigit.sub("", m[0])) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 9 <= len(_nondigit.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


class _Words:
    """The words of a text by position, for contexts."""

    def __init__(self, text: str) -> None:
        self.text = text

    def __getattr__(self, name: str) -> array:
        # Most texts have no candidate: words are looked for when the first context is asked for.
        self.starts, self.ends = array("q"), array("q")
        for m in _word.finditer(self.text):
            self.starts.append(m.start())
            self.ends.append(m.end())
        return self.__dict__[name]

    def left(self, at: int) -> list[str]:
        """The last two words, or parts of words, that begin before a position, nearest last."""
        i = bisect_left(self.starts, at) - 1
        out = []
        for j in (i, i - 1):
            if j >= 0:
                end = min(self.ends[j], at)
                out.append(self.text[max(self.starts[j], end - WORD) : end].lower())
        return out[::-1]

    def right(self, at: int) -> list[str]:
        """The first word, or rest of a word, after a position."""
        i = bisect_right(self.ends, at)
        if i == len(self.ends):
            return []
        start = max(self.starts[i], at)
        return [self.text[start : min(self.ends[i], start + WORD)].lower()]


def _edges(left: list[str], right: list[str], two: bool = True) -> list[str]:
    """The lexical patterns around a span: two words to the left (unless not ``two``), one on either side."""
    out = [f"L {left[0]} {left[1]}"] if two and len(left) == 2 else []
    return out + ([f"B {left[-1]} _ {right[0]}"] if left and right else [])


def _numbers(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, kind, two) of each range of whole pieces of a digit run that has the digits of a card or a phone.

    ``two``: the words to its left speak for it: the longest range of its kind from that start, and a piece alone.
    """
    for m in _run.finditer(text):
        pieces = [(p.start(), p.end()) for p in _piece.finditer(text, m.start(), m.end())]
        sizes = [len(_nondigit.sub("", text[s:e])) for s, e in pieces]
        for i, (first, _) in enumerate(pieces):
            if first and text[first - 1].isalpha():
                continue
            here, digits = [], 0
            signed = first - (first > 0 and text[first - 1] == "+")
            for j in range(i, len(pieces)):
                digits, end = digits + sizes[j], pieces[j][1]
                if digits > 19 and j > i:
                    break
                if end < len(text) and text[end].isalpha():
                    continue
                body, start = text[first:end], signed
                if body.count(")") > body.count("(") and start and text[start - 1] == "(":
                    start -= 1 + (start > 1 and text[start - 2] == "+")
                if i == j and body.count(".") == 3 and set(_digit.sub("", body)) == {"."}:
                    here.append((start, end, 1, j))
                if 12 <= digits <= 19 and not set(text[start:end]) - set("0123456789 -"):
                    here.append((start, end, 2, j))
                if 7 <= digits <= 15:
                    here.append((start, end, 3, j))
            last = {k: j for _, _, k, j in here}
            for start, end, k, j in here:
                yield start, end, k, j in (i, last[k])


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of hex digits and two colons at least, without parts of words and single colons at their ends."""
    for m in _hex_run.finditer(text):
        s, e = m.span()
        if m[0].count(":") < 2:
            continue
        if s and text[s - 1].isalnum():
            s = text.index(":", s)
        if e < len(text) and text[e].isalnum():
            e = text.rindex(":", s, e) + 1
        s += text[s : s + 1] == ":" and text[s : s + 2] != "::"
        e -= e > s and text[e - 1] == ":" and text[max(s, e - 2) : e] != "::"
        if text.count(":", s, e) >= 2 and text[s:e].strip(":"):
            yield s, e


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _address.finditer(text):
        e = m.end()
        while not (text[e - 1].isalnum() or text[e - 1] == "]"):
            e -= 1
        s = m.start()
        while s < e and not (text[s].isalnum() or text[s] in '+_"'):
            s += 1
        if 0 < text.find("@", s, e) - s:
            yield s, e


def occurrences(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """(seed, kind, start, end, value, patterns) of seeds and, outside the base spans, of every range of an identifier's shape.

    A phone number may hold a base span that is the beginning of a longer dotted run (an address has four numbers).
    """
    words = _Words(text)
    for s, k, e in base:
        yield True, k, s, e, text[s:e].lower(), _edges(words.left(s), words.right(e))
    taken: list[list] = []  # disjoint; the third says if candidates may hold it
    for s, k, e in sorted(base):
        if taken and s < taken[-1][1]:
            taken[-1] = [taken[-1][0], max(e, taken[-1][1]), False]
        else:
            taken.append([s, e, k == 1 and text[e : e + 1] == "." and text[e + 1 : e + 2].isdecimal()])
    ends = [e for _, e, _ in taken]

    def free(s: int, e: int, k: int) -> bool:
        at = bisect_left(ends, s + 1)
        while at < len(taken) and taken[at][0] < e:
            if not (k == 3 and taken[at][2] and s <= taken[at][0] and taken[at][1] < e):
                return False
            at += 1
        return True

    shapes = [((s, e, 0, True) for s, e in _addresses(text))] if "@" in text else []
    shapes += [((s, e, 1, True) for s, e in _hex_runs(text))] if ":" in text else []
    lefts: dict[int, list[str]] = {}  # ranges that follow each other share their ends
    rights: dict[int, list[str]] = {}
    for s, e, k, two in chain(*shapes, _numbers(text)):
        if free(s, e, k):
            if len(lefts) + len(rights) > 1000:
                lefts.clear()
                rights.clear()
            left = lefts[s] if s in lefts else lefts.setdefault(s, words.left(s))
            right = rights[e] if e in rights else rights.setdefault(e, words.right(e))
            yield False, k, s, e, text[s:e].lower(), _edges(left, right, two)


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_BASE = "base array<struct<start:int,kind:int,end:int>>"
_FOUND = "k1 long, k2 long, seed boolean, kind int, start int, end int, value string, patterns array<string>"
_FOUND_ARROW = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string())]


def _bases(texts: pd.Series) -> pd.Series:
    spans = ([{"start": s, "kind": k, "end": e} for s, k, e in base_spans(text or "")] for text in texts)
    return pd.Series(list(spans), dtype=object)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FOUND_ARROW, strict=True)], names)

    rows: list[tuple] = []
    for b in batches:
        for k1, k2, text in zip(*(b.column(c) for c in ("k1", "k2", "text")), strict=True):
            text = text.as_py() or ""
            for found in occurrences(text, base_spans(text)):
                rows.append((k1.as_py(), k2.as_py(), *found))
                if len(rows) == BATCH:
                    yield batch(rows)
                    rows = []
    if rows:
        yield batch(rows)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Occurrences for the graph, stored, a row each with the key of the document's row; repeated rows share a key."""
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_scan, _FOUND))


def learn(scanned: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value, belief): the instances found by accepted patterns, seeds left out."""
    edges = stored(scanned.select("kind", "value", "seed", F.explode("patterns").alias("pattern")).distinct())
    belief = None
    for _ in range(rounds):
        known = edges.withColumn("belief", F.col("seed").cast("double"))
        if belief is not None:
            known = (
                edges.join(small(belief), ["kind", "value"], "left")
                .withColumn("belief", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))))
            )
        own = known.groupBy("pattern", "kind").agg(
            F.sum("belief").alias("good"), F.count("*").alias("n"), F.sum(F.col("seed").cast("int")).alias("seeds")
        )
        all_seeds = own.groupBy("pattern").agg(F.sum("seeds").alias("all_seeds"))
        accepted = (
            own.filter(F.col("good") >= MIN_SEEDS)
            .join(all_seeds, "pattern")
            # instances of this kind, and the seeds of other kinds in the same place
            .withColumn("confidence", F.col("good") / (F.col("n") + F.col("all_seeds") - F.col("seeds")))
            .filter(F.col("confidence") >= MIN_PATTERN)
            .select("pattern", "kind", "confidence")
        )
        accepted = stored(accepted)
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1.0) - F.col("confidence"), F.lit(1e-6)))))
        belief = stored(
            edges.filter(~F.col("seed"))
            .join(small(accepted), ["pattern", "kind"])
            .groupBy("kind", "value")
            .agg(F.round(F.lit(1.0) - doubt, 6).alias("belief"))
            .filter(F.col("belief") >= MIN_INSTANCE)
        )
    return belief


def _apart(spans: pd.Series) -> pd.Series:
    """Of overlapping spans the likeliest, then the longest."""
    out = []
    for each in spans:
        kept: list[tuple[int, int, int]] = []
        for _, _, s, k, e in sorted((-x["belief"], x["start"] - x["end"], x["start"], x["kind"], x["end"]) for x in each):
            at = bisect_left(kept, (s,))
            if (at == 0 or kept[at - 1][2] <= s) and (at == len(kept) or kept[at][0] >= e):
                kept.insert(at, (int(s), int(k), int(e)))
        out.append([{"start": s, "kind": k, "end": e} for s, k, e in kept])
    return pd.Series(out, dtype=object)


def added_spans(scanned: DataFrame) -> DataFrame:
    """(k1, k2, added): spans of learnt instances per row key, of overlapping ones the likeliest, then the longest."""
    belief = learn(scanned)
    spans = (
        scanned.filter(~F.col("seed"))
        .join(small(belief), ["kind", "value"])
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "kind", "end", "belief")).alias("spans"))
    )
    apart = F.pandas_udf(_apart, "array<struct<start:int,kind:int,end:int>>")
    return spans.select("k1", "k2", apart("spans").alias("added"))


def _number(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s.kind), s.start, s.end)), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: base spans counted by kind, their digest, all spans, and how many of them were learnt.

    Null and empty texts have no spans; repeated rows get the same result each; other columns are left out.
    """
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    bases = F.pandas_udf(_bases, _BASE.split(" ", 1)[1])(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), bases.alias("base"))
    more = small(stored(added_spans(scan(docs, id_col, text_col))))
    added = F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return rows.join(more, ["k1", "k2"], "left").select(
        "doc_id",
        *[_number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", added))).alias("spans"),
        F.size(added).cast("long").alias("n_learnt"),
    )


def _mask(texts: pd.Series, added: pd.Series) -> pd.Series:
    out = []
    for text, more in zip(texts, added, strict=True):
        if text is None:
            out.append(None)
            continue
        spans = sorted([*base_spans(text), *((int(s["start"]), int(s["kind"]), int(s["end"])) for s in (more if more is not None else ()))])
        parts, at = [], 0
        for s, k, e in spans:
            if s >= at:
                parts += [text[at:s], f"[{KINDS[k].upper()}]"]
            at = max(at, e)
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out, dtype=object)


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans: the first) and the length counted anew."""
    scanned = scan(docs, id_col, text_col)
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    both = rows.join(small(stored(added_spans(scanned))), ["k1", "k2"], "left")
    masked = both.withColumn("masked", F.pandas_udf(_mask, T.StringType())(F.col("row").getField(text_col), "added"))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("masked").alias(c))
        elif c == length_col:
            cols.append(F.length("masked").cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row").getField(c).alias(c))
    return masked.select(*cols)
