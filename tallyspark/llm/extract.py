"""Main text of web pages by line-block distribution.

Markup is stripped to lines: a block element ends a line, text inside a line keeps one space for any white space, and an
element that is boilerplate by its name or role leaves ``WINDOW`` empty lines. Text lengths are summed over a
sliding window of ``WINDOW`` lines. Where that sum rises from zero is a surge point, where it falls back to zero a dive
point; the text between belongs together.

Class names and ids are evidence. A name made of boilerplate words alone, or with a word that content hardly bears
(``SURE``), empties its element; any other name with such a word only if most of the element's text is links; and if
nothing else is left on the page, none does. What follows a word of ``STATES`` ("content-with-sidebar") says nothing.

In a page whose article and main elements hold at least half as much text as the rest, the blocks inside any of them are
kept, all of them. On other pages lines that are mostly links count as empty, teaser articles are left out, and the blocks
kept are those that peak at ``DENSE`` characters, all between the first and the last of these, those that share their
container (the body is one, too) with one of these, headings before them, and sentences beside them; where no block is
that dense, all are. Short lines on cookies or rights go where their container holds nothing else.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
DENSE = 40  # window sum of a dense block (pages without an article element)
LINKS = 0.6  # share of link text from which a line counts as empty there
MAIN_SHARE = 0.5  # of the rest's text: what main elements hold at least
RIGHTS = 200  # characters of a line on cookies or rights, at most, that alone in its container is boilerplate
TAG = 65_536  # characters of a tag that is looked for on a page with many quotes that don't end

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())  # their content isn't page text
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = frozenset("nav aside footer form menu dialog select button template svg canvas object audio video map datalist".split())
MAIN = frozenset("article main".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody table ul ol dl figure figcaption html body".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
# Words of class names and ids that mark boilerplate; of headers only outside the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert modal popup overlay newsletter subscribe subscription signup login nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar aside footer foot share sharing social related recommended recommendations widget pagination "
    "pager comment comments commentlist disqus respond reply replies toolbar skip".split()
)
HEADERS = frozenset("header masthead topbar".split())
STATES = frozenset("no not has with without is".split())  # "has-sidebar" says something about a page, not what the element is
SURE = frozenset(
    "cookie cookies consent gdpr newsletter advert adverts advertisement advertisements advertising adsense sponsored navbar "
    "breadcrumb breadcrumbs pagination comments commentlist disqus".split()
)
# Words that leave a boilerplate word's meaning as it is.
PLAIN = frozenset(
    "site page main top bottom left right box bar block list item items area section container wrapper wrap inner outer global "
    "primary secondary post article entry user reader author blog google slot unit zone panel link links button buttons icon icons "
    "fixed sticky mobile desktop js id".split()
)
TEASERS = frozenset("teaser teasers card cards preview previews".split())
HEADINGS = frozenset("h1 h2 h3".split())
_rights = re.compile(r"\u00a9|\(c\) *\d{4}|copyright|all rights reserved|cookies?\b|privacy policy|terms of (?:use|service)", re.IGNORECASE)
_sentence = re.compile(r"""[.!?\u2026\u3002]["'\u201d\u2019)]*\Z""")

_tag = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_loose_tag = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_attribute = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_mark_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")  # camelCase, kebab-case and snake_case names apart


def _names(attributes: str) -> Iterator[tuple[str, list[str]]]:
    """(kind, words up to one of ``STATES``) of each role, class and id."""
    for kind, value in _attribute.findall(attributes):
        for name in value.strip("\"'").split():
            words = [w.lower() for w in _mark_word.findall(name)]
            cut = next((i for i, w in enumerate(words) if w in STATES), len(words))
            if words[:cut]:
                yield kind.lower(), words[:cut]


def _is_boilerplate(name: str, attributes: str, in_main: bool) -> str:
    """"" for no boilerplate, "sure" for certain, "maybe" if only the name of the element suggests it."""
    if name in BOILERPLATE or name == "header" and not in_main:
        return "sure"
    if not attributes or name in ("html", "body") or name in MAIN:
        return "sure" if name in MAIN and "comment" in attributes.lower() else ""
    out = ""
    for kind, words in _names(attributes):
        if kind == "role":
            if words[0] in ROLES and not (in_main and words[0] == "banner"):
                return "sure"
            continue
        marks = [w for w in words if w in MARKS or w in HEADERS and not in_main]
        if marks:
            if any(w in SURE for w in marks) or all(w in MARKS or w in HEADERS or w in PLAIN for w in words):
                return "named"
            out = "maybe"
    return out


class Line(NamedTuple):
    text: str
    links: int  # characters of link text
    main: int  # number of its main element (0: none)
    home: int  # number of its container (0: none)
    doubts: tuple[int, ...]  # numbers of the elements around it whose names suggest boilerplate
    heading: bool
    teaser: bool


def lines(page: str) -> tuple[list[Line], dict[int, str]]:
    """Each line of a page outside certain boilerplate, and what the names of doubtful elements say."""
    out: list[Line] = []
    doubts: list[tuple[int, int]] = []  # (stack depth, number) of the open elements in doubt
    said: dict[int, str] = {}
    teasers: list[int] = []  # stack depths of open teaser articles
    boxes: list[tuple[int, int]] = []  # (stack depth, number) of the open containers
    box_no = 0
    parts: list[str] = []
    links = 0
    stack: list[str] = []  # open elements
    block_at: list[int] = []  # stack depths of those that aren't inline
    opened: Counter = Counter()  # how often each name is open
    skip = 0  # stack depth of the boilerplate element we are in, plus one
    mains: list[int] = []  # stack depths of open main elements
    main_no = link_depth = 0

    def end_line() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                home = boxes[-1][1] if boxes else 0
                chain = tuple(n for _, n in doubts)
                out.append(Line(text, min(links, len(text)), main_no if mains else 0, home, chain, any(opened[h] for h in HEADINGS), bool(teasers)))
            parts.clear()
        links = 0

    def pop_to(depth: int) -> None:
        nonlocal skip, link_depth
        while len(stack) > depth:
            gone = stack.pop()
            opened[gone] -= 1
            if block_at and block_at[-1] == len(stack):
                block_at.pop()
            if boxes and boxes[-1][0] == len(stack):
                boxes.pop()
            if gone == "a" and link_depth:
                link_depth -= 1
            if doubts and doubts[-1][0] == len(stack):
                doubts.pop()
            if teasers and teasers[-1] == len(stack):
                teasers.pop()
            if mains and mains[-1] == len(stack):
                end_line()
                mains.pop()
        if skip and len(stack) < skip:
            skip = 0

    at, size, last = 0, len(page), page.rfind(">") + 1
    badly_quoted = 0
    while at < size:
        lt = page.find("<", at, last)  # behind the last > there is only text
        if lt != at:
            text = page[at:lt] if lt >= 0 else page[at:].partition("<!--")[0]
            if not skip:
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if link_depth:
                    links += len(text)
            if lt < 0:
                break
            at = lt
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        m = _tag.match(page, at, size if badly_quoted < 100 else at + TAG)
        if not m:  # a quote without its end: the tag ends at the next >
            m = _loose_tag.match(page, at)
            badly_quoted += m is not None
        if not m:
            if not skip:
                parts.append("<")
            at += 1
            continue
        at = m.end()
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if name not in INLINE and not skip:
            end_line()
        if closing:
            if opened[name]:
                while stack[-1] != name:
                    pop_to(len(stack) - 1)
                pop_to(len(stack) - 1)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
            stop = page.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else size
            continue
        if name in VOID or attributes.endswith("/") and name not in INLINE | MAIN:
            continue
        if name not in INLINE:  # a paragraph ends where the next block begins, a list item where the next one begins
            p = block_at[-1] if block_at else -1
            if p >= 0 and (stack[p] == "p" or stack[p] == name and name in ("li", "dd", "dt", "td", "th", "tr", "option")):
                pop_to(p)
        kind = _is_boilerplate(name, attributes, bool(mains))
        if skip and name in MAIN and not kind and not mains:
            skip = 0  # a boilerplate element that was never closed doesn't hold the article
        if not skip and kind == "sure":
            end_line()
            out += [Line("", 0, main_no if mains else 0, 0, (), False, False)] * WINDOW
            skip = len(stack) + 1
        elif not skip and kind:
            end_line()
            number = len(said) + 1
            said[number] = kind
            doubts.append((len(stack), number))
            out += [Line("", 0, main_no if mains else 0, 0, (number,), False, False)] * WINDOW
        if not skip and name in MAIN:
            if not mains:
                doubts.clear()  # names around an article say nothing about it
            if any(w in TEASERS for _, words in _names(attributes) for w in words):
                teasers.append(len(stack))
        if name not in INLINE:
            block_at.append(len(stack))
            if name not in LEAVES:
                box_no += 1
                boxes.append((len(stack), box_no))
        stack.append(name)
        opened[name] += 1
        if name == "a":
            link_depth += 1
        if not skip and (name in MAIN or re.search(r"""\brole\s*=\s*["']?main\b""", attributes, re.IGNORECASE)):
            if not mains:
                main_no += 1
            mains.append(len(stack) - 1)
    end_line()
    return out, said


def _without_doubts(rows: list[Line], said: dict[int, str]) -> list[Line]:
    """The lines that are left once doubtful elements are judged: as named, or by their share of links."""
    if not said:
        return rows
    size: Counter = Counter()
    links: Counter = Counter()
    for r in rows:
        for n in r.doubts:
            size[n] += len(r.text)
            links[n] += r.links
    gone = {n for n, kind in said.items() if kind == "named" or links[n] >= LINKS * size[n]}
    left = [r for r in rows if not any(n in gone for n in r.doubts)]
    if any(r.text for r in rows) and not any(r.text and r.links < LINKS * len(r.text) for r in left):
        gone = {n for n in gone if said[n] != "named"}  # all text stands in elements named so: the names are wrong
    out = []
    for r in rows:
        if not r.text and r.doubts:
            if any(n in gone for n in r.doubts):
                out.append(r)
        elif not any(n in gone for n in r.doubts):
            out.append(r)
    return out


def blocks(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak): ranges of lines between a rise of the window sum from zero and its fall to zero."""
    out, start, peak, total = [], None, 0, 0
    for i, n in enumerate([*lengths, *[0] * window]):
        total += n - (lengths[i - window] if 0 <= i - window < len(lengths) else 0)
        if total and start is None:
            start, peak = i, 0
        peak = max(peak, total)
        if not total and start is not None:
            out.append((start, min(i - window + 1, len(lengths)), peak))
            start = None
    return out


def main_text(page: str | None) -> str:
    """Main text of a whole page; empty if it has none (null, empty and text-free pages)."""
    rows = _without_doubts(*lines(page or ""))
    plain = [0 if r.links and r.links >= LINKS * len(r.text) else len(r.text) for r in rows]
    inside = sum(len(r.text) for r in rows if r.main and not r.teaser)
    outside = sum(n for n, r in zip(plain, rows, strict=True) if not r.main)
    if inside and inside >= MAIN_SHARE * outside:
        return " ".join(r.text for r in rows if r.text and r.main)
    lengths = [0 if r.teaser and outside else n for n, r in zip(plain, rows, strict=True)]
    dense = [(a, b) for a, b, p in blocks(lengths) if p >= DENSE] or [(0, len(rows))]
    first, last = dense[0][0], dense[-1][1]
    homes = {rows[i].home for a, b in dense for i in range(a, b) if lengths[i]}

    fine = {r.home for r in rows if len(r.text) >= DENSE and not _rights.search(r.text)}

    def stays(i: int, r: Line) -> bool:
        about_rights = len(r.text) < RIGHTS and r.home not in fine and _rights.search(r.text)
        if about_rights or first <= i < last:
            return not about_rights
        return r.home in homes or r.heading and i < first or bool(_sentence.search(r.text))

    return " ".join(r.text for i, r in enumerate(rows) if lengths[i] and stays(i, r))


def _texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(p) for p in batch], dtype=object)


def text_of(page: Column) -> Column:
    return F.pandas_udf(_texts, T.StringType())(page)


def report(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``; repeated rows each, other columns left out."""
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
