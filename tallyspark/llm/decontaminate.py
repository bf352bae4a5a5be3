"""Benchmark decontamination: which documents hold a window of a benchmark item.

A prefix-filtered set join. Every item window is a set of word shingles; shingles are ordered by how often the documents
hold them, rarest first. Full containment needs every shingle of the window, so the prefix that must be shared is the
single rarest one: only that token is joined. Its offset places the window in the document (positional bound), the
window must fit between the document's first and last word (length bound), and the surviving places are compared word
by word with the window.

Only DataFrame functions are used. A window that lacks any of its shingles in the corpus is dropped before the join.
Texts are never shuffled whole for documents without a candidate: a bitmap of the candidates' keys is broadcast, and
only rows that it lets through meet their candidates. Item shingles are broadcast up to ``LISTED`` of them; beyond that a
bitmap of theirs holds back the other shingles of the documents before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import LOWER, UPPER, may_hold, row_key, small, stored

WINDOW = 10
SHINGLE = 3
LISTED = 1_000_000  # item shingles of twelve bytes that are broadcast
PLACED = 2000  # documents of which the candidates, some kilobytes each, are broadcast
# ASCII characters that are neither digits nor letters separate words; A-Z become a-z.
_SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Words of the whole text; null gives an empty array."""
    plain = F.translate(F.coalesce(text, F.lit("")), _SEPARATORS + UPPER, " " * len(_SEPARATORS) + LOWER)
    return F.array_remove(F.split(plain, " "), "")


def _shingle(w: Column, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, i + j) for j in range(size)])


def _places(w: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` words, by position."""
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: _shingle(w, i, size)))


def windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, win, win_len): each item's windows, space-joined; a shorter item is one window.

    Items without words or without an id have none.
    """
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))), lambda i: F.slice(F.col("w"), i + 1, window)
    )
    return (
        items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w"))
        .filter((F.size("w") > 0) & F.col("item_id").isNotNull())
        .select("item_id", F.explode(cut).alias("w"))
        .select("item_id", F.array_join("w", " ").alias("win"), F.size("w").alias("win_len"))
        .distinct()
    )


def _candidates(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, shingle: int) -> DataFrame | None:
    """(k1, k2, cand): per row key the places where a window may begin, by its rarest shingle; None without windows."""
    wins = stored(windows(items, item_col, item_text_col, window))
    distinct = wins.select("win", "win_len").distinct().withColumn("w", F.split("win", " "))
    sizes = sorted(r[0] for r in distinct.select(F.least("win_len", F.lit(shingle))).distinct().collect())

    def tokens(size: int) -> DataFrame:
        return distinct.filter(F.least("win_len", F.lit(shingle)) == size).select(
            "win", "win_len", F.lit(size).alias("size"), F.posexplode(_places(F.col("w"), size)).alias("off", "h")
        )

    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keyed = docs.select(k1.alias("k1"), k2.alias("k2"), words(F.col(text_col)).alias("w"))
    tok = None
    for size in sizes:
        tok = tokens(size) if tok is None else tok.unionByName(tokens(size))
    if tok is None:
        return None
    tok = stored(tok)
    listed = stored(tok.select("size", "h").distinct())
    few = listed.count() <= LISTED
    found = None
    for size in sizes:
        at = keyed.select("k1", "k2", F.size("w").alias("n"), F.posexplode(_places(F.col("w"), size)).alias("pos", "h")).withColumn("size", F.lit(size))
        if few:
            at = at.join(F.broadcast(listed), ["size", "h"], "left_semi")
        else:
            at = may_hold(at, listed, "h").filter("_may").drop("_may").join(listed, ["size", "h"], "left_semi")
        found = at if found is None else found.unionByName(at)
    found = stored(found)
    rarity = found.groupBy("size", "h").count()
    # The rarest token of each window of which all tokens occur somewhere.
    prefix = (
        tok.join(rarity, ["size", "h"])
        .groupBy("win", "win_len", "size")
        .agg(F.count("*").alias("present"), F.min(F.struct("count", "h", "off")).alias("first"))
        .filter(F.col("present") == F.col("win_len") - F.col("size") + 1)
        .select("win", "win_len", "size", "first.h", "first.off")
    )
    return (
        found.join(small(stored(prefix)), ["size", "h"])
        .withColumn("start", F.col("pos") - F.col("off"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("win_len") <= F.col("n")))
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "win_len", "win")).alias("cand"))
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(k1, k2, n_words, n_hit, wins), stored: per row key (``row_key`` of id and text) with a window, its words and windows.

    Null and empty texts have no words and no windows; repeated rows share a key; an empty ``items`` table gives no row.
    """
    cand = _candidates(docs, items, id_col, text_col, item_col, item_text_col, window, shingle)
    if cand is None:
        kinds = "k1 long, k2 long, n_words long, n_hit long, wins array<string>"
        return docs.sparkSession.createDataFrame([], kinds)
    cand = stored(cand)
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    texts = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    near = may_hold(texts, cand, "k1").filter("_may").select("k1", "k2", "text").join(small(cand, PLACED), ["k1", "k2"])
    # The number of words is told too: of a column used once the planner would repeat the split for every candidate.
    checked = near.withColumn("w", words(F.col("text"))).withColumn("n_words", F.size("w")).withColumn(
        "at", F.filter("cand", lambda c: F.array_join(F.slice(F.col("w"), c.start + 1, c.win_len), " ") == c.win)
    )
    runs = F.transform("at", lambda c: F.sequence(c.start, c.start + c.win_len - 1))
    told = checked.select(
        "k1",
        "k2",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(F.array_distinct(F.flatten(runs))).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("at", lambda c: c.win)).alias("wins"),
    )
    # Filtered last: below, the planner would split the text again for every candidate to decide.
    return stored(told.dropDuplicates(["k1", "k2"]).filter("n_hit > 0"))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with all their columns.

    Only rows that a bitmap of the contaminated keys lets through meet those keys in a join.
    """
    bad = occurrences(docs, items, id_col, text_col).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("_k1"), k2.alias("_k2"))
    told = may_hold(rows, bad, "_k1")
    rest = told.filter("_may").drop("_may").join(small(bad), ["_k1", "_k2"], "left_anti")
    return told.filter("NOT _may").select("row.*").unionByName(rest.select("row.*"))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: words, hit words, items with occurring windows, the digest of those items, and the verdict.

    Rows without a window have none of them; columns of other names, whatever they are, are left out.
    """
    found = occurrences(docs, items, id_col, text_col)
    listed = (
        found.select("k1", "k2", F.explode("wins").alias("win"))
        .join(small(windows(items).select("win", "item_id")), "win")
        .select("k1", "k2", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    told = stored(found.select("k1", "k2", "n_hit").join(listed, ["k1", "k2"], "left"))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(small(told), ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(none).cast("long").alias("n_items"),
        F.sha2(F.array_join(none, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
