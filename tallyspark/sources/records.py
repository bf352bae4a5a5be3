"""Delimited files whose quoted values hold line breaks, read in ranges that run in parallel.

Spark's own scan gives a file with such values to one task, since a line break may lie inside a value. Here the text
scan splits files into ranges of lines as for any text. Every line is a function of the state at its start (between
records, or inside a quoted value) and two expressions tell where it ends from either state. Composed over the lines of
a range they give the range's end states; composed over the ranges of a file they give the state each range begins in.
Then each range emits the records that begin and end in it, and the pieces left at its edges are joined.

* Pass 0 (:func:`shape`): does any line end inside a value? If none does, lines are records and Spark's scan splits them.
* Pass 1: one row per range, its end state from either start; only two flags a line leave the JVM. The state at a range's
  start follows from windows over those rows. Ranges that begin inside a value go to the driver, eight bytes each.
* Pass 2: the pieces at the edges of ranges, two a range at most, joined to the records that cross ranges.
* Pass 3: the records that begin and end in one range, parsed like the joined ones by Spark's CSV expression.

No line is shuffled; a pass keeps one batch and one unfinished record. Rows come in no order, as from any scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Every byte below 128 means the ASCII character in these, so lines and quotes can be told before decoding.
ASCII_LIKE = re.compile(r"(us-)?ascii|utf-?8|iso-?8859-?\d+|latin-?1|windows-?125\d|cp125\d", re.IGNORECASE)
RANGE = "file string, start long, from_out boolean, from_in boolean, closes boolean"
PIECE = "file string, start long, side int, first boolean, text string"


class Shape(NamedTuple):
    """What the lines of a file set look like: lines that end inside a quoted value, blank lines, stray returns."""

    open_lines: int
    blank_lines: int
    stray_returns: int

    @property
    def lines_are_records(self) -> bool:
        return not (self.open_lines or self.blank_lines or self.stray_returns)


def _field(sep: str) -> tuple[str, str, str]:
    """Patterns without backtracking: the rest of a quoted value, what else a field holds, whole fields with separators."""
    other = f"[^{re.escape(sep)}]"
    inside = r'[^"]*+(?:""[^"]*+)*+'
    fields = f'(?:(?:"{inside}"{other}*+|(?!"){other}++)?+{re.escape(sep)})*+'
    return inside, other, fields


def opens(line: Column, sep: str) -> Column:
    """Whether a line that begins between records ends inside a quoted value."""
    inside, _, fields = _field(sep)
    return F.contains(line, F.lit('"')) & line.rlike(rf'\A{fields}"{inside}\z')


def stays_open(line: Column, sep: str) -> Column:
    """Whether a line that begins inside a quoted value ends inside one."""
    inside, other, fields = _field(sep)
    again = rf'"{other}*+{re.escape(sep)}{fields}"{inside}'
    return ~F.contains(line, F.lit('"')) | line.rlike(rf"\A{inside}(?:{again})?+\z")


def _lines(spark: SparkSession, path: str, sep: str, encoding: str) -> DataFrame:
    """(value, file, start, a, b): lines in file order within each range, and where they end from either state."""
    scan = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value") if encoding.upper().replace("-", "") == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    where = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = scan.select(value.alias("value"), *where)
    return lines.select("*", opens(F.col("value"), sep).alias("a"), stays_open(F.col("value"), sep).alias("b"))


def splittable(encoding: str) -> bool:
    return ASCII_LIKE.fullmatch(encoding) is not None


def shape(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> Shape:
    """One scan, one row: see :class:`Shape`."""
    line = F.col("value")
    bare = F.regexp_replace(F.regexp_replace(line, "\r\\z", ""), r'"[^"]*+(?:""[^"]*+)*+"', "")
    row = _lines(spark, path, sep, encoding).agg(
        F.count_if("a"),
        F.count_if((line != "") & line.rlike(r"\A[\x00-\x20]*+\z") & (line != "\r")),
        F.count_if(F.contains(line, F.lit("\r")) & F.contains(bare, F.lit("\r"))),
    )
    return Shape(*row.first())


# ------------------------------------------------------------------ states of lines


def states(a: np.ndarray, b: np.ndarray, start: bool) -> np.ndarray:
    """State after each line: ``a`` from outside, ``b`` from inside (True: inside)."""
    flips = np.cumsum(a & ~b) & 1
    last = np.maximum.accumulate(np.where(a == b, np.arange(len(a)), -1))
    known = np.maximum(last, 0)
    return np.where(last >= 0, a[known] ^ (flips ^ flips[known]).astype(bool), start ^ flips.astype(bool))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.RecordBatch]]:
    """(file, start, whether its range begins here, lines of one range) of each batch."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column("start").to_numpy()
        file = batch.column("file").dictionary_encode()
        code = file.indices.to_numpy()
        cut = np.flatnonzero((start[1:] != start[:-1]) | (code[1:] != code[:-1])) + 1
        for i, j in zip([0, *cut], [*cut, len(start)], strict=True):
            key = (file.dictionary[code[i]].as_py(), int(start[i]))
            yield *key, key != before, batch.slice(i, j - i)
            before = key


def _bools(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of ``RANGE`` per range."""
    rows: list[list] = []
    for file, start, new, part in _segments(batches):
        if new:
            rows.append([file, start, False, True, False])
        a, b = _bools(part)
        out, inn = (states(a, b, rows[-1][i]) for i in (2, 3))
        rows[-1][2:] = [bool(out[-1]), bool(inn[-1]), rows[-1][4] or not inn.all()]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in RANGE.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _placed(ranges: DataFrame) -> DataFrame:
    """Each range with the state it begins and ends in, and the number of the record left open at its end."""
    before = Window.partitionBy("file").orderBy("start")
    fixed = F.col("from_out") == F.col("from_in")
    df = ranges.withColumn("block", F.count_if(fixed).over(before))
    in_block = Window.partitionBy("file", "block").orderBy("start")
    flip = F.when(~fixed & F.col("from_out"), 1).otherwise(0)
    base = F.coalesce(F.max(F.when(fixed, F.col("from_out").cast("int"))).over(in_block), F.lit(0))
    df = df.withColumn("ends", (base + F.sum(flip).over(in_block)) % 2 == 1)
    df = df.withColumn("begins", F.coalesce(F.lag("ends").over(before), F.lit(False)))
    # A record is left open by a range that ends inside it, unless the whole range lies in one that was open before.
    left = F.col("ends") & (~F.col("begins") | F.col("closes"))
    return df.withColumn("left", left).withColumn("number", F.count_if("left").over(before))


def _crossing(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(value): records over several ranges, joined from their pieces, without the first of a file if that is its header."""
    number = F.col("number") - ((F.col("side") == 0) & F.col("left")).cast("int")
    rows = pieces.join(placed.select("file", "start", "number", "left"), ["file", "start"])
    rows = rows.select("file", number.alias("number"), "first", F.struct("start", "side", "text").alias("piece"))
    joined = rows.groupBy("file", "number").agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.max("first").alias("first"))
    return joined.filter("NOT first").select(F.concat_ws("\n", F.col("pieces")["text"]).alias("value"))


def _walk(batches: Iterator[pa.RecordBatch], begins: dict[str, np.ndarray], header: bool) -> Iterator[tuple]:
    """What the ranges hold: (False, records of one range as an array), (True, piece at an edge as a row of ``PIECE``).

    With ``header`` the first record that begins in a file's first range and isn't blank is left out, or told as first.
    """
    left: list[str] = []
    inside = skipping = pending = False
    here = ("", 0)

    for file, start, new, part in _segments(batches):
        if new:
            if left:
                yield True, (*here, 0 if skipping else 1, pending, "\n".join(left))
            inside = skipping = bool(np.isin(start, begins.get(file, ())))
            left, here, pending = [], (file, start), header and start == 0
        value = part.column("value")
        a, b = _bools(part)
        after = states(a, b, inside)
        before = np.concatenate([[inside], after[:-1]])
        inside = bool(after[-1])
        ends = np.flatnonzero(~after)
        texts: list[str] = []
        dropped = -1
        if pending:  # the first line that isn't blank begins the header
            for i in ends.tolist():
                if before[i] or value[i].as_py().strip("\r"):
                    dropped, pending = i, False
                    break
        alone = np.flatnonzero(~before & ~after)
        alone = alone[alone != dropped]
        if len(alone):
            yield False, value.take(pa.array(alone)).cast(pa.string())
        for i in np.flatnonzero(before | after).tolist():
            left.append(value[i].as_py())
            if not after[i]:
                if skipping:
                    yield True, (*here, 0, False, "\n".join(left))
                elif i != dropped:
                    texts.append("\n".join(left))
                left, skipping = [], False
        if texts:
            yield False, pa.array(texts, pa.string())
    if left:
        yield True, (*here, 0 if skipping else 1, pending, "\n".join(left))


def _whole(batches: Iterator[pa.RecordBatch], begins: dict[str, np.ndarray], header: bool) -> Iterator[pa.RecordBatch]:
    for edge, values in _walk(batches, begins, header):
        if not edge:
            yield pa.RecordBatch.from_arrays([values], ["value"])


def _pieces(batches: Iterator[pa.RecordBatch], begins: dict[str, np.ndarray], header: bool) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("file", pa.string()), ("start", pa.int64()), ("side", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])
    for edge, piece in _walk(batches, begins, header):
        if edge:
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, piece, strict=True))], schema=kinds)


def read_records(
    spark: SparkSession,
    path: str,
    schema: StructType,
    options: dict[str, str],
    store: Callable[[DataFrame], DataFrame],
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    mode: str = "FAILFAST",
) -> DataFrame:
    """The table in the files under ``path``; ``store`` writes the rows of ranges and edges and reads them back."""
    lines = _lines(spark, path, sep, encoding)
    placed = store(_placed(lines.mapInArrow(_summaries, RANGE)))
    starts = placed.filter("begins").groupBy("file").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    begins = {r["file"]: np.array(r["starts"]) for r in starts.collect()}
    pieces = store(lines.mapInArrow(partial(_pieces, begins=begins, header=header), PIECE))
    whole = lines.mapInArrow(partial(_whole, begins=begins, header=header), "value string")
    records = whole.unionByName(_crossing(pieces, placed))
    # Files with CR LF line ends are read as if they had LF ones, inside values too, as Spark's own reader does. A record
    # tells by its end; only a last record without a line end keeps what it has.
    plain = F.regexp_replace(F.regexp_replace("value", "\r\\z", ""), "\r\n", "\n")
    records = records.select(F.when(F.endswith("value", F.lit("\r")), plain).otherwise(F.col("value")).alias("value")).filter("value <> ''")
    given = {k: v for k, v in options.items() if k not in ("header", "multiLine")} | {"sep": sep, "mode": mode}
    return records.select(F.from_csv("value", schema.toDDL(), given).alias("r")).select("r.*")
