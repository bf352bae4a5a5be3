"""Text, date and keyed-value column helpers (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts met in the retail file, in the order they are tried.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy")
# Spellings pandas' read_csv treats as missing (subset found in retail CSVs).
NULL_TOKENS = ("", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "#N/A", "<NA>", "-NaN", "-nan")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Canonical spelling: trim spaces, then title-case words split at spaces."""
    return F.initcap(F.trim(_col(c)))


def parse_timestamp(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse with one layout; rows in any other layout become NULL (no job failure)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_timestamp_multi(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that parses wins; NULL when none does."""
    return F.coalesce(*[parse_timestamp(c, f) for f in formats])


def null_tokens_to_null(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Treat the usual missing-value spellings of CSV files as NULL (exact match, as pandas does)."""
    col = _col(c)
    return F.when(col.isin(list(tokens)), F.lit(None)).otherwise(col)


def nan_to_null(c: str | Column) -> Column:
    """NaN compares greater than every number in Spark; make it NULL at ingest."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def keyed_int(key: str | Column, low: int, high: int, seed: int = 42) -> Column:
    """Stable pseudo-random integer in [low, high) derived from a key and a seed.

    A pure function of the row's key, so it does not depend on partitioning or
    re-execution (unlike ``rand(seed)``).
    """
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string"))), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % F.lit(high - low)) + F.lit(low)


def year_text(d: str | Column) -> Column:
    return F.date_format(_col(d), "yyyy")


def month_text(d: str | Column) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def quarter_label(d: str | Column) -> Column:
    """Q1..Q4 from the month; as in the reference CASE, anything else (NULL) falls to 'Q4'."""
    m = F.month(_col(d))
    return (
        F.when(m.between(1, 3), "Q1")
        .when(m.between(4, 6), "Q2")
        .when(m.between(7, 9), "Q3")
        .otherwise("Q4")
    )


def parse_us_date(c: str | Column) -> Column:
    """'11/8/2024' or '11/08/2024' (month first) -> DATE; anything else NULL."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit("M/d/yyyy")))


def day_difference(later: str | Column, earlier: str | Column) -> Column:
    """Days between two dates or timestamps; fractional for timestamps (julian-day style)."""
    a, b = _col(later), _col(earlier)
    micros = F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))
    return micros / F.lit(86_400_000_000.0)
