"""Staging: raw flat sales rows (spaced headers, US text dates, float money)
into the canonical typed ``sales`` layout.

Dates are parsed at load (text dates would sort alphabetically and break
date functions); money becomes DECIMAL so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.rounding import MONEY, RATE
from tallyspark.functions.text import nan_to_null, parse_us_date
from tallyspark.sources.schema import snake_case_columns



def stage_flat_sales(raw: DataFrame) -> DataFrame:
    """Normalise names, parse dates, type the measures; extra columns pass through."""
    df = snake_case_columns(raw)
    typed = {
        "row_id": F.col("row_id").cast("bigint"),
        "order_date": parse_us_date("order_date"),
        "ship_date": parse_us_date("ship_date"),
        "sales": nan_to_null("sales").cast(MONEY),
        "quantity": F.col("quantity").cast("int"),
        "discount": nan_to_null("discount").cast(RATE),
        "profit": nan_to_null("profit").cast(MONEY),
    }
    return df.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns])


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Rows whose non-empty date text did not parse (kept for review, not dropped silently)."""
    df = snake_case_columns(raw)
    bad = (F.col("order_date").isNotNull() & parse_us_date("order_date").isNull()) | (
        F.col("ship_date").isNotNull() & parse_us_date("ship_date").isNull()
    )
    return df.filter(bad)
