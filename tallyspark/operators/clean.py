"""Cleaning jobs: catalogue (fill, keep-first dedupe, derived amount) and retail
transactions (spelling, duplicates, missing values, mixed date layouts).

Audits are single aggregate passes (no repeated ``count()`` actions).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.rounding import round_money, round_ratio
from tallyspark.functions.text import DATE_FORMATS, clean_text, keyed_int, parse_timestamp, parse_timestamp_multi
from tallyspark.operators.model import first_by_ordinal
from tallyspark.operators.rowkeys import distinct_rows, row_counts
from tallyspark.sources.binding import CATALOG_TEXT_COLUMNS, RETAIL_COLUMNS

# Fill-ins of the catalogue clean-up.
NOT_AVAILABLE = "Not Available"
UNKNOWN_PAYMENT = "Unknown"
LEAN_COLUMNS = ("product_id", "title", "category", "rating", "price", "quantity", "total_amount")


def null_profile(df: DataFrame, columns: Sequence[str], only_present: bool = False) -> DataFrame:
    """Long-form NULL counts: one aggregate pass, then ``stack`` into (column_name, null_count)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
    long = counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")
    long = long.select("column_name", F.col("null_count").cast("bigint"))
    return long.filter(F.col("null_count") > 0) if only_present else long


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column fill; the value is cast to the column's own type (no string '0.0' in a number column)."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(values[c]).cast(df.schema[c].dataType)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


# ----------------------------------------------------------------- catalogue


def catalog_fill(catalog: DataFrame) -> DataFrame:
    return fill_missing(catalog, {"discount": 0.0, **{c: NOT_AVAILABLE for c in CATALOG_TEXT_COLUMNS}})


def catalog_clean(catalog: DataFrame, seed: int = 42) -> DataFrame:
    """Fill gaps, keep the first row per product id, add price/quantity/amount, keep 7 columns."""
    filled = catalog_fill(catalog)
    first = first_by_ordinal(filled, ["product_id"], "ordinal")
    price = F.col("initial_price").cast("double")
    quantity = keyed_int("product_id", 1, 5, seed).cast("int")
    derived = first.select("*", price.alias("price"), quantity.alias("quantity"))
    derived = derived.withColumn("total_amount", F.col("price") * F.col("quantity"))
    return derived.select(*LEAN_COLUMNS)


def catalog_nulls(catalog: DataFrame) -> DataFrame:
    return null_profile(catalog, [c for c in catalog.columns if c != "ordinal"], only_present=True)


def duplicate_count(df: DataFrame, keys: Sequence[str], out: str = "duplicate_count") -> DataFrame:
    """Rows after the first of each key (NULL keys equal each other)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg((F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias(out)).select(
        F.coalesce(F.col(out), F.lit(0).cast("bigint")).alias(out)
    )


def premium(catalog: DataFrame, min_price: float) -> DataFrame:
    return catalog.filter(F.col("initial_price") > F.lit(float(min_price))).drop("ordinal")


# -------------------------------------------------------------------- retail


def retail_rows(retail: DataFrame) -> DataFrame:
    """The file's data columns (the ordinal is bookkeeping only)."""
    return retail.select(*RETAIL_COLUMNS)


def dedupe_on(retail: DataFrame, keys: Sequence[str] = ("customer_id", "purchase_date")) -> DataFrame:
    """Drop rows repeating ``keys``; the survivor is the first in file order (stable across runs).

    The smallest ordinal per key is a hash aggregate over two or three columns; whole rows meet it in a semi-join.
    """
    return first_by_ordinal(retail, list(keys), "row_ordinal").select(*RETAIL_COLUMNS)


def dedupe_counts(retail: DataFrame, keys: Sequence[str] = ("customer_id", "purchase_date")) -> DataFrame:
    """Rows before and after :func:`dedupe_on`, in one pass: rows per key, then their sum and number."""
    per_key = retail.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))


def filter_counts(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before a filter and rows that pass it, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after"))


def with_clean_spelling(df: DataFrame, columns: Sequence[str] = ("region", "category")) -> DataFrame:
    return df.select("*", *[clean_text(c).alias(f"{c}_clean") for c in columns])


def region_category_avg(retail: DataFrame, region: str) -> DataFrame:
    """Mean purchase amount per clean category inside one clean region (6 decimals)."""
    norm = with_clean_spelling(retail)
    return (
        norm.filter(F.col("region_clean") == region)
        .groupBy("category_clean")
        .agg(
            round_ratio(F.sum("purchase_amount"), F.count("purchase_amount"), 6, num_scale=2).alias(
                "average_purchase_amount"
            )
        )
    )


def fill_payment(retail: DataFrame) -> DataFrame:
    filled = fill_missing(retail, {"payment_method": UNKNOWN_PAYMENT})
    return filled.select("transaction_id", "payment_method")


def frequent_values(retail: DataFrame, column: str, min_count: int = 100) -> DataFrame:
    return retail.groupBy(column).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > min_count)


def age_gender(retail: DataFrame, low: int = 18, high: int = 30, gender: str = "F") -> DataFrame:
    hit = retail.filter(F.col("age").between(low, high) & (F.col("gender") == gender))
    return hit.select("transaction_id", "age", "gender")


def parse_report(retail: DataFrame, fmt: str = "yyyy-MM-dd", column: str = "purchase_date") -> DataFrame:
    """How many non-NULL date strings parse with one layout, in one pass."""
    parsed = parse_timestamp(column, fmt)
    return retail.agg(
        F.count(column).alias("non_null"),
        F.count(parsed).alias("parsed_ok"),
    ).select("non_null", "parsed_ok", (F.col("non_null") - F.col("parsed_ok")).alias("failed"))


def parse_multi(retail: DataFrame, formats: Sequence[str] = DATE_FORMATS, column: str = "purchase_date") -> DataFrame:
    return retail.select("transaction_id", parse_timestamp_multi(column, formats).alias("purchase_timestamp"))


def has_contact(include_blank: bool = True) -> Column:
    """Email and customer name are there; without ``include_blank`` empty and white-space names don't count."""
    name = F.col("customer_name")
    there = F.col("email").isNotNull() & name.isNotNull()
    return there if include_blank else there & (F.length(F.trim(name)) > 0) & (F.length(F.trim("email")) > 0)


def valid_contacts(retail: DataFrame, include_blank: bool = True) -> DataFrame:
    return retail.filter(has_contact(include_blank)).select("transaction_id", "email", "customer_name")


def price_stats(retail: DataFrame, column: str = "unit_price") -> DataFrame:
    return retail.agg(
        round_money(F.min(column)).alias("min_unit_price"),
        round_money(F.max(column)).alias("max_unit_price"),
        round_ratio(F.sum(column), F.count(column), 6, num_scale=2).alias("mean_unit_price"),
    )


def region_revenue(retail: DataFrame) -> DataFrame:
    """Exact-duplicate drop, missing amounts as 0, clean region, revenue per region."""
    rows = distinct_rows(retail_rows(retail))
    filled = fill_missing(rows, {"purchase_amount": 0})
    return (
        filled.groupBy(clean_text("region").alias("region_clean"))
        .agg(round_money(F.sum("purchase_amount")).alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "region_clean")
    )


def spelling_audit(retail: DataFrame, columns: Sequence[str] = ("region", "category")) -> DataFrame:
    """Raw spellings behind each clean value, per column (one read: the columns are unpivoted first)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw")) for c in columns])
    raw = retail.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("raw").isNotNull()).distinct()
    return raw.groupBy("column_name", clean_text("raw").alias("clean_value")).agg(F.count(F.lit(1)).alias("raw_spellings"))


def row_audit(retail: DataFrame, id_column: str = "transaction_id") -> DataFrame:
    """Total rows, exact duplicate rows (beyond the first copy) and rows blank except the id."""
    rows = retail_rows(retail)
    others = [c for c in rows.columns if c != id_column]
    return row_counts(rows, F.coalesce(*[F.col(c).cast("string") for c in others]).isNull())


# ------------------------------------------------------------- exploration


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type and non-NULL count (one aggregate pass)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', _n{i}" for i, f in enumerate(df.schema.fields))
    return counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, data_type, non_null)").select(
        "column_name", "data_type", F.col("non_null").cast("bigint")
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 5, last: bool = False) -> DataFrame:
    """First (or last) ``n`` rows in a stated order: a distributed top-k, never a full sort."""
    keys = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    return df.orderBy(*keys).limit(n)


def drop_sparse_rows(df: DataFrame, min_non_null: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least ``min_non_null`` non-NULL values (``na.drop(thresh=...)``)."""
    cols = list(columns) if columns is not None else df.columns
    return df.na.drop(thresh=min_non_null, subset=cols)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``columns`` (``na.drop()``)."""
    return df.na.drop(how="any", subset=list(columns) if columns is not None else None)


def drop_duplicates_any(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``dropDuplicates(subset)``: one row per key, any survivor (use ``keep_first`` for a stable one)."""
    return df.dropDuplicates(list(columns)) if columns is not None else df.dropDuplicates()
