"""One test per semantic trap: NULL in CASE, zero divisors, NaN, ties, text, dates, fill types."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import rounding, text
from tallyspark.operators import clean, reports


def _one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_case_null_falls_to_else(spark):
    assert _one(spark, reports.discount_tier(F.col("x")), "x decimal(4,2)") == "High (>40%)"
    assert _one(spark, text.quarter_label(F.col("x")), "x date") == "Q4"
    # Inclusive edges, negative discount is 'Low'.
    df = spark.createDataFrame([("0.20",), ("0.40",), ("-0.05",), ("0",)], "x string").select(F.col("x").cast("decimal(4,2)").alias("x"))
    got = [r.t for r in df.select(reports.discount_tier("x").alias("t")).collect()]
    assert got == ["Low (1-20%)", "Medium (21-40%)", "Low (1-20%)", "No discount"]


def test_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(5, 0)], "a long, b long")
    assert df.select(rounding.round_ratio(F.col("a"), F.col("b"), 2).alias("r")).first().r is None


@settings(max_examples=40, deadline=None)
@given(st.integers(-10**12, 10**12), st.integers(1, 10**6), st.integers(0, 6))
def test_round_ratio_half_away_from_zero(spark, a, b, digits):
    got = spark.createDataFrame([(a, b)], "a long, b long").select(rounding.round_ratio(F.col("a"), F.col("b"), digits).alias("r")).first().r
    q = Decimal(abs(a)) / Decimal(b)
    want = q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
    want = float(-want if a < 0 else want) + 0.0
    assert got == want


def test_nan_is_null_at_ingest(spark):
    df = spark.createDataFrame([(float("nan"),), (6000.0,)], "p double")
    # Raw Spark: NaN > 5000 is TRUE; after ingest it is NULL and filtered out.
    assert df.filter(F.col("p") > 5000).count() == 2
    assert df.select(text.nan_to_null("p").alias("p")).filter(F.col("p") > 5000).count() == 1


def test_text_cleaning(spark):
    df = spark.createDataFrame([("  home-decor ",), ("WEST",), (" x  y ",), ("\tab",)], "x string")
    got = [r.c for r in df.select(text.clean_text("x").alias("c")).collect()]
    assert got == ["Home-decor", "West", "X  Y", "\tab"]


@pytest.mark.parametrize(
    "raw,expected",
    [("2021-08-28", "2021-08-28"), ("28/08/2021", "2021-08-28"), ("08-28-2021", "2021-08-28"), ("28-08-2021", None), ("garbage", None)],
)
def test_multi_format_dates(spark, raw, expected):
    got = _one(spark, text.parse_timestamp_multi(F.col("x")), value=raw)
    assert (got.date().isoformat() if got else None) == expected


def test_single_digit_day_needs_its_own_layout(spark):
    assert _one(spark, text.parse_timestamp(F.col("x"), "dd/MM/yyyy"), value="4/1/2022") is None
    assert _one(spark, text.parse_timestamp(F.col("x"), "d/M/yyyy"), value="4/1/2022").date().isoformat() == "2022-01-04"


def test_fill_keeps_column_type(spark):
    df = spark.createDataFrame([(None, None)], "amount decimal(18,2), method string")
    out = clean.fill_missing(df, {"amount": 0.0, "method": "Unknown"})
    assert dict(out.dtypes)["amount"] == "decimal(18,2)"
    r = out.first()
    assert (r.amount, r.method) == (Decimal("0.00"), "Unknown")


def test_keyed_int_is_stable_and_in_range(spark):
    df = spark.range(2000).select(text.keyed_int("id", 1, 5).alias("q"))
    vals = {r.q for r in df.collect()}
    assert vals == {1, 2, 3, 4}
    again = spark.range(2000).repartition(7).select(text.keyed_int("id", 1, 5).alias("q")).groupBy("q").count()
    first = df.groupBy("q").count()
    assert sorted(again.collect()) == sorted(first.collect())


def test_keep_first_is_file_order(spark):
    df = spark.createDataFrame(
        [(3, "C1", "2021-01-01", "later"), (1, "C1", "2021-01-01", "first"), (2, None, None, "a"), (5, None, None, "b")],
        "row_ordinal long, customer_id string, purchase_date string, email string",
    )
    from tallyspark.operators.model import keep_first

    got = keep_first(df, ["customer_id", "purchase_date"], ["row_ordinal"], df.columns).orderBy("row_ordinal").collect()
    assert [r.email for r in got] == ["first", "a"]


def test_null_tokens(spark, tmp_path):
    from tallyspark.sources.files import read_delimited

    p = tmp_path / "t.csv"
    p.write_text('id,v\n1,NA\n2,null\n3,N/A\n4,ok\n5,\n6," NA"\n')
    got = read_delimited(spark, str(p), schema="id int, v string").orderBy("id").collect()
    assert [r.v for r in got] == [None, None, None, "ok", None, " NA"]


def test_foreign_key_counts_orphan_rows_not_nulls(spark):
    from tallyspark.operators import checks

    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,), (5,), (5,)], "k int")
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    assert checks.foreign_key(child, parent, "k", "k", "t").first().violations == 4


def test_check_rules_null_is_not_a_violation(spark):
    from tallyspark.operators import checks

    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "sales double")
    got = checks.row_rules(df, {"check:sales>=0": F.col("sales") >= 0}, "orders").first()
    assert got.violations == 1
