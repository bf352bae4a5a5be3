"""Raw staging rows (spaced headers, MM/DD/YYYY text) load into the canonical layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import text
from tallyspark.operators import clean, reports
from tallyspark.sources.staging import rejected_rows, stage_flat_sales

RAW_SCHEMA = (
    "`Row ID` int, `Order ID` string, `Order Date` string, `Ship Date` string, `Ship Mode` string, "
    "`Customer ID` string, `Sales` double, `Quantity` int, `Discount` double, `Profit` double, `Sub-Category` string"
)


def test_stage_flat_sales(spark):
    raw = spark.createDataFrame(
        [
            (1, "CA-1", "11/8/2024", "11/11/2024", "Second Class", "CG-1", 261.96, 2, 0.0, 41.91, "Bookcases"),
            (2, "CA-2", "12/30/2023", "1/2/2024", "First Class", "CG-1", 10.0, 1, 0.2, float("nan"), "Chairs"),
            (3, "CA-3", "2024-13-01", None, "First Class", "CG-2", 5.0, 1, 0.0, 1.0, "Art"),
        ],
        RAW_SCHEMA,
    )
    staged = stage_flat_sales(raw)
    assert staged.columns[:3] == ["row_id", "order_id", "order_date"] and "sub_category" in staged.columns
    rows = {r.row_id: r for r in staged.collect()}
    assert rows[1].order_date.isoformat() == "2024-11-08" and str(rows[1].sales) == "261.96"
    assert rows[2].profit is None and str(rows[2].discount) == "0.20"
    assert rows[3].order_date is None
    # Text ordering would put 12/30/2023 after 11/8/2024; parsed dates order correctly.
    first = staged.filter(F.col("order_date").isNotNull()).orderBy("order_date").first()
    assert first.order_id == "CA-2"
    assert [r.row_id for r in rejected_rows(raw).collect()] == [3]
    assert reports.date_range(staged).first().first_order.isoformat() == "2023-12-30"


def test_day_difference(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-03 12:00:00")], "a string, b string").select(
        F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b")
    )
    assert df.select(text.day_difference("b", "a").alias("d")).first().d == 2.5


def test_drop_duplicates_any(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert clean.drop_duplicates_any(df, ["k"]).count() == 2
    assert clean.drop_duplicates_any(df).count() == 3


def test_csv_ingest_matches_parquet_path(spark, tmp_path):
    from tallyspark.sources import binding, files

    from .conftest import SF_SMALL

    sales = binding.sales(spark, SF_SMALL)
    raw = sales.select(
        F.col("order_id").cast("string").alias("Order ID"),
        F.date_format("order_date", "M/d/yyyy").alias("Order Date"),
        F.date_format("ship_date", "M/d/yyyy").alias("Ship Date"),
        F.col("region").alias("Region"),
        F.col("sales").cast("double").alias("Sales"),
        F.col("quantity").alias("Quantity"),
        F.col("discount").cast("double").alias("Discount"),
        F.col("profit").cast("double").alias("Profit"),
        F.col("sub_category").alias("Sub-Category"),
    )
    out = str(tmp_path / "flat_sales_csv")
    raw.write.option("header", True).option("encoding", "ISO-8859-1").csv(out)
    schema = (
        "`Order ID` string, `Order Date` string, `Ship Date` string, `Region` string, `Sales` double, "
        "`Quantity` int, `Discount` double, `Profit` double, `Sub-Category` string"
    )
    loaded = stage_flat_sales(files.read_delimited(spark, out, schema=schema, encoding="ISO-8859-1"))
    got = sorted(tuple(r) for r in reports.region_summary(loaded).collect())
    want = sorted(tuple(r) for r in reports.region_summary(sales).collect())
    assert got == want
