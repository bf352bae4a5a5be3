"""Declared layouts, column-name normalising, insert-by-name with defaults, SQL views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.plans.views import register_views
from tallyspark.sources import schema

from .conftest import SF_SMALL


def test_snake_case_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`Row ID` int, `Customer Name` string, `Sub-Category` string")
    assert schema.snake_case_columns(df).columns == ["row_id", "customer_name", "sub_category"]


def test_align_to_fills_defaults_and_casts(spark):
    df = spark.createDataFrame([("C1", "Ann", "Consumer", "extra")], "customer_key string, customer_name string, market_segment string, junk string")
    out = schema.align_to(df, schema.DIM_CUSTOMERS, {"loyalty_tier": F.lit("Standard"), "created_at": F.lit("2024-01-01").cast("timestamp_ntz")})
    assert out.columns == [f.name for f in schema.layout(schema.DIM_CUSTOMERS).fields]
    r = out.first()
    assert (r.loyalty_tier, r.created_at.year) == ("Standard", 2024)


def test_append_by_name(spark, tmp_path):
    path = str(tmp_path / "dim_products")
    df = spark.createDataFrame([("P1", "Pen")], "product_key string, product_title string")
    schema.append_by_name(df, path, schema.DIM_PRODUCTS, schema.star_defaults("dim_products"))
    schema.append_by_name(df, path, schema.DIM_PRODUCTS, schema.star_defaults("dim_products"))
    back = spark.read.parquet(path).collect()
    assert len(back) == 2 and all(r.is_active and r.unit_cost is None for r in back)


def test_views_answer_sql(spark):
    names = register_views(spark, SF_SMALL)
    assert "view_executive_dashboard" in names
    n_view = spark.sql("SELECT COUNT(*) AS n FROM view_executive_dashboard").first().n
    n_lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert n_view == n_lines
    # Spark SQL accepts HAVING on a select alias (the source relies on it).
    top = spark.sql(
        "SELECT category, AVG(discount) AS avg_discount FROM sales GROUP BY category HAVING avg_discount >= 0 ORDER BY category"
    ).collect()
    assert len(top) == 6
    ids = spark.sql("SELECT MIN(row_id) AS lo, MAX(row_id) AS hi, COUNT(*) AS n FROM orders").first()
    assert (ids.lo, ids.hi) == (1, ids.n)


def test_a_null_key_fails_the_insert_and_leaves_nothing(spark, tmp_path):
    import pytest

    from tallyspark.sources import schema

    path = str(tmp_path / "t")
    ddl = "k BIGINT NOT NULL, v STRING"
    schema.append_by_name(spark.createDataFrame([(1, "a")], "k long, v string"), path, ddl)
    with pytest.raises(Exception, match="NULL in NOT NULL column k"):
        schema.append_by_name(spark.createDataFrame([(None, "b"), (2, "c")], "k long, v string"), path, ddl)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]
