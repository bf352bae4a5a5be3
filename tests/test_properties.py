"""Properties that must hold for any input and any partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyspark.operators import clean, model, ordered, reports
from tallyspark.sources import binding, files

from .conftest import SF_SMALL
from .oracle_compare import canon


@pytest.fixture(scope="module")
def sales(spark):
    return binding.sales_table(spark, SF_SMALL)


@pytest.fixture(scope="module")
def retail(spark):
    return binding.retail_dirty(spark, SF_SMALL)


def test_dedupe_is_idempotent(retail):
    once = clean.dedupe_on(retail)
    again = clean.dedupe_on(once.withColumn("row_ordinal", F.lit(0)))
    assert once.count() == again.count()
    rows = clean.retail_rows(retail)
    assert rows.dropDuplicates().count() == rows.dropDuplicates().dropDuplicates().count()


def test_group_sums_add_up(sales):
    total = sales.agg(F.sum("sales")).first()[0]
    by_region = reports.region_summary(sales).agg(F.sum("total_sales")).first()[0]
    assert round(by_region, 2) == round(float(total), 2)
    units = sales.agg(F.sum("quantity")).first()[0]
    assert reports.region_summary(sales).agg(F.sum("units_sold")).first()[0] == units


def test_parse_counts_balance(retail):
    r = clean.parse_report(retail).first()
    assert r.non_null == r.parsed_ok + r.failed
    multi = clean.parse_multi(retail).filter(F.col("purchase_timestamp").isNotNull()).count()
    assert r.parsed_ok <= multi <= r.non_null


def test_running_total_ends_at_grand_total(sales):
    totals = sales.groupBy("customer_id").agg(F.sum("sales").alias("t"))
    run = ordered.running_total(totals, "t", descending=True, out="rt")
    last = run.agg(F.max("rt")).first()[0]
    assert last == totals.agg(F.sum("t")).first()[0]


def test_copy_checksum_equal(spark, tmp_path, sales):
    catalog = clean.catalog_clean(binding.catalog_dirty(spark, SF_SMALL))
    out = str(tmp_path / "lean")
    files.write_delimited(catalog, out)
    back = files.read_delimited(
        spark,
        out,
        schema="product_id bigint, title string, category string, rating int, price double, quantity int, total_amount double",
    )
    assert files.table_fingerprint(back).first() == files.table_fingerprint(catalog).first()


def test_dimension_keys_unique(sales):
    for df, key in ((model.customers(sales), "customer_id"), (model.products(sales), "product_id")):
        assert df.count() == df.select(key).distinct().count()


@pytest.mark.parametrize("parts", [1, 32])
@pytest.mark.parametrize(
    "name", ["q_region_summary", "a_sequence_and_rank", "a_pareto80", "a_rolling3", "n_fact_orders", "r_dedupe_key"]
)
def test_registered_queries_partition_independent(spark, name, parts):
    q = E.queries()[name]
    base = canon(q(spark, SF_SMALL).columns, [tuple(r) for r in q(spark, SF_SMALL).collect()])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = q(spark, SF_SMALL)
        got = canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == base
