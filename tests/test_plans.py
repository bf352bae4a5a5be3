"""Physical-plan properties of the registered queries (read from ``explain``)."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from tallyspark.plans.registry import QUERIES

from .conftest import SF_SMALL


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "extended")
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_year_filter_bounds_reach_the_scan(spark):
    text = plan(QUERIES["q_year_filter"](spark, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(order_date," in pushed and "LessThan(order_date," in pushed
    assert re.search(r"ReadSchema: struct<order_date:date,sales:decimal\(18,2\)>", text)


def test_report_reads_only_needed_columns(spark):
    text = plan(QUERIES["q_region_summary"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert sorted(re.findall(r"(\w+):", schema)) == ["profit", "quantity", "region", "sales"]


@pytest.mark.parametrize("name", ["q_top_products", "q_high_value", "q_duplicate_lines", "c_catalog_head"])
def test_top_k_without_global_sort(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert "TakeOrderedAndProject" in text


def test_correlated_max_is_aggregate_plus_semi_join(spark):
    text = plan(QUERIES["a_customer_peak_line"](spark, SF_SMALL), "simple")
    assert "Window" not in text and "LeftSemi" in text


@pytest.mark.parametrize("name", ["r_dedupe_key", "c_catalog_clean"])
def test_first_by_ordinal_is_a_hash_aggregate_and_a_semi_join(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert "SortAggregate" not in text and "Window" not in text and "LeftSemi" in text


@pytest.mark.parametrize("name", ["n_dim_customer", "n_dim_product", "n_dim_customer_star", "n_dim_product_star"])
def test_dimensions_sort_conflicting_keys_only(spark, name):
    """The ordered pick stands above a semi-join with the keys that have several attribute sets."""
    text = plan(QUERIES[name](spark, SF_SMALL), "simple").split("== Initial Plan ==")[0]
    pick = text[text.index("partial_min_by") :]
    assert "LeftSemi" in pick


NAMED = "a_customers_above_mean a_master_ledger a_top5_customers a_single_order_customers a_peak_cart v_executive".split()


@pytest.mark.parametrize("name", NAMED)
def test_joined_dimensions_are_read_not_rebuilt(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert "min_by" not in text and "SortAggregate" not in text


def test_grand_totals_are_scalar_subqueries(spark):
    for name in ("a_above_mean", "a_pareto80", "a_customers_above_mean"):
        text = plan(QUERIES[name](spark, SF_SMALL), "simple")
        assert "Subquery" in text


ORDERING = "a_sequence_and_rank a_master_ledger a_rolling3 a_pareto80 n_fact_orders n_fact_sales n_dim_geography".split()


@pytest.mark.parametrize("name", ORDERING)
def test_windows_over_rows_are_partitioned_by_chunk(spark, name):
    """A window without partition keys stands over offset tables only (one row per chunk or sort partition)."""
    text = plan(QUERIES[name](spark, SF_SMALL), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line):
            spec = re.findall(r"windowspecdefinition\((.*?),? ?specifiedwindowframe", line)
            assert spec and all("_chunk" in x or "_pid" in x or x == "" for x in spec), line


def test_sales_build_shuffles_narrow_lines_and_writes_from_the_last_join(spark):
    from tallyspark.sources import binding

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(binding.sales(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(l_(?:order|part)key", text)
    assert len(shuffled) == 2
    assert not any(c in s for s in shuffled for c in ("p_name", "n_name", "r_name"))
    options = binding._sales_options(spark, SF_SMALL)
    assert not options.get("range_by") and options["sort_within"][0] == options["partition_by"][0]


@pytest.mark.parametrize("few", [True, False])
def test_dimension_lines_are_not_shuffled_for_a_few_conflicting_keys(spark, monkeypatch, few):
    from tallyspark.operators import model

    rows = [(k, f"n{k if i < 2 or k % 7 else i}", i) for k in range(50) for i in range(4)] + [(None, "x", 9), (None, "w", 8)]
    df = spark.createDataFrame(rows, "k long, name string, line long")
    if not few:
        monkeypatch.setattr(model, "BROADCAST_KEYS", 1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.keep_first(df, ["k"], ["line"], ["k", "name"])
        text = plan(out, "simple")
        got = {tuple(r) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    pick = text[text.index("partial_min_by") :]
    assert re.search(r"(\w+) \[.*LeftSemi", pick)[1] == ("BroadcastHashJoin" if few else "SortMergeJoin")
    assert got == {(k, f"n{k}") for k in range(50)} | {(None, "w")}
