"""The registered views answer SQL; results equal sums over the DataFrames behind them."""

from __future__ import annotations

from collections import defaultdict

import pytest

from tallyspark.plans.views import VIEWS, register_views
from tallyspark.sources import binding

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def lines(spark):
    assert sorted(register_views(spark, SF_SMALL)) == sorted(VIEWS)
    return binding.sales_table(spark, SF_SMALL).collect()


def _sums(lines, key, value):
    out = defaultdict(int)
    for r in lines:
        out[key(r)] += value(r)
    return dict(out)


def test_grouping_sets_over_the_flat_view(spark, lines):
    got = spark.sql("select segment, quantity % 2 as odd, sum(profit) as p from sales group by grouping sets ((segment), (quantity % 2))")
    rows = {(r.segment, r.odd): r.p for r in got.collect()}
    for k, v in _sums(lines, lambda r: r.segment, lambda r: r.profit).items():
        assert rows[(k, None)] == v
    for k, v in _sums(lines, lambda r: r.quantity % 2, lambda r: r.profit).items():
        assert rows[(None, k)] == v


def test_every_view_has_rows(spark, lines):
    for name in VIEWS:
        assert spark.table(name).limit(1).count() == 1, name


def test_star_join_by_view(spark, lines):
    got = spark.sql(
        """select g.state_province as place, max(f.quantity) as most, count(*) as n
           from fact_sales f left join dim_geography g using (geo_key) group by all"""
    )
    want = defaultdict(list)
    for r in lines:
        want[r.state].append(r.quantity)
    assert {r.place: (r.most, r.n) for r in got.collect()} == {k: (max(v), len(v)) for k, v in want.items()}


def test_fact_view_has_dense_ids(spark, lines):
    r = spark.sql("select min(txn_id) lo, max(txn_id) hi, count(distinct txn_id) n from fact_sales").first()
    assert (r.lo, r.hi, r.n) == (1, len(lines), len(lines))
    assert "supp_id" not in spark.table("fact_sales").columns


def test_semi_join_and_filter_clause(spark, lines):
    got = spark.sql(
        """select count(*) filter (where discount > 0.05) as cut, any_value(ship_mode) is not null as seen
           from orders left semi join customers on orders.customer_id = customers.customer_id and customers.segment like 'A%'"""
    ).first()
    assert got.cut == sum(r.discount is not None and float(r.discount) > 0.05 and r.segment.startswith("A") for r in lines)


def test_dashboard_and_calendar_views(spark, lines):
    got = spark.sql("select market_segment, sum(revenue) as s from view_executive_dashboard group by market_segment having s > 0")
    want = _sums(lines, lambda r: r.segment, lambda r: float(r.sales))
    assert {r.market_segment: round(r.s, 2) for r in got.collect()} == {k: round(v, 2) for k, v in want.items()}
    days = spark.sql("select count(*) as n, count(distinct date_key) as d, min(date_key) as lo from dim_calendar").first()
    assert days.n == days.d and days.lo == str(min(r.order_date for r in lines))


def test_views_are_registered_one_by_one(spark):
    assert register_views(spark, SF_SMALL, only=("products",)) == ["products"]
    with pytest.raises(KeyError):
        register_views(spark, SF_SMALL, only=("nothing",))
