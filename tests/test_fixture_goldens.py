"""Library operators on ten invented lines against sums done in plain Python decimals."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import analytics, checks, model, reports

from .conftest import flat_rows

TIE = ["row_id"]
FACT_TIE = ["supp_id"]  # supp_id = row_id in the fixture
LINES = flat_rows()


def rounded(x: Decimal, digits: int = 2) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def by(key, rows=LINES):
    out = defaultdict(list)
    for r in rows:
        out[key(r) if callable(key) else r[key]].append(r)
    return out


def total(rows, c="sales") -> Decimal:
    return sum((r[c] for r in rows), Decimal(0))


def mean(rows, c="sales") -> Decimal:
    return total(rows, c) / len(rows)


TOTALS = {c: total(rows) for c, rows in by("customer_id").items()}
RANKED = sorted(TOTALS, key=lambda c: -TOTALS[c])


@pytest.fixture(scope="module")
def customers(flat10):
    return model.customers(flat10, TIE)


def test_hand_checked_sums():
    """A few sums done by hand, so the Python goldens themselves are pinned."""
    assert total(LINES) == Decimal("1910.75") and total(LINES, "profit") == Decimal("-10.90")
    assert RANKED == ["C3", "C4", "C1", "C6", "C5", "C2"]
    assert TOTALS["C3"] == Decimal("715.75") and TOTALS["C4"] == Decimal("601.50") and TOTALS["C1"] == Decimal("530.50")


def test_ranges(flat10):
    v = reports.value_ranges(flat10).first()
    assert (v.min_sale, v.max_sale, v.min_profit, v.max_profit) == (8.4, 640.75, -210.4, 61.0)
    assert (v.avg_sale, v.avg_profit) == (rounded(mean(LINES)), rounded(mean(LINES, "profit")))


def test_above_mean_lines_and_customers(flat10, customers):
    got = sorted(r.sales for r in analytics.above_mean(flat10).collect())
    assert got == sorted(float(r["sales"]) for r in LINES if r["sales"] > mean(LINES))
    bar = sum(TOTALS.values()) / len(TOTALS)
    named = analytics.customers_above_mean(flat10, customers).collect()
    assert {r.customer_id for r in named} == {c for c, t in TOTALS.items() if t > bar}


def test_ledger_and_ranked_customers(flat10, customers):
    ledger = analytics.master_ledger(flat10, customers).collect()
    assert [(r.strategic_customer_rank, r.lifetime_gross_sales) for r in ledger] == [(i + 1, float(TOTALS[c])) for i, c in enumerate(RANKED)]
    top = analytics.ranked_customers(flat10, customers, 4, True).collect()
    assert sorted((r.rk, r.customer_id) for r in top) == [(i + 1, c) for i, c in enumerate(RANKED[:4])]
    bottom = analytics.ranked_customers(flat10, customers, 2, False).collect()
    assert sorted((r.rk, r.customer_id) for r in bottom) == [(i + 1, c) for i, c in enumerate(RANKED[::-1][:2])]


def test_peak_lines_and_carts(flat10, customers):
    peaks = {(r.customer_id, r.sales) for r in analytics.customer_peak_line(flat10).collect()}
    assert peaks == {(c, float(max(r["sales"] for r in rows))) for c, rows in by("customer_id").items()}
    carts = {r.customer_id: r.peak_historical_order_value for r in analytics.peak_cart(flat10, customers).collect()}
    assert carts == {c: float(t) for c, t in TOTALS.items()}  # one order each
    assert analytics.single_order_customers(flat10, customers).count() == 6


def test_line_rank_with_a_tie_and_sequence(flat10):
    rows = analytics.sequence_and_rank(flat10, TIE).collect()
    values = sorted({r["sales"] for r in LINES}, reverse=True)
    assert sorted((r.sales, r.global_revenue_line_rank) for r in rows) == sorted((float(r["sales"]), values.index(r["sales"]) + 1) for r in LINES)
    # One order date: the line tie-break (row_id) decides.
    assert [s for _, s in sorted((r.internal_order_sequence, r.sales) for r in rows if r.customer_id == "C4")] == [75.0, 14.2, 512.3]


def test_category_margin(flat10):
    got = {r.category: (r.orders, r.total_sales, r.total_profit, r.avg_discount_pct, r.margin_pct) for r in reports.category_margin(flat10).collect()}
    assert got == {
        c: (len(rows), float(total(rows)), float(total(rows, "profit")), rounded(mean(rows, "discount") * 100, 1), rounded(total(rows, "profit") / total(rows) * 100))
        for c, rows in by("category").items()
    }


def _tier(r):
    d = r["discount"]
    return "No discount" if d == 0 else "Low (1-20%)" if d <= Decimal("0.2") else "Medium (21-40%)" if d <= Decimal("0.4") else "High (>40%)"


def test_discount_tiers(flat10):
    got = {r.discount_tier: (r.orders, r.avg_profit, r.total_sales) for r in reports.discount_tiers(flat10).collect()}
    assert got == {t: (len(rows), rounded(mean(rows, "profit")), float(total(rows))) for t, rows in by(_tier).items()}
    assert [r.discount_tier for r in reports.tier_ordered(flat10).collect()] == ["No discount", "Low (1-20%)", "High (>40%)"]


def test_tier_edges_keep_their_scale(spark):
    df = spark.createDataFrame([(Decimal("0.12"),), (Decimal("0.13"),), (None,)], "discount decimal(4,2)")
    got = [r[0] for r in df.select(reports.discount_tier("discount", (0.125, 0.4))).collect()]
    assert got == ["Low (1-12.5%)", "Medium (12.5-40%)", "High (>40%)"]


def test_null_discounts_are_counted_beside_the_tiers(flat10):
    some = flat10.withColumn("discount", F.when(F.col("row_id") > 2, F.col("discount")))
    got = {r.discount_tier: (r.orders, r.null_discounts) for r in reports.discount_tiers(some, count_nulls=True).collect()}
    assert got["High (>40%)"] == (3, 2) and got["No discount"] == (5, 0)


def test_full_price_and_loss(flat10):
    good = [r for r in LINES if r["discount"] == 0 and r["profit"] > 0]
    r = reports.full_price_profit(flat10).first()
    assert (r.orders, r.total_profit) == (len(good), float(total(good, "profit")))
    loss = reports.loss_orders(flat10).first()
    assert (loss.loss_making_orders, loss.total_loss, loss.avg_discount_pct, loss.pct_of_all_orders) == (1, -210.4, 50.0, 10.0)


def test_monthly(flat10):
    got = [(r.month, r.orders, r.monthly_sales, r.monthly_profit) for r in reports.monthly_trend(flat10).collect()]
    months = by(lambda r: f"{r['order_date']:%Y-%m}")
    assert got == [(m, len(rows), float(total(rows)), float(total(rows, "profit"))) for m, rows in sorted(months.items())]


def test_reports_take_column_names(flat10):
    other = flat10.withColumnRenamed("sales", "Umsatz").withColumnRenamed("category", "Gruppe")
    got = reports.category_margin(other, columns={"sales": "Umsatz", "category": "Gruppe"})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, reports.category_margin(flat10).collect()))


def _star(flat10):
    geo = model.dim_geography(flat10)
    return model.fact_sales_unkeyed(flat10, geo), geo


def test_yoy_counts_rows_or_months(flat10):
    fact, _ = _star(flat10)
    assert analytics.yoy_monthly(fact).count() == 0
    # Rows: March, July, November, January. Three rows back from January 2024 is March, two months back is November.
    rows = analytics.yoy_monthly(fact, lag=3).collect()
    assert [(r.yr, r.mo, r.prev_year_rev) for r in rows] == [("2024", "01", float(total(LINES[:3])))]
    whole = analytics.yoy_monthly(fact, lag=2, complete=True).collect()
    assert [(r.yr, r.mo, r.m_rev, r.prev_year_rev) for r in whole] == [("2024", "01", 33.6, 21.0)]


def test_pareto(flat10):
    fact, _ = _star(flat10)
    want, run = [], Decimal(0)
    for c in RANKED:
        run += TOTALS[c]
        if run * 100 <= 80 * total(LINES):
            want.append((c, rounded(run * 100 / total(LINES), 6)))
    for chunk in (1, 2, None):
        got = sorted((r.cumulative_percentage, r.customer_key) for r in analytics.pareto(fact, chunk_rows=chunk).collect())
        assert [(c, v) for v, c in got] == want


def test_rolling_means_across_chunks(flat10):
    fact, _ = _star(flat10)
    want = {}
    for rows in by("customer_id").values():
        ordered = sorted(rows, key=lambda r: (r["order_date"], r["row_id"]))
        for i, r in enumerate(ordered):
            want[(r["customer_id"], float(r["sales"]))] = rounded(mean(ordered[max(0, i - 2) : i + 1]), 6)
    for chunk in (2, 3, None):
        got = {(r.customer_key, r.revenue): r.rolling_3_order_avg for r in analytics.rolling_average(fact, FACT_TIE, 3, chunk_rows=chunk).collect()}
        assert got == want


def test_ship_latency(flat10):
    fact, _ = _star(flat10)
    got = {(r.order_id, r.processing_days, r.efficiency_rating) for r in analytics.ship_latency(fact).collect()}
    rating = lambda d: "Elite Efficiency" if d <= 2 else "Standard" if d <= 5 else "Delayed"
    days = {r["order_id"]: (r["ship_date"] - r["order_date"]).days for r in LINES}
    assert got == {(o, d, rating(d)) for o, d in days.items()}


def test_discount_cannibal_and_hot_places(flat10):
    fact, geo = _star(flat10)
    got = analytics.discount_cannibal(fact, model.dim_products(flat10, TIE), 0.2, 0).collect()
    assert [(r.product_title, r.avg_discount, r.total_impact) for r in got] == [("Wide desk", 0.5, -210.4)]
    places = {p: total(rows, "profit") for p, rows in by("city").items()}
    bar = Decimal("1.5") * sum(places.values()) / len(places)
    assert sorted(r.city_name for r in analytics.hot_geographies(fact, geo, 1.5).collect()) == sorted(p for p, v in places.items() if v > bar)


def test_dims_and_integrity(flat10):
    assert model.customers(flat10, TIE).count() == 6 and model.products(flat10, TIE).count() == 10
    geo = model.dim_geography(flat10)
    assert sorted(r.geo_key for r in geo.collect()) == list(range(1, len({(r["city"], r["state"]) for r in LINES}) + 1))
    dc = flat10.select("customer_id", "customer_name", "segment", "city", "state").distinct()
    dp = flat10.select("product_id", "product_name", "category", "sub_category").distinct()
    res = checks.normalised_model_checks(flat10, model.customers(flat10, TIE), model.products(flat10, TIE), dc, dp)
    assert all(r.violations == 0 for r in res.collect()) and res.count() == 11


def test_conflicting_attributes_keep_the_first_line(flat10):
    moved = flat10.withColumn("city", F.when(F.col("row_id") == 7, F.lit("Moved")).otherwise(F.col("city")))
    assert {r.customer_id: r.city for r in model.customers(moved, TIE).collect()}["C4"] == "Esk"
    late = flat10.withColumn("city", F.when(F.col("row_id") == 6, F.lit("Moved")).otherwise(F.col("city")))
    assert {r.customer_id: r.city for r in model.customers(late, TIE).collect()}["C4"] == "Moved"


def test_orders_row_id_dense(flat10):
    assert sorted(r.row_id for r in model.orders(flat10, TIE).collect()) == list(range(1, 11))


def test_lost_rows_are_counted(spark):
    from tallyspark.sources.binding import lost_rows

    tables = {
        "lineitem": spark.createDataFrame([(1, 1), (2, 1), (9, 1), (None, 7)], "l_orderkey int, l_partkey int"),
        "orders": spark.createDataFrame([(1, 5), (2, 6)], "o_orderkey int, o_custkey int"),
        "part": spark.createDataFrame([(1,)], "p_partkey int"),
        "customer": spark.createDataFrame([(5, 1), (8, None)], "c_custkey int, c_nationkey int"),
        "nation": spark.createDataFrame([(1, 3)], "n_nationkey int, n_regionkey int"),
        "region": spark.createDataFrame([(4,)], "r_regionkey int"),
    }
    got = {(r.table_name, r.key_column): r.lost_rows for r in lost_rows(tables).collect()}
    assert got == {
        ("lineitem", "l_orderkey"): 2,
        ("lineitem", "l_partkey"): 1,
        ("orders", "o_custkey"): 1,
        ("customer", "c_nationkey"): 1,
        ("nation", "n_regionkey"): 1,
    }
