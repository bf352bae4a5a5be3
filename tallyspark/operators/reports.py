"""Sales reports over the flat ``sales`` table (filters, group summaries, top-k, quality).

Every function is ``f(sales, **params) -> DataFrame``; ``columns`` maps the
names used here to those of another table (``columns={"sales": "Amount"}``).
"orders" counts order
lines (rows), as in the source reports; distinct orders are named as such.
Money sums are exact decimals rounded at the end; averages and ratios use
exact integer rounding (``tallyspark.functions.rounding``).
"""

from __future__ import annotations

import functools
import inspect
import sys
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.rounding import avg_round, round_money, round_ratio
from tallyspark.functions.text import month_text, quarter_label, year_text

# Discount tier edges and labels of the source report (hyphen spelling).
DEFAULT_TIER_EDGES = (0.20, 0.40)
TIER_NO_DISCOUNT = "No discount"


def _lines() -> Column:
    return F.count(F.lit(1))


def _sum_money(c: str) -> Column:
    return round_money(F.sum(c))


def _percent(edge: float) -> Decimal:
    p = Decimal(str(edge)) * 100
    return p.quantize(Decimal(1)) if p == p.to_integral_value() else p.normalize()


def tier_labels(edges: Sequence[float] = DEFAULT_TIER_EDGES) -> list[str]:
    """Tier labels in business order, e.g. 'Low (1-20%)', 'Medium (21-40%)', 'High (>40%)'.

    An edge with a fraction of a percent begins the next tier at itself: 'Medium (12.5-40%)'.
    """
    low, high = (_percent(e) for e in edges)
    begin = low + 1 if low == low.to_integral_value() else low
    return [TIER_NO_DISCOUNT, f"Low (1-{low}%)", f"Medium ({begin}-{high}%)", f"High (>{high}%)"]


def discount_tier(discount: str | Column, edges: Sequence[float] = DEFAULT_TIER_EDGES) -> Column:
    """CASE tiering; edges inclusive and as exact as given; NULL (and anything above) falls to the last tier."""
    d = F.col(discount) if isinstance(discount, str) else discount
    labels = tier_labels(edges)
    e1, e2 = (F.lit(Decimal(str(e))) for e in edges)
    return (
        F.when(d == F.lit(0), labels[0])
        .when(d <= e1, labels[1])
        .when(d <= e2, labels[2])
        .otherwise(labels[3])
    )


def distinct_profile(sales: DataFrame) -> DataFrame:
    """Distinct values per column, and rows, in one scan.

    Each line gives its (column, value) pairs, which are counted per pair before the shuffle, so what is shuffled are
    distinct pairs per task.
    """
    names = {
        "customer_id": "unique_customers",
        "order_id": "unique_orders",
        "product_id": "unique_products",
        "region": "regions",
        "category": "categories",
        "state": "states",
    }
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(names)])
    per_value = sales.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.v").agg(_lines().alias("n"))
    found = [F.count_if((F.col("i") == i) & F.col("v").isNotNull()).alias(out) for i, out in enumerate(names.values())]
    return per_value.agg(*found, F.coalesce(F.sum(F.when(F.col("i") == 0, F.col("n"))), F.lit(0)).alias("total_rows"))


def date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))


def region_filter(sales: DataFrame, region: str) -> DataFrame:
    return (
        sales.filter(F.col("region") == region)
        .groupBy("region")
        .agg(_lines().alias("orders"), _sum_money("sales").alias("total_sales"))
    )


def category_filter(sales: DataFrame, category: str) -> DataFrame:
    return (
        sales.filter(F.col("category") == category)
        .groupBy("category")
        .agg(_lines().alias("orders"), _sum_money("sales").alias("total_sales"), avg_round(F.col("sales"), 2, 2).alias("avg_sale"))
    )


def year_filter(sales: DataFrame, year: int) -> DataFrame:
    # A half-open date range (not year(d) = y) so the bounds reach the scan as pushed filters.
    start, end = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    if "order_year" in sales.columns:  # a table kept in folders by year: one of them is listed and read
        sales = sales.filter(F.col("order_year") == year)
    return (
        sales.filter((F.col("order_date") >= start) & (F.col("order_date") < end))
        .groupBy(year_text("order_date").alias("year"))
        .agg(_lines().alias("orders"), _sum_money("sales").alias("total_sales"))
    )


def high_value(sales: DataFrame, min_sales: float, k: int, tiebreak: Sequence[str]) -> DataFrame:
    top = sales.filter(F.col("sales") > F.lit(Decimal(str(min_sales)))).orderBy(
        F.col("sales").desc(), *[F.col(c).asc() for c in tiebreak]
    )
    return top.limit(k).select(
        "customer_name",
        "product_name",
        F.col("sales").cast("double").alias("sales"),
        F.col("profit").cast("double").alias("profit"),
        "region",
    )


def full_price_profit(sales: DataFrame) -> DataFrame:
    return sales.filter((F.col("discount") == 0) & (F.col("profit") > 0)).agg(
        _lines().alias("orders"), _sum_money("profit").alias("total_profit")
    )


def region_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("region")
        .agg(
            _lines().alias("orders"),
            _sum_money("sales").alias("total_sales"),
            _sum_money("profit").alias("total_profit"),
            avg_round(F.col("sales"), 2, 2).alias("avg_order_value"),
            F.sum("quantity").cast("bigint").alias("units_sold"),
        )
        .orderBy(F.col("total_sales").desc(), "region")
    )


def _margin(digits: int) -> Column:
    # sum(profit)/sum(sales)*100; both sums carry 2 decimals.
    return round_ratio(F.sum("profit"), F.sum("sales"), digits, num_scale=2, den_scale=2, mult=100)


def category_margin(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(
            _lines().alias("orders"),
            _sum_money("sales").alias("total_sales"),
            _sum_money("profit").alias("total_profit"),
            round_ratio(F.sum("discount"), F.count("discount"), 1, num_scale=2, mult=100).alias("avg_discount_pct"),
            _margin(2).alias("margin_pct"),
        )
        .orderBy(F.col("total_sales").desc(), "category")
    )


def segment_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("segment")
        .agg(
            _lines().alias("orders"),
            _sum_money("sales").alias("total_sales"),
            _sum_money("profit").alias("total_profit"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.col("total_sales").desc(), "segment")
    )


def ship_mode_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ship_mode")
        .agg(
            _lines().alias("orders"),
            avg_round(F.col("sales"), 2, 2).alias("avg_sale"),
            avg_round(F.col("quantity"), 2, 0).alias("avg_quantity"),
            _sum_money("sales").alias("total_sales"),
        )
        .orderBy(F.col("total_sales").desc(), "ship_mode")
    )


def _top(df: DataFrame, by: str, keys: Sequence[str], k: int) -> DataFrame:
    # orderBy + limit plans as TakeOrderedAndProject: per-partition top-k, then a k*P merge.
    return df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    agg = sales.groupBy("product_name", "category").agg(
        _lines().alias("times_ordered"),
        F.sum("quantity").cast("bigint").alias("units_sold"),
        _sum_money("sales").alias("revenue"),
        _sum_money("profit").alias("profit"),
    )
    return _top(agg, "revenue", ["product_name", "category"], k)


def top_subcategories(sales: DataFrame, k: int = 10) -> DataFrame:
    agg = sales.groupBy("sub_category", "category").agg(
        _lines().alias("orders"),
        _sum_money("sales").alias("total_sales"),
        _sum_money("profit").alias("total_profit"),
        _margin(1).alias("margin_pct"),
    )
    return _top(agg, "total_sales", ["sub_category", "category"], k)


def top_customers(sales: DataFrame, k: int = 10) -> DataFrame:
    agg = sales.groupBy("customer_name", "segment", "region").agg(
        F.countDistinct("order_id").alias("orders"),
        _sum_money("sales").alias("lifetime_value"),
        _sum_money("profit").alias("total_profit"),
        avg_round(F.col("sales"), 2, 2).alias("avg_order_value"),
    )
    return _top(agg, "lifetime_value", ["customer_name", "segment", "region"], k)


def top_states(sales: DataFrame, k: int = 10) -> DataFrame:
    agg = sales.groupBy("state", "region").agg(
        _lines().alias("orders"), _sum_money("sales").alias("total_sales"), _sum_money("profit").alias("total_profit")
    )
    return _top(agg, "total_sales", ["state", "region"], k)


def monthly_trend(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_text("order_date").alias("month"))
        .agg(
            _lines().alias("orders"),
            _sum_money("sales").alias("monthly_sales"),
            _sum_money("profit").alias("monthly_profit"),
            avg_round(F.col("sales"), 2, 2).alias("avg_order_value"),
        )
        .orderBy("month")
    )


def yearly_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(year_text("order_date").alias("year"))
        .agg(
            _lines().alias("orders"),
            _sum_money("sales").alias("annual_sales"),
            _sum_money("profit").alias("annual_profit"),
            F.countDistinct("customer_id").alias("customers"),
        )
        .orderBy("year")
    )


def quarter_category(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(year_text("order_date").alias("year"), quarter_label("order_date").alias("quarter"), "category")
        .agg(_sum_money("sales").alias("sales"))
        .orderBy("year", "quarter", "category")
    )


def discount_tiers(sales: DataFrame, edges: Sequence[float] = DEFAULT_TIER_EDGES, count_nulls: bool = False) -> DataFrame:
    """Lines, mean profit and sales per tier; ``count_nulls`` adds how many lines of the last tier have no discount value."""
    nulls = [F.count_if(F.col("discount").isNull()).alias("null_discounts")] if count_nulls else []
    return (
        sales.groupBy(discount_tier("discount", edges).alias("discount_tier"))
        .agg(
            _lines().alias("orders"),
            avg_round(F.col("profit"), 2, 2).alias("avg_profit"),
            _sum_money("sales").alias("total_sales"),
            *nulls,
        )
        .orderBy(F.col("avg_profit").desc(), "discount_tier")
    )


def tier_ordered(sales: DataFrame, edges: Sequence[float] = DEFAULT_TIER_EDGES) -> DataFrame:
    """Discount tiers in business order (No discount, Low, Medium, High), not by label text."""
    labels = tier_labels(edges)
    rank = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("discount_tier")).cast("bigint")
    return discount_tiers(sales, edges).withColumn("tier_rank", rank).orderBy("tier_rank")


def null_counts(sales: DataFrame) -> DataFrame:
    def nulls(c: str) -> Column:
        return F.count_if(F.col(c).isNull())

    return sales.agg(
        nulls("customer_id").alias("null_customer_id"),
        nulls("sales").alias("null_sales"),
        nulls("order_date").alias("null_order_date"),
        nulls("region").alias("null_region"),
        nulls("category").alias("null_category"),
    )


def duplicate_lines(sales: DataFrame, k: int = 5) -> DataFrame:
    keys = ["order_id", "customer_id", "product_id"]
    agg = sales.groupBy(*keys).agg(_lines().alias("occurrences")).filter(F.col("occurrences") > 1)
    return _top(agg, "occurrences", keys, k)


def loss_orders(sales: DataFrame) -> DataFrame:
    """Loss-making lines and their share of all lines, in one pass (conditional aggregates)."""
    loss = F.col("profit") < 0
    agg = sales.agg(
        F.count_if(loss).alias("loss_making_orders"),
        F.sum(F.when(loss, F.col("profit"))).alias("_loss"),
        F.sum(F.when(loss, F.col("discount"))).alias("_disc"),
        F.count(F.when(loss, F.col("discount"))).alias("_ndisc"),
        F.count(F.lit(1)).alias("_all"),
    )
    return agg.select(
        "loss_making_orders",
        round_money(F.col("_loss")).alias("total_loss"),
        round_ratio(F.col("_disc"), F.col("_ndisc"), 1, num_scale=2, mult=100).alias("avg_discount_pct"),
        round_ratio(F.col("loss_making_orders"), F.col("_all"), 1, mult=100).alias("pct_of_all_orders"),
    )


def value_ranges(sales: DataFrame) -> DataFrame:
    return sales.agg(
        round_money(F.min("sales")).alias("min_sale"),
        round_money(F.max("sales")).alias("max_sale"),
        avg_round(F.col("sales"), 2, 2).alias("avg_sale"),
        round_money(F.min("profit")).alias("min_profit"),
        round_money(F.max("profit")).alias("max_profit"),
        avg_round(F.col("profit"), 2, 2).alias("avg_profit"),
    )


def category_share(sales: DataFrame) -> DataFrame:
    """Revenue share per category in percent (one decimal); the window runs on the grouped rows."""
    per = sales.groupBy("category").agg(F.sum("sales").alias("_s"))
    # The total comes from the group rows: one row per category in the window.
    return (
        per.withColumn("_t", F.sum("_s").over(Window.partitionBy()))
        .select(
            "category",
            round_money(F.col("_s")).alias("total_sales"),
            round_ratio(F.col("_s"), F.col("_t"), 1, num_scale=2, den_scale=2, mult=100).alias("share_pct"),
        )
        .orderBy(F.col("total_sales").desc(), "category")
    )


def _takes_columns(report: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(report)
    def run(sales: DataFrame, *args, columns: Mapping[str, str] | None = None, **kw) -> DataFrame:
        if columns:
            kept = [c for c in sales.columns if c not in columns and c not in columns.values()]
            sales = sales.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
        return report(sales, *args, **kw)

    return run


# Every report (a public function whose first parameter is ``sales``) takes ``columns``.
for _name, _f in list(vars(sys.modules[__name__]).items()):
    if inspect.isfunction(_f) and not _name.startswith("_") and next(iter(inspect.signature(_f).parameters), "") == "sales":
        globals()[_name] = _takes_columns(_f)
