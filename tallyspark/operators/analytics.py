"""Subquery, ranking, time-series and audit analytics over the normalised/star tables.

Scalar subqueries become one-row aggregates joined to every row (a
broadcast of one row); correlated maxima become a partial-aggregated
``max`` plus a semi-join; global ranks and running totals use
``tallyspark.operators.ordered`` so no step holds all rows in one task.
Comparisons against means are done exactly on decimals
(``x > sum/n`` as ``x*n > sum``).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.rounding import round_money, round_ratio
from tallyspark.functions.text import year_text
from tallyspark.operators import ordered

# Latency bands of the shipping audit.
ELITE_LABEL, STANDARD_LABEL, DELAYED_LABEL = "Elite Efficiency", "Standard", "Delayed"


def _money(c: str | Column) -> Column:
    return round_money(F.col(c) if isinstance(c, str) else c)


def above_mean(orders: DataFrame) -> DataFrame:
    """Lines whose sales beat the mean line sales."""
    # Scalar subqueries (Catalyst merges them into one aggregate pass).
    total, n = orders.agg(F.sum("sales")).scalar(), orders.agg(F.count("sales")).scalar()
    return orders.filter(F.col("sales") * n > total).select(
        "order_id", "customer_id", F.col("sales").cast("double").alias("sales")
    )


def customer_peak_line(orders: DataFrame) -> DataFrame:
    """Each customer's largest line(s); ties kept, NULL customers dropped."""
    known = orders.filter(F.col("customer_id").isNotNull())
    peaks = known.groupBy("customer_id").agg(F.max("sales").alias("sales"))
    hit = known.join(peaks, ["customer_id", "sales"], "left_semi")
    return hit.select("customer_id", "order_id", F.col("sales").cast("double").alias("sales"))


def _customer_totals(orders: DataFrame, out: str) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.sum("sales").alias(out))


def customers_above_mean(orders: DataFrame, customers: DataFrame) -> DataFrame:
    totals = _customer_totals(orders, "_t")
    total, n = totals.agg(F.sum("_t")).scalar(), totals.agg(F.count("_t")).scalar()
    above = totals.filter(F.col("_t") * n > total)
    named = above.join(customers.select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", _money("_t").alias("total_customer_revenue"))


def sequence_and_rank(orders: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """Per-customer sequence (newest first) and the global dense rank of each line by sales."""
    seq_order = [F.col("order_date").desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]]
    # Project before the checkpointed sort: a checkpoint materialises every column it is given.
    needed = list(dict.fromkeys(["customer_id", "order_id", "sales", "order_date", *tiebreak]))
    numbered = ordered.row_number_within(
        orders.select(*needed), ["customer_id"], seq_order, out="internal_order_sequence"
    )
    ranked = ordered.dense_rank(
        numbered, "sales", descending=True, out="global_revenue_line_rank", tiebreak=tiebreak
    )
    return ranked.select(
        "customer_id",
        "order_id",
        F.col("sales").cast("double").alias("sales"),
        "internal_order_sequence",
        "global_revenue_line_rank",
    )


def master_ledger(orders: DataFrame, customers: DataFrame) -> DataFrame:
    totals = _customer_totals(orders, "lifetime_gross_sales")
    ranked = ordered.dense_rank(
        totals, "lifetime_gross_sales", descending=True, out="strategic_customer_rank",
        tiebreak=["customer_id"],
    )
    named = ranked.join(customers.select("customer_id", "customer_name"), "customer_id")
    return named.select(
        "customer_name", _money("lifetime_gross_sales").alias("lifetime_gross_sales"), "strategic_customer_rank"
    ).orderBy("strategic_customer_rank", "customer_name")


def ranked_customers(orders: DataFrame, customers: DataFrame, k: int = 5, descending: bool = True) -> DataFrame:
    """Top (or bottom) k customers by total sales with their dense rank over all customers.

    The k rows taken first in rank order contain every larger (smaller)
    total, so the dense rank computed on those k rows equals the rank over
    all customers: a distributed top-k, then a k-row window.
    """
    totals = _customer_totals(orders, "ts").filter(F.col("customer_id").isNotNull())
    key = F.col("ts").desc() if descending else F.col("ts").asc()
    top = totals.orderBy(key, F.col("customer_id").asc()).limit(k)
    rank = F.dense_rank().over(Window.orderBy(key))  # over the k rows only
    named = top.withColumn("rk", rank.cast("bigint")).join(customers.select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", _money("ts").alias("total_sales"), "rk")


def single_order_customers(orders: DataFrame, customers: DataFrame, n: int = 1) -> DataFrame:
    """Customers with exactly ``n`` distinct orders.

    Counted per customer before the join (one row per customer then meets
    the customer table), which equals grouping the joined lines by id and
    name because the customer table has one name per id.
    """
    counts = orders.groupBy("customer_id").agg(F.countDistinct("order_id").alias("total_lifetime_orders"))
    hit = counts.filter(F.col("total_lifetime_orders") == n)
    named = hit.join(customers.select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", "total_lifetime_orders")


def peak_cart(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Largest order total per customer (aggregated to one row per customer before the join)."""
    carts = orders.groupBy("customer_id", "order_id").agg(F.sum("sales").alias("_cart"))
    peaks = carts.groupBy("customer_id").agg(F.max("_cart").alias("_peak"))
    named = peaks.join(customers.select("customer_id", "customer_name"), "customer_id")
    return named.select("customer_id", "customer_name", _money("_peak").alias("peak_historical_order_value"))


def rolling_average(
    fact: DataFrame, tiebreak: Sequence[str], rows: int = 3, chunk_rows: int | None = None
) -> DataFrame:
    """Mean revenue over each customer's last ``rows`` lines (current included), 6 decimals."""
    order = [F.col("order_date").asc_nulls_first(), *[F.col(c).asc() for c in tiebreak]]
    needed = list(dict.fromkeys(["customer_key", "order_date", "revenue", *tiebreak]))
    rolled = ordered.rolling_rows(
        fact.select(*needed), ["customer_key"], order, "revenue", rows - 1, chunk_rows=chunk_rows
    )
    return rolled.select(
        "customer_key",
        "order_date",
        F.col("revenue").cast("double").alias("revenue"),
        round_ratio(F.col("_roll_sum"), F.col("_roll_count"), 6, num_scale=2).alias("rolling_3_order_avg"),
    )


def hot_geographies(fact: DataFrame, geography: DataFrame, factor: float = 1.5) -> DataFrame:
    """Places whose total profit exceeds ``factor`` x the mean place total (NULL keys excluded)."""
    per_geo = fact.filter(F.col("geo_key").isNotNull()).groupBy("geo_key").agg(F.sum("net_profit").alias("_p"))
    total, n = per_geo.agg(F.sum("_p")).scalar(), per_geo.agg(F.count("_p")).scalar()
    f = F.lit(Decimal(str(factor)))
    hot = per_geo.filter(F.col("_p") * n > f * total)
    return geography.join(hot.select("geo_key"), "geo_key", "left_semi").select("city_name", "state_province")


def yoy_monthly(fact: DataFrame, lag: int = 12, complete: bool = False) -> DataFrame:
    """Monthly revenue against ``lag`` rows earlier (row offset, as LAG counts rows).

    With ``complete`` the months without lines are filled in first, so the
    offset counts calendar months; such months have no revenue and no row.
    """
    monthly = fact.groupBy(year_text("order_date").alias("yr"), F.date_format("order_date", "MM").alias("mo")).agg(
        F.sum("revenue").alias("_m")
    )
    if complete:
        first = F.make_date(F.col("yr").cast("int"), F.col("mo").cast("int"), F.lit(1))
        span = monthly.agg(F.min(first).alias("lo"), F.max(first).alias("hi"))
        months = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("d"))
        names = months.select(year_text("d").alias("yr"), F.date_format("d", "MM").alias("mo"))
        monthly = names.join(monthly, ["yr", "mo"], "left")
    # One row per calendar month: bounded by the date span, not by data volume.
    w = Window.orderBy("yr", "mo")
    with_prev = monthly.withColumn("_prev", F.lag("_m", lag).over(w)).filter(F.col("_prev").isNotNull() & F.col("_m").isNotNull())
    return with_prev.select(
        "yr",
        "mo",
        _money("_m").alias("m_rev"),
        _money("_prev").alias("prev_year_rev"),
        round_ratio(F.col("_m") - F.col("_prev"), F.col("_prev"), 2, num_scale=2, den_scale=2, mult=100).alias(
            "yoy_pct_change"
        ),
    )


def pareto(
    fact: DataFrame, limit_pct: int = 80, chunk_rows: int | None = None
) -> DataFrame:
    """Customers, largest first, while cumulative revenue share stays <= ``limit_pct``.

    Ties in total revenue share one running total (RANGE frame). The filter
    compares exactly: running * 100 <= limit * grand total.
    """
    totals = fact.groupBy("customer_key").agg(F.sum("revenue").alias("total_revenue"))
    run = ordered.running_total(
        totals, "total_revenue", descending=True, out="_run", chunk_rows=chunk_rows,
        tiebreak=["customer_key"],
    )
    grand = totals.agg(F.sum("total_revenue")).scalar()  # scalar subquery
    kept = run.withColumn("_grand", grand).filter(F.col("_run") * F.lit(100) <= F.lit(limit_pct) * F.col("_grand"))
    return kept.select(
        "customer_key",
        _money("total_revenue").alias("total_revenue"),
        round_ratio(F.col("_run"), F.col("_grand"), 6, num_scale=2, den_scale=2, mult=100).alias("cumulative_percentage"),
    )


def ship_latency(fact: DataFrame, elite_days: int = 2, standard_days: int = 5) -> DataFrame:
    days = F.datediff("ship_date", "order_date")
    rating = (
        F.when(days <= elite_days, ELITE_LABEL).when(days <= standard_days, STANDARD_LABEL).otherwise(DELAYED_LABEL)
    )
    return fact.filter(F.col("ship_date").isNotNull()).select(
        "order_id", "order_date", "ship_date", days.cast("bigint").alias("processing_days"), rating.alias("efficiency_rating")
    )


def discount_cannibal(
    fact: DataFrame, products: DataFrame, min_avg_discount: float = 0.2, max_total_impact: float = 0.0
) -> DataFrame:
    """Products whose mean discount exceeds a bound while total profit stays below one.

    Aggregated per product key before the product titles are joined on (one
    row per product meets the dimension instead of every fact row).
    """
    agg = fact.groupBy("product_key").agg(
        F.sum("discount_applied").alias("_d"), F.count("discount_applied").alias("_n"), F.sum("net_profit").alias("_p")
    )
    bound_d = F.lit(Decimal(str(min_avg_discount)))
    bound_p = F.lit(Decimal(str(max_total_impact)))
    hit = agg.filter((F.col("_d") > bound_d * F.col("_n")) & (F.col("_p") < bound_p))
    hit = hit.join(products.select("product_key", "product_title"), "product_key")
    return hit.select(
        "product_title",
        round_ratio(F.col("_d"), F.col("_n"), 6, num_scale=2).alias("avg_discount"),
        _money("_p").alias("total_impact"),
    ).orderBy("total_impact", "product_title")


def executive_view(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Flattened star: fact ⋈ customer ⋈ product (dimensions broadcast only when AQE measures them small)."""
    j = fact.join(customers.select("customer_key", "customer_name", "market_segment"), "customer_key")
    j = j.join(products.select("product_key", "product_title", "major_category"), "product_key")
    return j.select(
        "order_id",
        "customer_name",
        "market_segment",
        "product_title",
        "major_category",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("net_profit").cast("double").alias("net_profit"),
        "order_date",
    )
