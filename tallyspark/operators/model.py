"""Normalised (3-table) and star-schema builds from the flat sales table.

Dimensions keep one row per natural key: the first row in line order wins.
Rows are reduced to distinct attribute sets first (a hash aggregate that
only groups), and only keys with several attribute sets look at line order;
such conflicts are reported by ``checks`` instead of failing the load.
Surrogate keys are dense and deterministic (``ordered.surrogate_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ordered import sequential_ids, surrogate_keys
from tallyspark.sources.binding import LINE_ORDER

# Fixed value: the default loyalty tier of a new customer.
DEFAULT_LOYALTY_TIER = "Standard"
BROADCAST_KEYS = 100_000  # keys with several attribute sets, up to which they are broadcast


def first_by_ordinal(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The row of each key (NULL keys equal each other) with the smallest ``ordinal``, a unique number per row."""
    least = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(ordinal).alias("_first"))
    same = F.col(ordinal) == F.col("_first")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(least, same, "left_semi")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the row smallest in ``order`` (file/line order)."""
    rest = [c for c in columns if c not in keys]
    sets = df.select(*columns).distinct()
    if not rest:
        return sets
    per_key = sets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sets"))
    held = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    of = per_key.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_sets")
    same = held[0]
    for h in held[1:]:
        same = same & h
    single = sets.join(of.filter("_sets = 1"), same, "left_semi")
    # Keys with several attribute sets: the earliest line decides. They are counted first, as a few are broadcast and no
    # line is shuffled; the planner, which doesn't know how few they are, would shuffle every line for the semi-join.
    several = of.filter("_sets > 1")
    few = several.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    lines = df.join(F.broadcast(several) if few else several, same, "left_semi")
    picked = lines.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return single.unionByName(picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])).select(*columns)


def customers(sales: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    cols = ["customer_id", "customer_name", "segment", "city", "state"]
    return keep_first(sales, ["customer_id"], order, cols)


def products(sales: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    cols = ["product_id", "product_name", "category", "sub_category"]
    return keep_first(sales, ["product_id"], order, cols)


def orders(sales: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    """Order-line table with a dense ``row_id`` in line order."""
    cols = ["order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id", "sales", "quantity", "discount", "profit"]
    positioned = sequential_ids(sales.select(*dict.fromkeys([*cols, *order])), list(order), "_id")
    return positioned.select(
        F.col("_id").cast("bigint").alias("row_id"),
        "order_id",
        "order_date",
        "ship_date",
        "ship_mode",
        "customer_id",
        "product_id",
        "sales",
        "quantity",
        "discount",
        "profit",
    )


def dim_geography(sales: DataFrame) -> DataFrame:
    keyed = surrogate_keys(sales.select(F.col("city").alias("city_name"), F.col("state").alias("state_province")),
                           ["state_province", "city_name"], "geo_key")
    return keyed.select(
        "geo_key",
        "city_name",
        "state_province",
        F.lit(None).cast("string").alias("region_zone"),
        F.lit(None).cast("string").alias("postal_code"),
    )


def dim_customers(sales: DataFrame, created_at: Column | None = None, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    """Star customer dimension; ``created_at`` defaults to the load time."""
    base = keep_first(sales, ["customer_id"], order, ["customer_id", "customer_name", "segment"])
    stamp = created_at if created_at is not None else F.current_timestamp()
    return base.select(
        F.col("customer_id").alias("customer_key"),
        "customer_name",
        F.col("segment").alias("market_segment"),
        F.lit(DEFAULT_LOYALTY_TIER).alias("loyalty_tier"),
        stamp.alias("created_at"),
    )


def dim_products(sales: DataFrame, order: Sequence[str] = LINE_ORDER) -> DataFrame:
    base = products(sales, order)
    return base.select(
        F.col("product_id").alias("product_key"),
        F.col("product_name").alias("product_title"),
        F.col("category").alias("major_category"),
        "sub_category",
        F.lit(None).cast("double").alias("unit_cost"),
        F.lit(True).alias("is_active"),
    )


def dim_calendar(sales: DataFrame) -> DataFrame:
    """One row per day from the first to the last order date.

    The span is cut into calendar years first (one row per year, spread
    across tasks by a tiny exchange), and each year row expands to at most
    366 days, so no single row expands the whole span.
    """
    span = sales.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    years = span.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y")).repartition("y")
    first = F.greatest(F.col("lo"), F.make_date(F.col("y"), F.lit(1), F.lit(1)))
    last = F.least(F.col("hi"), F.make_date(F.col("y"), F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("d"))
    dow = F.dayofweek("d")  # 1 = Sunday .. 7 = Saturday
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("date_key"),
        F.year("d").alias("calendar_year"),
        F.quarter("d").alias("calendar_quarter"),
        F.month("d").alias("calendar_month"),
        F.date_format("d", "EEEE").alias("day_of_week"),
        (~dow.isin(1, 7)).alias("is_business_day"),
    )


def fact_sales(
    sales: DataFrame, geography: DataFrame, order: Sequence[str] = LINE_ORDER
) -> DataFrame:
    """Fact rows with a dense ``txn_id`` and the geography key looked up from (city, state)."""
    geo = geography.select("geo_key", F.col("city_name").alias("_city"), F.col("state_province").alias("_state"))
    looked_up = sales.join(
        geo,
        sales["city"].eqNullSafe(geo["_city"]) & sales["state"].eqNullSafe(geo["_state"]),
        "left",
    )
    cols = ["order_id", "customer_id", "product_id", "geo_key", "order_date", "ship_date", "ship_mode", "quantity", "sales", "discount", "profit"]
    positioned = sequential_ids(looked_up.select(*dict.fromkeys([*cols, *order])), list(order), "_id")
    return positioned.select(
        F.col("_id").cast("bigint").alias("txn_id"),
        "order_id",
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        "geo_key",
        "order_date",
        "ship_date",
        "ship_mode",
        "quantity",
        F.col("sales").alias("revenue"),
        F.col("discount").alias("discount_applied"),
        F.col("profit").alias("net_profit"),
    )


def fact_lines(sales: DataFrame) -> DataFrame:
    """Fact rows under star names, without ``txn_id`` or ``geo_key`` (for analytics
    that read neither; skips the global sort and the geography build)."""
    return sales.select(
        "order_id",
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        "order_date",
        "ship_date",
        "ship_mode",
        "quantity",
        F.col("sales").alias("revenue"),
        F.col("discount").alias("discount_applied"),
        F.col("profit").alias("net_profit"),
        "supp_id",
        "line_number",
        "city",
        "state",
    )


def with_geo_key(fact: DataFrame, geography: DataFrame) -> DataFrame:
    """Look the geography surrogate key up from (city, state); unmatched rows keep NULL."""
    geo = geography.select("geo_key", F.col("city_name").alias("_city"), F.col("state_province").alias("_state"))
    looked_up = fact.join(
        geo,
        fact["city"].eqNullSafe(geo["_city"]) & fact["state"].eqNullSafe(geo["_state"]),
        "left",
    )
    return looked_up.drop("_city", "_state")


def fact_sales_unkeyed(sales: DataFrame, geography: DataFrame) -> DataFrame:
    """Fact rows with ``geo_key`` but without ``txn_id``."""
    return with_geo_key(fact_lines(sales), geography).drop("city", "state")
