"""SQL access: register the canonical tables as temporary views.

After ``register_views(spark, sf_dir)`` the normalised and star tables can
be queried with ``spark.sql`` under their model names, and
``view_executive_dashboard`` is the flattened star view.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import analytics, model
from tallyspark.sources import binding

VIEWS = (
    "sales customers products orders dim_customers dim_products dim_geography dim_calendar fact_sales "
    "view_executive_dashboard catalog_raw retail_raw"
).split()


def register_views(spark: SparkSession, sf_dir: str, only: Sequence[str] = VIEWS) -> list[str]:
    """Register the named views (all by default); tables with ordered ids sort when they are registered."""
    s = binding.sales_table(spark, sf_dir)
    build: dict[str, Callable[[], DataFrame]] = {
        "sales": lambda: s,
        "customers": lambda: binding.dimension_table(spark, sf_dir, "customers", model.customers),
        "products": lambda: binding.dimension_table(spark, sf_dir, "products", model.products),
        "orders": lambda: model.orders(s),
        "dim_customers": lambda: model.dim_customers(s),
        "dim_products": lambda: model.dim_products(s),
        "dim_geography": lambda: model.dim_geography(s),
        "dim_calendar": lambda: model.dim_calendar(s),
        "fact_sales": lambda: model.fact_sales(s, model.dim_geography(s)),
        "view_executive_dashboard": lambda: analytics.executive_view(
            model.fact_lines(s), model.dim_customers(s), model.dim_products(s)
        ),
        "catalog_raw": lambda: binding.catalog_dirty(spark, sf_dir),
        "retail_raw": lambda: binding.retail_dirty(spark, sf_dir),
    }
    for name in only:
        build[name]().createOrReplaceTempView(name)
    return list(only)
