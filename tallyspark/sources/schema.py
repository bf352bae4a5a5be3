"""Declared table layouts (DDL text, parsed to StructType on use), column-name normalising and
insert-by-name with column defaults.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Normalised model.
CUSTOMERS = (
    "customer_id STRING NOT NULL, customer_name STRING NOT NULL, segment STRING, city STRING, state STRING"
)
PRODUCTS = "product_id STRING NOT NULL, product_name STRING NOT NULL, category STRING, sub_category STRING"
ORDERS = (
    "row_id BIGINT NOT NULL, order_id STRING NOT NULL, order_date DATE NOT NULL, ship_date DATE, ship_mode STRING, "
    "customer_id STRING, product_id STRING, sales DECIMAL(18,2), quantity INT, discount DECIMAL(4,2), profit DECIMAL(18,2)"
)

# Star schema and audit log.
DIM_CUSTOMERS = (
    "customer_key STRING NOT NULL, customer_name STRING NOT NULL, market_segment STRING, loyalty_tier STRING, "
    "created_at TIMESTAMP_NTZ"
)
DIM_PRODUCTS = (
    "product_key STRING NOT NULL, product_title STRING NOT NULL, major_category STRING, sub_category STRING, "
    "unit_cost DOUBLE, is_active BOOLEAN"
)
DIM_GEOGRAPHY = (
    "geo_key BIGINT NOT NULL, city_name STRING, state_province STRING, region_zone STRING, postal_code STRING"
)
DIM_CALENDAR = (
    "date_key STRING NOT NULL, calendar_year INT, calendar_quarter INT, calendar_month INT, day_of_week STRING, "
    "is_business_day BOOLEAN"
)
FACT_SALES = (
    "txn_id BIGINT NOT NULL, order_id STRING NOT NULL, customer_key STRING, product_key STRING, geo_key BIGINT, "
    "order_date DATE, ship_date DATE, ship_mode STRING, quantity INT, revenue DECIMAL(18,2), "
    "discount_applied DECIMAL(4,2), net_profit DECIMAL(18,2)"
)
MIGRATION_LOG = (
    "log_id STRING NOT NULL, step_name STRING, records_processed BIGINT, status STRING, timestamp TIMESTAMP_NTZ"
)

# Column defaults declared by the star schema.
_STAR_DEFAULTS = {
    "dim_customers": {"loyalty_tier": "'Standard'", "created_at": "localtimestamp()"},
    "dim_products": {"is_active": "true"},
}


def star_defaults(table: str) -> dict[str, Column]:
    """Declared defaults of a star table as columns (built on call: Columns need a session)."""
    return {name: F.expr(sql) for name, sql in _STAR_DEFAULTS.get(table, {}).items()}


def snake_case(name: str) -> str:
    """'Customer ID' -> 'customer_id', 'Sub-Category' -> 'sub_category'."""
    return re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case in one projection."""
    return df.select(*[F.col(f"`{c}`").alias(snake_case(c)) for c in df.columns])


def layout(ddl: str | StructType) -> StructType:
    """Parse a declared layout (needs an active session, so not done at import)."""
    return ddl if isinstance(ddl, StructType) else StructType.fromDDL(ddl)


def align_to(df: DataFrame, schema: str | StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """``INSERT INTO t(cols) SELECT ...`` by name: matching columns are cast to the
    table's types, absent ones take their declared default (else NULL)."""
    schema = layout(schema)
    defaults = defaults or {}
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            value = F.col(f.name)
        elif f.name in defaults:
            value = defaults[f.name]
        else:
            value = F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def checked_rows(df: DataFrame, schema: str | StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows aligned to a layout by name; a NULL in a NOT NULL column fails the job that reads them."""
    schema = layout(schema)
    checked = [
        F.coalesce(F.col(f.name), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType)).alias(f.name)
        if not f.nullable
        else F.col(f.name)
        for f in schema.fields
    ]
    return align_to(df, schema, defaults).select(*checked)


def append_by_name(df: DataFrame, path: str, schema: str | StructType, defaults: Mapping[str, Column] | None = None) -> None:
    """Insert by name; a NULL in a NOT NULL column fails the insert, and nothing of it is committed.

    A second call adds the rows again; :func:`tallyspark.sources.ledger.append_batch` adds a batch once.
    """
    checked_rows(df, schema, defaults).write.mode("append").parquet(path)
