"""Declared constraints re-aimed as validation jobs.

Each check returns rows ``(check_name, table_name, violations)``. NULL is
not a CHECK violation (three-valued logic, as in SQL constraints); foreign
keys skip NULL child keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_key(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Number of key values held by more than one row (NULL keys count as a value)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("primary_key:" + ",".join(keys)).alias("check_name"), F.lit(table).alias("table_name"), "violations"
    )


def row_rules(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """Several row-level rules counted in one pass; a rule is violated where it is FALSE."""
    counts = df.agg(*[F.count_if(~cond).alias(f"_r{i}") for i, cond in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', _r{i}" for i, name in enumerate(rules))
    long = counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (check_name, violations)")
    return long.select("check_name", F.lit(table).alias("table_name"), F.col("violations").cast("bigint"))


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNotNull() for c in columns}


def foreign_key(child: DataFrame, parent: DataFrame, key: str, parent_key: str, table: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    Child rows are counted per key first (partial aggregation), so the
    left-anti join sees one row per key rather than every child row.
    """
    parent_keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = per_key.join(parent_keys, F.col(key) == F.col("_pk"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(f"foreign_key:{key}").alias("check_name"), F.lit(table).alias("table_name"), "violations"
    )


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def normalised_model_checks(
    sales: DataFrame, customers: DataFrame, products: DataFrame, distinct_customers: DataFrame, distinct_products: DataFrame
) -> DataFrame:
    """All checks of the 3-table model.

    Key uniqueness is checked on the ``SELECT DISTINCT`` row sets the load
    would insert, so a customer with two cities is reported.
    """
    order_rules = {
        **not_null_rules(["order_id", "order_date"]),
        "check:sales>=0": F.col("sales") >= 0,
        "check:quantity>0": F.col("quantity") > 0,
        "check:0<=discount<=1": F.col("discount").between(0, 1),
    }
    return union_checks(
        [
            primary_key(distinct_customers, ["customer_id"], "customers"),
            primary_key(distinct_products, ["product_id"], "products"),
            row_rules(customers, not_null_rules(["customer_name"]), "customers"),
            row_rules(products, not_null_rules(["product_name"]), "products"),
            row_rules(sales, order_rules, "orders"),
            foreign_key(sales, customers, "customer_id", "customer_id", "orders"),
            foreign_key(sales, products, "product_id", "product_id", "orders"),
        ]
    )


def given_table_checks(customer: DataFrame, part: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The model's rules on the source tables themselves: keys, NOT NULL, CHECK, and foreign keys against real parents."""
    line_rules = {
        "check:l_extendedprice>=0": F.col("l_extendedprice") >= 0,
        "check:l_quantity>0": F.col("l_quantity") > 0,
        "check:0<=l_discount<=1": F.col("l_discount").between(0, 1),
    }
    return union_checks(
        [
            primary_key(customer, ["c_custkey"], "customer"),
            primary_key(part, ["p_partkey"], "part"),
            row_rules(customer, not_null_rules(["c_custkey", "c_name"]), "customer"),
            row_rules(part, not_null_rules(["p_partkey", "p_name"]), "part"),
            row_rules(orders, not_null_rules(["o_orderkey", "o_orderdate"]), "orders"),
            row_rules(lineitem, line_rules, "lineitem"),
            foreign_key(orders, customer, "o_custkey", "c_custkey", "orders"),
            foreign_key(lineitem, orders, "l_orderkey", "o_orderkey", "lineitem"),
            foreign_key(lineitem, part, "l_partkey", "p_partkey", "lineitem"),
        ]
    )


def load_verification(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """For each (table, expected rows, loaded rows): both counts and whether they agree.

    ``expected`` is what the load should produce (e.g. the distinct staging
    keys), ``loaded`` the table as written.
    """
    parts = []
    for name, expected, loaded in pairs:
        loaded_rows = loaded.agg(F.count(F.lit(1))).scalar()
        parts.append(
            expected.agg(F.count(F.lit(1)).alias("expected_rows"))
            .withColumn("loaded_rows", loaded_rows)
            .select(
                F.lit(name).alias("table_name"),
                "expected_rows",
                "loaded_rows",
                (F.col("expected_rows") == F.col("loaded_rows")).alias("matched"),
            )
        )
    return union_checks(parts)
