"""Mergeable partial states of aggregates, kept per partition of the input and refreshed only where files changed.

A state row holds, for one partition and group, the number of rows and per column what merges: exact sums and counts,
least and greatest values, numbers of NULLs, and HyperLogLog sketches for distinct counts. Reports merge states instead
of reading rows. :func:`refresh` compares the file manifest of a partitioned table with the one of the last refresh and
reads the partitions of new, changed or vanished files only; each replaces its own folder of the state table.

Sketches have ``2**SKETCH_BITS`` registers: the relative standard error of an estimate is 1.04 / sqrt(2**SKETCH_BITS),
1.6 % for 12 bits, whether the sketch was made at once or merged. Everything else is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.functions.rounding import round_money, round_ratio
from tallyspark.sources import manifest
from tallyspark.sources.shared import hadoop_fs, written

SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


class Spec(NamedTuple):
    """What the states of a table hold, by column names."""

    groups: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    ranges: tuple[str, ...] = ()
    nulls: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()


# Enough for the region summary, NULL counts, value ranges, loss share and distinct profile of the sales table.
SALES = Spec(
    groups=("region",),
    sums=("sales", "profit", "quantity", "discount", "loss", "loss_discount"),
    ranges=("sales", "profit", "order_date"),
    nulls=("customer_id", "sales", "order_date", "region", "category"),
    distinct=("customer_id", "order_id", "product_id", "region", "category", "state"),
)


def with_losses(sales: DataFrame) -> DataFrame:
    """Profit and discount of loss-making lines as columns of their own."""
    loss = F.col("profit") < 0
    return sales.withColumns({"loss": F.when(loss, F.col("profit")), "loss_discount": F.when(loss, F.col("discount"))})


def states(df: DataFrame, partition: str, spec: Spec) -> DataFrame:
    """One row per partition and group: a partial aggregate, so a hot group is combined before the shuffle."""
    out = [F.count(F.lit(1)).alias("rows")]
    for c in spec.sums:
        out += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    for c in spec.ranges:
        out += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    out += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in spec.nulls]
    out += [F.hll_sketch_agg(c, SKETCH_BITS).alias(f"sketch_{c}") for c in spec.distinct]
    return df.groupBy(partition, *spec.groups).agg(*out)


def merged(state: DataFrame, spec: Spec, groups: Sequence[str] = ()) -> DataFrame:
    """States merged over partitions, per some of their groups (or all in all)."""
    out = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for c in spec.sums:
        out += [F.sum(f"sum_{c}").alias(f"sum_{c}"), F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(f"n_{c}")]
    for c in spec.ranges:
        out += [F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
    out += [F.coalesce(F.sum(f"nulls_{c}"), F.lit(0)).alias(f"nulls_{c}") for c in spec.nulls]
    out += [F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in spec.distinct]
    return state.groupBy(*groups).agg(*out)


class Refreshed(NamedTuple):
    state: DataFrame
    partitions: list[str]  # those whose rows were read


def refresh(
    spark: SparkSession, source: str, schema: str | StructType, partition: str, state_path: str, snapshots: str, spec: Spec, prepare=lambda df: df
) -> Refreshed:
    """Bring the state table up to date with a Parquet table partitioned by the text column ``partition``.

    The manifest of this refresh is kept last, so one that died is done again. ``prepare`` adds columns to the rows.
    Names of changed partitions (dates, months), not files, reach the driver.
    """
    now = written(manifest.take(spark, source, "*.parquet"), "manifest")
    kept = manifest.snapshots(spark, snapshots)
    changes = manifest.difference(manifest.read(spark, kept[-1] if kept else None), now).filter("status <> 'same'")
    name = F.regexp_extract("path", f"(?:^|/){partition}=([^/]*)", 1)
    changed = sorted(r[0] for r in changes.select(name).distinct().collect())
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if changed:
        rows = spark.read.schema(kinds).parquet(source).filter(F.col(partition).isin(changed))
        fresh = states(prepare(rows), partition, spec).repartition(partition)
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(state_path)
        standing = {r[0] for r in now.select(name).distinct().collect()}
        for gone in set(changed) - standing:
            p, fs = hadoop_fs(spark, f"{state_path.rstrip('/')}/{partition}={gone}")
            fs.delete(p, True)
    manifest.keep(now, snapshots)
    wanted = states(prepare(spark.createDataFrame([], kinds)), partition, spec).schema
    return Refreshed(spark.read.schema(wanted).parquet(state_path), changed)


# ------------------------------------------------------------------ reports


def region_summary(state: DataFrame, spec: Spec = SALES) -> DataFrame:
    """As :func:`tallyspark.operators.reports.region_summary`, from states."""
    m = merged(state, spec, ["region"])
    return m.select(
        "region",
        F.col("rows").alias("orders"),
        round_money(F.col("sum_sales")).alias("total_sales"),
        round_money(F.col("sum_profit")).alias("total_profit"),
        round_ratio(F.col("sum_sales"), F.col("n_sales"), 2, num_scale=2).alias("avg_order_value"),
        F.col("sum_quantity").cast("bigint").alias("units_sold"),
    ).orderBy(F.col("total_sales").desc(), "region")


def null_counts(state: DataFrame, spec: Spec = SALES) -> DataFrame:
    """As :func:`tallyspark.operators.reports.null_counts`."""
    return merged(state, spec).select(*[F.col(f"nulls_{c}").alias(f"null_{c}") for c in spec.nulls])


def value_ranges(state: DataFrame, spec: Spec = SALES) -> DataFrame:
    """As :func:`tallyspark.operators.reports.value_ranges`."""
    out = []
    for c, name in (("sales", "sale"), ("profit", "profit")):
        mean = round_ratio(F.col(f"sum_{c}"), F.col(f"n_{c}"), 2, num_scale=2)
        out += [round_money(F.col(f"min_{c}")).alias(f"min_{name}"), round_money(F.col(f"max_{c}")).alias(f"max_{name}"), mean.alias(f"avg_{name}")]
    return merged(state, spec).select(*out)


def loss_orders(state: DataFrame, spec: Spec = SALES) -> DataFrame:
    """As :func:`tallyspark.operators.reports.loss_orders`."""
    return merged(state, spec).select(
        F.col("n_loss").alias("loss_making_orders"),
        round_money(F.col("sum_loss")).alias("total_loss"),
        round_ratio(F.col("sum_loss_discount"), F.col("n_loss_discount"), 1, num_scale=2, mult=100).alias("avg_discount_pct"),
        round_ratio(F.col("n_loss"), F.col("rows"), 1, mult=100).alias("pct_of_all_orders"),
    )


def distinct_estimates(state: DataFrame, spec: Spec = SALES) -> DataFrame:
    """(column_name, estimate): distinct non-NULL values per column, from merged sketches."""
    m = merged(state, spec)
    pairs: list[Column] = [
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.hll_sketch_estimate(f"sketch_{c}"), F.lit(0)).alias("estimate")) for c in spec.distinct
    ]
    return m.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
