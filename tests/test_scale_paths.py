"""At sf0.01 the chunked ordering operators agree with Spark's plain windows on the registered query shapes."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import analytics, model, ordered
from tallyspark.plans.registry import FACT_ORDER
from tallyspark.sources import binding
from tallyspark.sources.binding import LINE_ORDER

from .conftest import SF_MID
from .oracle_compare import canon


def _plain_row_number(df, partition, order, out="row_number", chunk_rows=None):
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("bigint"))


def _plain_dense_rank(df, value, descending=True, out="dense_rank", tiebreak=None, chunk_rows=None):
    return df.withColumn(out, F.dense_rank().over(Window.orderBy(F.col(value).desc_nulls_last())).cast("bigint"))


def _plain_rolling(df, partition, order, value, preceding, sum_out="_roll_sum", count_out="_roll_count", chunk_rows=None):
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-preceding, 0)
    return df.select("*", F.sum(value).over(w).alias(sum_out), F.count(value).over(w).alias(count_out))


def _plain_running(df, value, measure=None, descending=True, out="running_total", chunk_rows=None, tiebreak=None):
    return df.withColumn(out, F.sum(measure or value).over(Window.orderBy(F.col(value).desc_nulls_last())))


def _plain_ids(df, order, out, start=1):
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)) + F.lit(start - 1))


CASES = {
    "sequence_and_rank": lambda s, f: analytics.sequence_and_rank(s, LINE_ORDER),
    "rolling3": lambda s, f: analytics.rolling_average(f, FACT_ORDER, 3),
    "pareto": lambda s, f: analytics.pareto(f, 80),
    "orders_row_id": lambda s, f: model.orders(s),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_chunked_plan_equals_plain_windows(spark, monkeypatch, name):
    s = binding.sales_table(spark, SF_MID)
    f = model.fact_lines(s)
    got = CASES[name](s, f)
    got = canon(got.columns, [tuple(r) for r in got.collect()])
    for module in (ordered, model):
        for fn, plain in (
            ("row_number_within", _plain_row_number),
            ("dense_rank", _plain_dense_rank),
            ("rolling_rows", _plain_rolling),
            ("running_total", _plain_running),
            ("sequential_ids", _plain_ids),
        ):
            monkeypatch.setattr(module, fn, plain, raising=False)
    want = CASES[name](s, f)
    assert got == canon(want.columns, [tuple(r) for r in want.collect()])
