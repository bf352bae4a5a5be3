"""Every registered query against its DuckDB oracle (sf0.001; the driver uses sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E

from tallyspark.plans.registry import QUERIES

from .conftest import SF_SMALL
from .oracle_compare import compare, duck

NAMES = sorted(QUERIES)  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "orders", "total_sales", "total_profit", "avg_order_value", "units_sold"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, E.queries()[name], E.oracle_sql().get(name))
    assert r["status"] in ("ok", "rows-only"), r["status"]
    assert r["spark_rows"] >= (1 if name.startswith(("q_", "n_", "c_", "r_", "f_")) else 0)
