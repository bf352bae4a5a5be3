from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallyspark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session("local[4]", 8, checkpoint_dir=shared, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


# Ten invented lines: two lines of one order on one day, a loss, a customer with three lines of one date, a tie in sales.
_LINES = """
1|B-100|2023-03-02|2023-03-04|Boat|C1|Ada Quill|Home|Brig|Alba|P10|Glass|Vases|Tall vase|120.50|1|0.00|30.25
2|B-100|2023-03-02|2023-03-04|Boat|C1|Ada Quill|Home|Brig|Alba|P11|Wood|Stools|Low stool|410.00|2|0.10|55.00
3|B-101|2023-03-19|2023-03-20|Cart|C2|Ben Oster|Trade|Cove|Bree|P12|Glass|Cups|Blue cup|8.40|6|0.00|2.10
4|B-102|2023-07-07|2023-07-15|Boat|C3|Cy Palm|Home|Dune|Bree|P13|Wood|Desks|Wide desk|640.75|1|0.50|-210.40
5|B-102|2023-07-07|2023-07-15|Boat|C3|Cy Palm|Home|Dune|Bree|P14|Metal|Lamps|Arc lamp|75.00|3|0.20|9.90
6|B-103|2023-07-21|2023-07-26|Mule|C4|Di Reed|Trade|Esk|Alba|P15|Wood|Chairs|Reed chair|75.00|4|0.00|18.00
7|B-103|2023-07-21|2023-07-26|Mule|C4|Di Reed|Trade|Esk|Alba|P16|Glass|Bowls|Clear bowl|14.20|5|0.00|4.05
8|B-103|2023-07-21|2023-07-26|Mule|C4|Di Reed|Trade|Esk|Alba|P17|Metal|Tools|Hand drill|512.30|2|0.20|61.00
9|B-104|2023-11-30|2023-12-03|Cart|C5|Ed Sorrel|Home|Fell|Calm|P18|Metal|Hooks|Brass hook|21.00|7|0.00|8.00
10|B-105|2024-01-05|2024-01-05|Cart|C6|Fay Thorn|Trade|Cove|Bree|P19|Glass|Jars|Seed jar|33.60|3|0.00|11.20
"""
FLAT_SCHEMA = (
    "row_id long, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
    "customer_name string, segment string, city string, state string, product_id string, category string, "
    "sub_category string, product_name string, sales decimal(18,2), quantity int, discount decimal(4,2), "
    "profit decimal(18,2)"
)


def flat_rows() -> list[dict]:
    names = [f.split()[0] for f in FLAT_SCHEMA.replace("decimal(18,2)", "m").replace("decimal(4,2)", "m").split(", ")]
    out = []
    for line in _LINES.strip().splitlines():
        r = dict(zip(names, line.split("|"), strict=True))
        r["row_id"], r["quantity"] = int(r["row_id"]), int(r["quantity"])
        for c in ("order_date", "ship_date"):
            r[c] = dt.date.fromisoformat(r[c])
        for c in ("sales", "discount", "profit"):
            r[c] = Decimal(r[c])
        out.append(r)
    return out


@pytest.fixture(scope="session")
def flat10(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in flat_rows()], FLAT_SCHEMA)
    # Tie-break columns of the canonical sales table (unique per line here).
    return df.withColumn("supp_id", F.col("row_id")).withColumn("line_number", F.lit(1))
