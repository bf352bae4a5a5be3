"""Measure what one task reads when one key holds a third of all rows.

    python tools/skew_check.py [sf_dir]

Gives a third of ``lineitem`` one key, runs per-key row numbering as a
plain window and through the distributed path of ``operators/ordered.py``
(and a distributed 3-row window), with Spark's event log written to a fresh
scratch folder, then prints the largest and median shuffle read per task of
each final stage. Partition coalescing is off so each task is one shuffle
partition.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    import zstandard

    latest = sorted(glob.glob(f"{log_dir}/eventlog_v2_*"))[-1]
    for f in sorted(glob.glob(f"{latest}/events_*")):
        with open(f, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(reader, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from tallyspark.operators import ordered
    from tallyspark.session import ensure_checkpoint_dir

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-check-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(8)
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    df = li.select(hot.alias("k"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    df = df.withColumn("v", F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")))
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    hot_rows, total = df.filter("k = 0").count(), df.count()
    sc = spark.sparkContext
    runs = {
        "plain window": lambda: df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))),
        "distributed row numbers": lambda: ordered.row_number_within(df, ["k"], order, out="rn"),
        "distributed 3-row window": lambda: ordered.rolling_rows(df, ["k"], order, "l_extendedprice", 2),
        # A third of the rows share one value: a global dense rank over it.
        "plain global dense rank": lambda: df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))),
        "distributed global dense rank": lambda: ordered.dense_rank(df, "v", out="r", tiebreak=order),
        "distributed global dense rank (row-hash tiebreak)": lambda: ordered.dense_rank(df, "v", out="r"),
        "plain running total": lambda: df.withColumn("rt", F.sum("l_extendedprice").over(Window.orderBy(F.col("v").desc()))),
        "distributed running total": lambda: ordered.running_total(
            df, "v", measure="l_extendedprice", out="rt", tiebreak=order
        ),
    }
    for name, build in runs.items():
        sc.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    desc, names, reads = {}, {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerStageSubmitted":
            info = e["Stage Info"]
            desc[info["Stage ID"]] = (e.get("Properties") or {}).get("spark.job.description")
            names[info["Stage ID"]] = info["Stage Name"]
        elif e["Event"] == "SparkListenerTaskEnd":
            metrics = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            reads.setdefault(e["Stage ID"], []).append(metrics.get("Total Records Read", 0))
    print(f"hot key: {hot_rows} of {total} rows")
    for sid in sorted(reads):
        if desc.get(sid) in runs and names[sid].startswith("save"):
            v = sorted(reads[sid])
            print(f"{desc[sid]}: final stage {len(v)} tasks, largest read {v[-1]} rows, median {v[len(v) // 2]}")


if __name__ == "__main__":
    main()
