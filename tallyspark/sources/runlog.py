"""Run log: one row per load step (step, records processed, status, time).

Row counts come from ``Observation`` metrics gathered while the step's own
write runs, so logging costs no extra pass over the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "log_id string, step_name string, records_processed bigint, status string, timestamp timestamp_ntz"


def logged_write(df: DataFrame, path: str, step_name: str, log_path: str, mode: str = "overwrite") -> int:
    """Write ``df`` as Parquet and append a log row; returns rows written.

    A failed write is logged with status 'FAILED' and re-raised.
    """
    spark: SparkSession = df.sparkSession
    obs = Observation(f"rows_{step_name}")
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    try:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
        rows, status = int(obs.get["rows"]), "SUCCEEDED"
    except Exception:
        _append(spark, log_path, step_name, None, "FAILED", started)
        raise
    _append(spark, log_path, step_name, rows, status, started)
    return rows


def _append(spark: SparkSession, log_path: str, step: str, rows: int | None, status: str, at: dt.datetime) -> None:
    # log_id: time-ordered and unique without a global counter.
    log_id = f"{at:%Y%m%d%H%M%S%f}-{step}"
    row = spark.createDataFrame([(log_id, step, rows, status, at)], LOG_SCHEMA)
    row.write.mode("append").parquet(log_path)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log_path).orderBy("timestamp", "log_id")
