"""SparkSession construction and lineage-cut storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tallyspark",
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the SQL settings the library relies on.

    Master, memory, shuffle partitions and the shared checkpoint folder are
    set only when given; on a cluster they come from its own configuration.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable-checkpoint folder, reading the cluster's setting.

    ``spark.checkpoint.dir`` names a shared folder on a cluster and is used
    as is. Only when it is unset *and* Spark runs in local mode (tests) do we
    fall back to a fresh private temporary folder; on a cluster an unset
    value is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is unset: name a shared folder (HDFS or object store) "
            "for reliable checkpoints on this cluster"
        )
    return sc.getCheckpointDir()
