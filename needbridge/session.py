"""Session settings: local test session and the cluster-scale recommendations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on at any scale.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Starting point for ~100 TB on a large cluster: many initial shuffle
# partitions that AQE coalesces to ~256 MB each, 256 MB scan splits, and
# skew-join splitting from 5x the median partition.
SCALE_CONF = {
    **CORE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a private one only if unset.

    On a cluster the dir is a shared, fault-tolerant path that the
    deployment must name in ``spark.checkpoint.dir``; a temporary folder is
    taken in local mode only, where driver and executors are one process.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "")
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="nb-ckpt-")
    sc.setCheckpointDir(d)
    return d


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "needbridge",
                  extra: dict | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
