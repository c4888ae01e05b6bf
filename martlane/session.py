"""Session construction and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter for every job here: a fixed session zone (all date and
# hour strings are derived in it), AQE for runtime coalescing, broadcast
# conversion from measured sizes and skew-join splitting, key lists of table
# lookups tested value by value against parquet's bloom filters, and no web UI.
BASE_CONF = {
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "martlane",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the project defaults.

    On a cluster pass ``master=None`` so spark-submit decides, and size
    ``shuffle_partitions`` to the data (about 128-256 MB per shuffle
    partition); AQE coalesces what turns out to be too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a private temporary folder (tests);
    on a cluster a machine-local folder would be lost with its executor, so
    that case is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="martlane-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
