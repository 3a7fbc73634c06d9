"""SparkSession construction and cluster-safe lineage cutting."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins from real shuffle sizes,
# coalesces small partitions and splits skewed join partitions; UTC keeps NTZ timestamps stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a shuffle starts with many partitions and adaptive execution merges the small ones, so the
    # same setting serves a gigabyte and a hundred terabytes
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "kardex",
                  shuffle_partitions: int | None = None, initial_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if initial_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is; without it the job fails,
    since a machine-local folder is not seen by the executors. Only on a local master is a private
    temporary folder created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    path = configured or tempfile.mkdtemp(prefix="kardex-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


@contextmanager
def planned_with(spark: SparkSession, settings: dict[str, str]):
    """Jobs inside run under these settings of the planner; afterwards the session has its own again. What is
    planned later (lazy frames that leave the block) is not under them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
