"""Session construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are still unset, so a cluster's own values (shuffle
partitions, checkpoint directory, AQE knobs) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on.  AQE is what keeps skewed joins and
# over-partitioned shuffles in check at scale, so it is always requested.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "samplewright",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("SW_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["SW_DRIVER_MEMORY"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster this setting names a shared folder and is respected as is; without
    it a cluster run fails here.  Only a local master (tests, benchmarks) gets a fresh
    scratch directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not current and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="sw-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
