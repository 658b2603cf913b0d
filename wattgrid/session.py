"""Session helpers: one place that pins the settings every operator relies on."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library depends on. The session zone is pinned to UTC before the
# first cast: TIMESTAMP <-> TIMESTAMP_NTZ casts depend on it (see README, "zones").
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, app: str = "wattgrid",
                shuffle_partitions: int | None = None, partition_mb: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings.

    ``master`` is only meant for tests and local runs; on a cluster leave it
    ``None`` so spark-submit decides. ``partition_mb`` sets both the scan split
    size (``spark.sql.files.maxPartitionBytes``) and AQE's target size for
    post-shuffle partitions, so tasks stay within executor memory; AQE then
    coalesces small partitions and splits skewed ones around that size.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if partition_mb:
        conf["spark.sql.files.maxPartitionBytes"] = f"{partition_mb}m"
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = f"{partition_mb}m"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Force the runtime settings that can be changed on a live session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests) gets a private folder when the setting is
    unset; on a cluster an unset value is an error, never a machine-local path.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
            d = None
    if d:
        return d
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    d = tempfile.mkdtemp(prefix="wattgrid-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def read_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: two uses of it see the same rows, even
    where its source would give others when read again."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
