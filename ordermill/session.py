"""SparkSession construction and the reliable checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.maxMetadataStringLength": "1000",      # plans show the whole path of a scan
    # HotSpot does not JIT-compile methods above 8000 bytecode bytes; wide rule
    # expressions fused into one stage would otherwise run interpreted. Stages
    # whose generated code exceeds this fall back to per-operator code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "ordermill", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized so one partition is ~128-256 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


#: Folders of a partitioned write that one task keeps open at once (beyond them it sorts its other rows).
OPEN_FOLDERS = "64"


@contextmanager
def conf_override(spark: SparkSession, conf: dict[str, str]):
    """Set session confs for the jobs run inside the block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_folders(df: DataFrame, by: Sequence[str], path: str) -> None:
    """Write Parquet partitioned by ``by``: every task writes its rows straight into the folders, without sorting them first."""
    with conf_override(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS}):
        df.write.partitionBy(*by).parquet(path)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a private folder (tests);
    a cluster session without it is an error, never a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    root = tempfile.mkdtemp(prefix="ordermill-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "ordermill", *parts)
