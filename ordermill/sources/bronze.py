"""Bronze tables of the derived order feed, each written once per session, when a query first asks for it.

Queries read bronze the way a medallion pipeline does: from a stored parquet
table, not from the derivation expressions (Catalyst would otherwise inline
the derivation into every pushed-down validation predicate). Bronze orders are
partitioned by source file, so a slice by file reads one folder. The tables
live in the shared checkpoint folder (``spark.checkpoint.dir``), so a lost
executor re-reads them instead of recomputing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ordermill.session import scratch_path, write_folders
from ordermill.sources.orderfeed import event_envelope, load_tables, raw_orders

_WRITTEN: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """The source table as its file system reports it now, so that new data is noticed on any store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/orders.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    status, whole = fs.getFileStatus(path), fs.getContentSummary(path)
    stamp = (status.getModificationTime(), whole.getLength(), whole.getFileCount())
    return (spark.sparkContext.applicationId, fs.makeQualified(path).toString(), stamp, table)


def write_bronze(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Derive and write one bronze table (always a fresh folder) without moving a row; returns its path."""
    path = scratch_path(spark, "bronze", uuid.uuid4().hex, table)
    (orders,) = load_tables(spark, sf_dir, "orders")
    raw = raw_orders(orders)
    if table == "raw_orders":
        write_folders(raw, ["_source_file"], path)
    else:
        event_envelope(raw).write.parquet(path)
    return path


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The bronze table (``raw_orders`` or ``event_envelope``) for ``sf_dir``, written on first use."""
    k = _key(spark, sf_dir, table)
    if k not in _WRITTEN:
        _WRITTEN[k] = write_bronze(spark, sf_dir, table)
    return spark.read.parquet(_WRITTEN[k])
