"""Keyed tables in hash buckets of their key: an upsert reads and rewrites the touched buckets only.

``BucketTable`` is one folder of Parquet partitioned by the bucket, rewritten by Spark's dynamic partition
overwrite: the new files of the touched buckets replace the old ones when the job commits, files of other
buckets stay as they are. An upsert that is repeated after a failure gives the same table, as the newer row
wins. ``ordermill.plans.store`` uses the same functions to publish touched buckets together with other tables.

The number of buckets is part of the partition column's name, so a table is always read as it was laid out.
Choose it so that a bucket of the grown table is a few files of a task's size.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators import merge as M
from ordermill.plans.observed import counted_write
from ordermill.session import scratch_path


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def touched(rows: DataFrame, keys: Sequence[str], n: int) -> list[int]:
    """The buckets that the (stored) rows fall into: at most ``n`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(keys, n).alias("b")).distinct().collect())


class BucketTable:
    """A keyed Parquet table at ``path``, partitioned by the bucket of its key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
        found = self._stored_buckets()
        self.buckets = found or buckets
        self.column = f"_bucket_of_{self.buckets}"

    def _stored_buckets(self) -> int | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        found = [m for m in (re.match(r"_bucket_of_(\d+)=", x) for x in names) if m]
        return int(found[0][1]) if found else None

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The table, or the given buckets of it (a partition filter)."""
        if self._stored_buckets() is None:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(T.StructType([*self.schema, T.StructField(self.column, T.IntegerType())])).option(
            "recursiveFileLookup", False).parquet(self.path)
        if only is not None:
            rows = rows.filter(F.col(self.column).isin(list(only)))
        return rows.drop(self.column)

    def upsert(self, source: DataFrame, compare: Sequence[str] | None = None, cmp: str = ">",
               source_order: Sequence | None = None) -> dict:
        """Upsert a stored batch; returns the number of rows changed and of buckets rewritten."""
        n = self.buckets
        current = self.read(touched(source, self.keys, n))
        work = scratch_path(self.spark, "changes", uuid.uuid4().hex)
        changed = M.upsert_changes(current, source, self.keys, compare, cmp, source_order).drop(M.CHANGE)
        counts = counted_write(changed.select(*self.schema.fieldNames()), lambda df: df.write.parquet(work))
        changes = self.spark.read.schema(self.schema).parquet(work)
        hit = touched(changes, self.keys, n)
        if hit:
            after = M.apply_changes(self.read(hit), changes, self.keys).withColumn(self.column, bucket_of(self.keys, n))
            (after.repartition(self.column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.column).parquet(self.path))
        return {"changed": counts["rows"], "buckets": len(hit)}
