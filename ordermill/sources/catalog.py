"""Tables that SQL users see: session catalog tables over Parquet folders.

A table is external: its rows lie in a folder of their own, and the catalog only points there. A
replacement is written to a new folder first and takes effect in one catalog call, so a query by name
reads the old rows or the new ones; a failed replacement leaves the old table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType | str, root: str) -> None:
    """An empty table ``name`` if there is none."""
    if not spark.catalog.tableExists(name):
        create_or_replace(spark, name, spark.createDataFrame([], schema), root)


def create_or_replace(spark: SparkSession, name: str, rows: DataFrame, root: str) -> str:
    """The table ``name`` as the given rows (create or replace as select); returns their folder under ``root``."""
    path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    kept = spark.table(name).schema if spark.catalog.tableExists(name) else None
    if kept is not None and kept.simpleString() == rows.schema.simpleString():
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:                                                  # other columns: the entry is made anew, old rows stay in their folder
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        spark.sql(f"CREATE TABLE {_quoted(name)} ({_columns(rows.schema)}) USING parquet LOCATION '{path}'")
    return path
