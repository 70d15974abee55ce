"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (relationships test): hash left-anti join."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("_pk"), "left_anti")
