"""Latest-record-per-key and duplicate detection.

``latest_per_key`` is ``row_number() = 1`` over a window partitioned by the key.
Catalyst turns it into a *partial* WindowGroupLimit before the shuffle and a
final one after it, so a key holding a third of all rows is cut to one row per
map task before anything moves: the hot key never lands whole on one reducer.
The ordering must be total (add tie-break columns), otherwise the surviving row
is arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _desc(xs) -> list[Column]:
    out = []
    for x in xs:
        if isinstance(x, str):
            out.append(F.col(x).desc_nulls_last())
        else:
            out.append(x)          # caller already chose the direction
    return out


def latest_per_key(df: DataFrame, keys: Sequence, order_by: Sequence) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (strings mean DESC NULLS LAST).

    ``keys`` may hold expressions (e.g. a trimmed id).
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*_desc(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_keys(df: DataFrame, key: str = "order_id", min_count: int = 2) -> DataFrame:
    """Keys that occur more than once, with their counts (partial + final hash aggregate)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") >= min_count))


def surplus_duplicates(df: DataFrame, key: Column | str = "order_id", by: Sequence[str] = ()) -> DataFrame:
    """Surplus rows ``SUM(count - 1)`` over normalised non-blank keys seen more than once.

    Two aggregates: per (``by``, key) counts with map-side combine, then a sum per
    ``by`` group (one row when ``by`` is empty, 0 when nothing repeats).
    """
    k = F.trim(F.col(key)) if isinstance(key, str) else key
    per_key = (df.select(*by, k.alias("_key")).filter(F.col("_key").isNotNull() & (F.col("_key") != ""))
               .groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    return per_key.groupBy(*by).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
                                    .alias("duplicate_order_id_rows"))
