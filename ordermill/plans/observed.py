"""Counts taken from a write itself (``Observation``), instead of from another pass over what was written."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted_write(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Run ``write`` on ``df`` and return its ``rows`` and the given aggregates, observed by that job.

    Spark drops the observing node of a plan that it finds to be empty while it runs; then rows are 0
    and the other aggregates are missing.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]))
    try:
        found = seen.get
    except Py4JJavaError:                                  # the write went well, but there is no row of metrics
        found = {}
    return {"rows": 0, **{k: v for k, v in found.items() if v is not None}}
