"""Canonical JSON for raw rows and topic message values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schema import ORDER_COLUMNS


def raw_row_json(columns: Sequence[str] = ORDER_COLUMNS) -> Column:
    """One canonical text per raw row: keys sorted, NULLs kept, compact.

    Used as the content identity of quarantined rows, so that the same row
    quarantined twice is recognised whatever the column order of its file.
    """
    cols = sorted(columns)
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def to_envelope_value(columns: Sequence[str] = ORDER_COLUMNS) -> Column:
    """Message value for publishing a row: JSON object in column order, NULLs kept."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
