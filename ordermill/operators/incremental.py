"""High-water-mark increments and half-open replay windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import iso_text, parse_ts


def after_watermark(df: DataFrame, ts: str, watermark) -> DataFrame:
    """Rows strictly newer than the stored watermark; all rows when there is none.

    ``watermark`` is a datetime or ISO text; the filter reaches the parquet scan
    when ``ts`` is a stored timestamp column.
    """
    if watermark is None:
        return df
    wm = datetime.fromisoformat(watermark) if isinstance(watermark, str) else watermark
    return df.filter(F.col(ts) > F.lit(wm).cast("timestamp_ntz"))


def late_rows(df: DataFrame, ts: str, watermark) -> DataFrame:
    """Rows at or below the watermark (skipped by an increment; reported, not lost)."""
    if watermark is None:
        return df.limit(0)
    wm = datetime.fromisoformat(watermark) if isinstance(watermark, str) else watermark
    return df.filter(F.col(ts) <= F.lit(wm).cast("timestamp_ntz"))


def watermark_of(df: DataFrame, ts: str) -> DataFrame:
    """One row: ``watermark`` = max(ts) as ISO text (NULL when empty)."""
    return df.agg(iso_text(F.max(ts)).alias("watermark"))


def next_watermark(df: DataFrame, ts: str, current: str | None) -> str | None:
    """The new watermark after loading ``df`` (unchanged when ``df`` is empty)."""
    value = watermark_of(df, ts).first()["watermark"]    # one-row aggregate
    return current if value is None else value


def increment_vs_target(source: DataFrame, target: DataFrame | None, ts: str,
                        empty_takes_all: bool = True) -> DataFrame:
    """Source rows newer than the target's own maximum (scalar subquery, pushed to the scan).

    No target: everything. Empty target: everything when ``empty_takes_all``
    (plain SQL ``ts > NULL`` would select nothing, forever).
    """
    if target is None:
        return source
    top = target.agg(F.max(ts)).scalar()
    cond = F.col(ts) > top
    if empty_takes_all:
        cond = cond | top.isNull()
    return source.filter(cond)


def check_window(start_at: str, end_at: str) -> tuple[datetime, datetime]:
    """Parse and check a replay window; ``start_at`` must be earlier than ``end_at``."""
    start, end = datetime.fromisoformat(start_at), datetime.fromisoformat(end_at)
    if start >= end:
        raise ValueError("start_at must be earlier than end_at")
    return start, end


def replay_window(raw: DataFrame, start_at: str, end_at: str, ts_text: str = "updated_at") -> DataFrame:
    """Raw rows whose time text falls in ``[start_at, end_at)``.

    Rows whose time cannot be parsed are kept, so that validation quarantines them.
    """
    start, end = check_window(start_at, end_at)
    t = parse_ts(ts_text)
    return raw.filter(t.isNull() | ((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz"))))
