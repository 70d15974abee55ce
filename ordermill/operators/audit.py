"""Run history as append-only events, and the latest state per run.

A run writes one event when it starts and one when it finishes (or fails);
nothing is updated in place, so concurrent writers and retries only append.
The current state is the latest event per run (row_number with a partial
group limit before the shuffle); a run still RUNNING when a later run has
started is reported FAILED (interrupted).
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.dedupe import latest_per_key

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
COUNT_FIELDS = ("extracted_count", "valid_count", "rejected_count", "changed_count", "quarantined_count")

EVENT_SCHEMA = ("run_id string, run_status string, run_type string, event_at timestamp_ntz, event_seq bigint, "
                "extracted_count bigint, valid_count bigint, rejected_count bigint, changed_count bigint, "
                "quarantined_count bigint, late_count bigint, error_message string, replay_from string, "
                "replay_to string, source_file_pattern string, rows_read bigint, rows_copied bigint")


def new_run_id() -> str:
    now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{now}-{uuid.uuid4().hex[:8]}"


def run_event(spark: SparkSession, run_id: str, status: str, seq: int, run_type: str = "INCREMENTAL",
              counts: dict | None = None, error: str | None = None, **extra) -> DataFrame:
    """One run event row (tiny driver-side frame; appended to the run log)."""
    counts = counts or {}
    row = {
        "run_id": run_id, "run_status": status, "run_type": run_type,
        "event_at": datetime.now(timezone.utc).replace(tzinfo=None), "event_seq": seq,
        **{k: counts.get(k) for k in COUNT_FIELDS}, "late_count": counts.get("late_count"),
        "error_message": error, "replay_from": extra.get("replay_from"), "replay_to": extra.get("replay_to"),
        "source_file_pattern": extra.get("source_file_pattern"), "rows_read": extra.get("rows_read"),
        "rows_copied": extra.get("rows_copied"),
    }
    return spark.createDataFrame([row], EVENT_SCHEMA)


def append_event(event: DataFrame, log_path: str) -> None:
    event.coalesce(1).write.mode("append").parquet(log_path)


def read_events(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(log_path)


def run_state(events: DataFrame, run_key: str = "run_id", status: str = "run_status", at: str = "event_at",
              seq: str = "event_seq", mark_interrupted: bool = True) -> DataFrame:
    """Latest state per run: run_id, run_status, started_at, finished_at, event_count (+ latest columns).

    ``started_at`` is the first event; ``finished_at`` the last event once the run
    ended. With ``mark_interrupted``, a RUNNING run that started before the most
    recent run start is FAILED.
    """
    latest = latest_per_key(events, [run_key], [at, seq])
    spans = events.groupBy(run_key).agg(F.min(at).alias("started_at"), F.count(F.lit(1)).alias("event_count"))
    state = latest.join(spans, run_key)
    if mark_interrupted:
        last_start = spans.agg(F.max("started_at")).scalar()
        state = state.withColumn(status, F.when((F.col(status) == RUNNING) & (F.col("started_at") < last_start),
                                                F.lit(FAILED)).otherwise(F.col(status)))
    return state.withColumn("finished_at", F.when(F.col(status) != RUNNING, F.col(at)))


def mart_pipeline_runs(state: DataFrame) -> DataFrame:
    """The reporting projection of run state."""
    cols = ["run_id", "run_type", "run_status", *COUNT_FIELDS, "started_at", "finished_at", "error_message"]
    return state.select(*[c for c in cols if c in state.columns])
