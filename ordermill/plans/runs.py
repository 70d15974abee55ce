"""Pipeline runs composed from the operators: incremental load, replay, staging, full load, file reprocess.

A run is a handful of Spark jobs driven by plain Python: validate once (written as a table under the
run so every output sees the same rows and a lost executor re-reads instead of re-scanning; the
counts are observed by that write), gate on counts and duplicates, merge into the current tables, and
publish all outputs together with the run's SUCCESS event. So a run's state and its data can't differ:
what fails before the publish leaves a FAILED event and no data, what fails after it leaves a success.

A repeated run id overwrites nothing: every merge is idempotent, so a rerun changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.json import raw_row_json
from ordermill.functions.text import iso_text
from ordermill.operators import merge as M
from ordermill.operators import metrics as G
from ordermill.operators.audit import EVENT_SCHEMA, FAILED, RUNNING, SUCCESS, new_run_id, run_event
from ordermill.operators.dedupe import duplicate_keys, latest_per_key
from ordermill.operators.incremental import after_watermark, check_window, replay_window
from ordermill.operators.rules import ERRORS, LAKEHOUSE, LOCAL, MALFORMED, STAGING, RuleSet, apply_rules, to_orders, to_quarantine
from ordermill.operators.quality import QualityError, run_report
from ordermill.plans.observed import counted_write
from ordermill.plans.store import Published, Store, export_csv, load_staging
from ordermill.schema import ORDER_COLUMNS, ORDER_SCHEMA, PIPELINE_NAME, REJECTED_EXPORT_COLUMNS
from ordermill.session import conf_override
from ordermill.sources.files import read_orders

REJECTED_SCHEMA = "order_id string, error_message string, raw_row string, _digest bigint, rejected_at timestamp"
STATE_SCHEMA = "pipeline_name string, last_watermark string"
ORDERS_TABLE, REJECTS_TABLE, STATE_TABLE, DUPLICATES = "orders", "rejected_orders", "pipeline_state", "duplicate_ids"
RUNS = "run_events"
# "Newest row per order" inside one batch: time first, then the row's values, so that equal
# times still give one deterministic winner (rows equal in all of these are the same row).
BATCH_ORDER = ["updated_at", "status", "amount_cents", "customer_id"]


class PipelineError(RuntimeError):
    pass


def read_watermark(store: Store, name: str = PIPELINE_NAME) -> str | None:
    """I1: the stored high-water mark (ISO text) or None."""
    row = (store.read(STATE_TABLE, STATE_SCHEMA).filter(F.col("pipeline_name") == name)
           .select("last_watermark").first())
    return None if row is None else row["last_watermark"]


# -- run state: events in the store, the last one published with the data ----------------

def run_log(store: Store) -> DataFrame:
    """All run events (see ``ordermill.operators.audit.run_state``)."""
    return store.read(RUNS, EVENT_SCHEMA)


def _last_event(store: Store, run_id: str) -> tuple[str | None, int]:
    row = run_log(store).filter(F.col("run_id") == run_id).agg(
        F.max_by("run_status", F.struct("event_at", "event_seq")).alias("status"), F.count(F.lit(1)).alias("n")).first()
    return row["status"], row["n"]


def start_run(store: Store, run_id: str, run_type: str, **extra) -> None:
    """Log that a run began (again, if an attempt under this id was interrupted or has ended)."""
    _, n = _last_event(store, run_id)
    event = run_event(store.spark, run_id, RUNNING, n, run_type, **extra)
    store.publish({RUNS: event}, run_id, appends=[RUNS], shared=[RUNS])


def finish_event(store: Store, run_id: str, run_type: str, counts: dict, **extra) -> DataFrame:
    """The SUCCESS event, to be published with the run's data; refused unless the run is RUNNING."""
    status, n = _last_event(store, run_id)
    if status != RUNNING:
        raise PipelineError(f"run {run_id!r} is not running (last state: {status})")
    return run_event(store.spark, run_id, SUCCESS, n, run_type, counts, **extra)


def fail_run(store: Store, run_id: str, run_type: str, error: Exception, counts: dict | None = None, **extra) -> None:
    """Log a failure; a run that has published its data stays a success."""
    status, n = _last_event(store, run_id)
    if status == RUNNING:
        event = run_event(store.spark, run_id, FAILED, n, run_type, counts, error=str(error), **extra)
        store.publish({RUNS: event}, run_id, appends=[RUNS], shared=[RUNS])


def rejects_of(checked: DataFrame, keys: list[str], *extra: str, coalesce_blank: bool = False) -> DataFrame:
    """Distinct rejects with the digest of their identity.

    The raw text of a malformed row or message is its identity; else its values are, order id included.
    """
    raw_row = raw_row_json()
    if MALFORMED in checked.columns:
        raw_row = F.coalesce(F.col(MALFORMED), raw_row)
    rows = checked.filter(F.col(ERRORS) != "").select("order_id", F.col(ERRORS).alias("error_message"), raw_row.alias("raw_row"), *extra)
    return rows.distinct().withColumn(M.DIGEST, M.content_digest(keys, coalesce_blank))


def load(store: Store, checked: DataFrame, new_orders: DataFrame, run_id: str, hook, others: dict, seen: int) -> Published:
    """Upsert new orders (M2), insert-ignore rejects (M7) and publish them with ``others`` (the
    advanced watermark, I2, and the run's end, A1) together (K7)."""
    target = store.read(ORDERS_TABLE, ORDER_SCHEMA)
    changes = M.upsert_changes(target, new_orders.select(*ORDER_SCHEMA.fieldNames()), ["order_id"],
                               ["updated_at"], ">", source_order=BATCH_ORDER).drop(M.CHANGE)
    keys = ["error_message", "raw_row"]
    added = M.new_content(store.read(REJECTS_TABLE, REJECTED_SCHEMA), rejects_of(checked, keys), keys).withColumn(
        "rejected_at", F.current_timestamp())
    logs = [t for t in others if t != STATE_TABLE]
    return store.publish({REJECTS_TABLE: added, ORDERS_TABLE: changes, **others}, run_id, hook=hook, appends=[REJECTS_TABLE, *logs],
                         upserts={ORDERS_TABLE: ["order_id"]}, shared=logs, seen=seen)


def _written_counts(rows: dict[str, int]) -> dict:
    return {"changed_count": rows[ORDERS_TABLE], "quarantined_count": rows[REJECTS_TABLE]}


def _n(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def validate_once(raw: DataFrame, rules: RuleSet, exact_header: bool, path: str,
                  watermark: str | None = None) -> tuple[DataFrame, dict]:
    """Apply the rules and write the result to ``path`` (the one job that reads every column).

    Later jobs read the columns they need from there. The row counts and the newest valid time
    beyond the watermark (``top``) are observed by that job. With ``exact_header`` the CSV header
    check runs case-sensitively during it, so a file whose header differs from the
    expected names even in case fails the run.
    """
    checked = apply_rules(raw, rules)
    valid = F.col(ERRORS) == ""
    new = valid if watermark is None else valid & (
        F.col("_updated_at") > F.lit(datetime.fromisoformat(watermark)).cast("timestamp_ntz"))
    with conf_override(raw.sparkSession, {"spark.sql.caseSensitive": "true"} if exact_header else {}):
        seen = counted_write(checked, lambda df: df.write.parquet(path), valid=_n(valid), new=_n(new),
                             top=iso_text(F.max(F.when(new, F.col("_updated_at")))))
    n, n_valid = seen["rows"], seen.get("valid", 0)
    counts = {"extracted_count": n, "valid_count": n_valid, "rejected_count": n - n_valid, "late_count": n_valid - seen.get("new", 0)}
    return raw.sparkSession.read.schema(checked.schema).parquet(path), {**counts, "top": seen.get("top")}


def _work_path(store: Store, run_id: str, name: str) -> str:
    """A folder of this attempt of a run (a repeated run id gets another one)."""
    return f"{store.root}/_work/{run_id}/{uuid.uuid4().hex}/{name}"


def _gates(store: Store, checked: DataFrame, counts: dict, run_id: str) -> None:
    """Fail the batch on duplicate ids: all of them are written as a table of the run, sorted."""
    if counts["valid_count"] + counts["rejected_count"] != counts["extracted_count"]:
        raise PipelineError(f"Row count mismatch: {counts}")
    twice = duplicate_keys(checked.filter(F.col(ERRORS) == ""), "_order_id").withColumnRenamed("_order_id", "order_id")
    path = _work_path(store, run_id, DUPLICATES)
    n = counted_write(twice.orderBy("order_id"), lambda df: df.write.parquet(path))["rows"]
    if n:
        raise PipelineError(f"Duplicate order IDs: {n}, listed in {path}")


def run_incremental(spark: SparkSession, store: Store, source: str | DataFrame, rules: RuleSet = LOCAL,
                    on_duplicates: str = "fail", hook: Callable[[], None] | None = None,
                    export_dirs: dict[str, str] | None = None, name: str = PIPELINE_NAME,
                    run_id: str | None = None) -> dict:
    """I3: one incremental load of a file (or raw frame). Returns the run summary.

    Rows at or below the stored watermark are skipped (reported as ``late_count``);
    quarantine is not watermark-filtered. ``on_duplicates='latest'`` keeps the newest
    row per id instead of failing the batch. ``hook`` runs after the outputs are written
    and before they are committed.
    """
    run_id = run_id or new_run_id()
    start_run(store, run_id, "INCREMENTAL")
    summary = {"extracted_count": 0, "valid_count": 0, "rejected_count": 0, "changed_count": 0,
               "quarantined_count": 0, "late_count": 0}
    try:
        seen = store.head()
        wm = read_watermark(store, name)
        raw = read_orders(spark, source, empty_as_null=False) if isinstance(source, str) else source
        checked, counts = validate_once(raw, rules, isinstance(source, str), _work_path(store, run_id, "checked"), wm)
        top = counts.pop("top")
        summary.update(counts)
        if on_duplicates == "fail":
            _gates(store, checked, summary, run_id)
        valid = to_orders(checked.filter(F.col(ERRORS) == ""))
        state = spark.createDataFrame([(name, top or wm)], STATE_SCHEMA)
        kept = store.read(STATE_TABLE, STATE_SCHEMA).filter(F.col("pipeline_name") != name)
        read = summary["extracted_count"]
        done = load(store, checked, after_watermark(valid, "updated_at", wm), run_id, hook and (lambda _: hook()), {
            STATE_TABLE: kept.unionByName(state),
            RUNS: lambda rows: finish_event(store, run_id, "INCREMENTAL", {**summary, **_written_counts(rows)},
                                            rows_read=read, rows_copied=read)}, seen)
        summary.update(_written_counts(done.rows))
        summary["watermark"] = top or wm
        if export_dirs:
            export_csv(valid, f"{export_dirs['processed']}/{run_id}")
            export_csv(checked.filter(F.col(ERRORS) != "").withColumn("error_message", F.col(ERRORS)),
                       f"{export_dirs['rejected']}/{run_id}", columns=REJECTED_EXPORT_COLUMNS, ts_columns=())
    except Exception as e:
        fail_run(store, run_id, "INCREMENTAL", e, summary)
        raise
    return summary


def run_replay(spark: SparkSession, store: Store, source: str | DataFrame, start_at: str, end_at: str,
               rules: RuleSet = LOCAL, hook: Callable[[], None] | None = None, run_id: str | None = None) -> dict:
    """I5: reprocess raw rows whose time falls in ``[start_at, end_at)`` (unparseable times included).

    Neither reads nor moves the watermark; idempotent (a second replay changes nothing).
    """
    check_window(start_at, end_at)
    run_id = run_id or new_run_id()
    window = {"replay_from": start_at, "replay_to": end_at}
    start_run(store, run_id, "REPLAY", **window)
    summary = {"extracted_count": 0, "valid_count": 0, "rejected_count": 0, "changed_count": 0,
               "quarantined_count": 0}
    try:
        seen = store.head()
        raw = read_orders(spark, source, empty_as_null=False) if isinstance(source, str) else source
        checked, counts = validate_once(replay_window(raw, start_at, end_at), rules, isinstance(source, str),
                                        _work_path(store, run_id, "checked"))
        summary.update({k: counts[k] for k in ("extracted_count", "valid_count", "rejected_count")})
        _gates(store, checked, summary, run_id)
        valid = to_orders(checked.filter(F.col(ERRORS) == ""))
        read = summary["extracted_count"]
        done = load(store, checked, valid, run_id, hook and (lambda _: hook()), {
            RUNS: lambda rows: finish_event(store, run_id, "REPLAY", {**summary, **_written_counts(rows)},
                                            rows_read=read, rows_copied=read, **window)}, seen)
        summary.update(_written_counts(done.rows))
    except Exception as e:
        fail_run(store, run_id, "REPLAY", e, summary, **window)
        raise
    return {"replay_count": summary["extracted_count"], "valid_count": summary["valid_count"],
            "invalid_count": summary["rejected_count"], "changed_count": summary["changed_count"],
            "quarantined_count": summary["quarantined_count"]}


# -- lakehouse flow: bronze -> silver + quarantine -> gold, with a ledger per file --------

BRONZE, SILVER, QUARANTINE, GOLD = "bronze_orders", "silver_orders", "quarantine_orders", "gold_daily_order_metrics"
LEDGER = "file_ledger"
SILVER_COLS = ("order_id", "customer_id", "status", "amount_cents", "updated_at", "_source_file", "_ingested_at")
SILVER_SCHEMA = ("order_id string, customer_id string, status string, amount_cents bigint, updated_at timestamp_ntz, "
                 "_source_file string, _ingested_at timestamp")
SILVER_ORDER = ["updated_at", "_ingested_at", *BATCH_ORDER[1:]]
QUARANTINE_KEYS = ["_source_file", "order_id", "updated_at", "_error_reason"]
LEDGER_COUNTS = ("bronze_rows", "valid_rows", "rejected_rows", "silver_rows")
LEDGER_SCHEMA = "_source_file string, " + ", ".join(f"{c} bigint" for c in LEDGER_COUNTS)


def _ledger_rows(df: DataFrame, **counts: Column) -> DataFrame:
    """Ledger entries of a frame's files: the given sums, 0 for the others."""
    return df.groupBy("_source_file").agg(*[counts.get(c, F.lit(0)).cast("bigint").alias(c) for c in LEDGER_COUNTS])


def file_ledger(store: Store) -> DataFrame:
    """Per file: rows in bronze, found valid, rejected, current in silver, superseded, and whether they balance.

    The sum of the entries that ingests and reprocessings appended; no table is counted. A file that
    is ingested but not processed yet has no valid and no rejected row.
    """
    out = store.read(LEDGER, LEDGER_SCHEMA).groupBy("_source_file").agg(*[F.sum(c).alias(c) for c in LEDGER_COUNTS])
    processed = F.col("valid_rows") + F.col("rejected_rows")
    return out.withColumns({
        "superseded_rows": F.col("valid_rows") - F.col("silver_rows"),
        "balanced": (processed == F.col("bronze_rows")) & (F.col("silver_rows") >= 0) & (F.col("silver_rows") <= F.col("valid_rows"))})


def ingest_bronze(store: Store, raw: DataFrame, run_id: str, null_safe: bool = True) -> dict:
    """Insert-only bronze merge on (file, id, time) (M1); re-ingesting a file adds nothing.

    The batch is written once; bronze is stored by file, and only the files of the batch are read.
    The rows added to each file are entered in the ledger.
    """
    cols, seen = raw.columns, store.head()
    path = _work_path(store, run_id, "raw")
    raw.write.parquet(path)
    batch = raw.sparkSession.read.schema(raw.schema).parquet(path)
    target, keys = store.read(BRONZE, raw.schema), ["_source_file", "order_id", "updated_at"]
    added = M.new_rows(target, batch, keys, null_safe=null_safe, bound=M.values_bound(batch, "_source_file"))
    path = _work_path(store, run_id, "added")
    added.select(*cols).write.parquet(path)
    added = raw.sparkSession.read.schema(raw.schema).parquet(path)
    done = store.publish({BRONZE: added, LEDGER: _ledger_rows(added, bronze_rows=F.count(F.lit(1)))}, run_id,
                         appends=[BRONZE, LEDGER], partition_by={BRONZE: ["_source_file"]}, shared=[LEDGER], seen=seen)
    return {"bronze_inserted": done.rows[BRONZE]}


def _silver_batch(checked: DataFrame) -> DataFrame:
    """Newest valid row per order of a validated bronze frame."""
    return latest_per_key(to_orders(checked.filter(F.col(ERRORS) == ""), ("_source_file", "_ingested_at")),
                          ["order_id"], SILVER_ORDER).select(*SILVER_COLS)


def reprocess_file(store: Store, source_file: str, run_id: str, rules: RuleSet = LAKEHOUSE) -> dict:
    """I6: validate one bronze file slice, upsert silver (newest per id first), insert quarantine (M6),
    bring the daily gold table up to date from the signed change rows and enter the file in the ledger.

    All tables are published together, and only if the gold rows gained what the changed rows say
    (``quality.gained_gate``). Nothing is counted beyond the file and its change rows.
    """
    from ordermill.operators.quality import enforce, gained_gate

    spark, seen = store.spark, store.head()
    bronze = slice_of(store, source_file)           # stored by file: the slice reads one partition
    checked, counts = validate_once(bronze, rules, False, _work_path(store, run_id, "checked"))
    silver = store.read(SILVER, SILVER_SCHEMA)
    path = _work_path(store, run_id, "signed")
    # both sides of every change, computed once: read for silver, gold and the ledger
    M.signed_changes(silver, _silver_batch(checked), ["order_id"], ["updated_at"], ">", source_order=SILVER_ORDER).write.parquet(path)
    signed = spark.read.parquet(path)
    quarantine = to_quarantine(checked.filter(F.col(ERRORS) != ""), lineage=("_source_file", "_ingested_at"))
    q_target = store.read(QUARANTINE, quarantine.schema)
    raw_text = [MALFORMED] if MALFORMED in quarantine.columns else []
    if raw_text and MALFORMED not in q_target.columns:
        q_target = q_target.withColumn(MALFORMED, F.lit(None).cast("string"))
    added = M.new_rows(q_target, quarantine, QUARANTINE_KEYS + raw_text,
                       null_safe=["order_id", "updated_at", "_error_reason", *raw_text], bound=F.col("_source_file") == source_file)
    gain = G.signed_daily(signed)
    gold = store.read(GOLD).drop("_calculated_at") if store.exists(GOLD) else gain.limit(0)

    # the file's own counts replace those of an earlier run of it; silver rows move between files with their sign
    entered = store.read(LEDGER, LEDGER_SCHEMA).filter(F.col("_source_file") == source_file)
    own = spark.createDataFrame([(source_file, 0, counts["valid_count"], counts["rejected_count"], 0)], LEDGER_SCHEMA)
    before = _ledger_rows(entered, valid_rows=-F.sum("valid_rows"), rejected_rows=-F.sum("rejected_rows"))
    moved = _ledger_rows(signed, silver_rows=F.sum(M.SIGN))

    def gate(paths: dict[str, str | None]) -> None:
        try:
            enforce(gained_gate(gold, spark.read.parquet(paths[GOLD]), signed))
        except QualityError as e:
            raise PipelineError(str(e)) from e

    done = store.publish(
        {QUARANTINE: added, SILVER: signed.filter(F.col(M.SIGN) > 0).select(*SILVER_COLS),
         GOLD: G.add_signed(gold, gain, ["report_date"], rows="total_orders").withColumn("_calculated_at", F.current_timestamp()),
         LEDGER: own.unionByName(before).unionByName(moved)},
        run_id, hook=gate, appends=[QUARANTINE, LEDGER], upserts={SILVER: ["order_id"]}, shared=[LEDGER], seen=seen)
    return {"valid_rows": counts["valid_count"], "rejected_rows": counts["rejected_count"],
            "silver_changed": done.rows[SILVER], "quarantine_added": done.rows[QUARANTINE]}


def slice_of(store: Store, source_file: str) -> DataFrame:
    """The bronze rows of one file."""
    return store.read(BRONZE).filter(F.col("_source_file") == source_file)


def full_load(store: Store, raw: DataFrame, run_id: str, rules: RuleSet = LAKEHOUSE) -> dict:
    """The lakehouse full load as a run: bronze is overwritten (with the columns it has now), silver (newest
    per order), quarantine, daily gold and the ledger are rebuilt from it, checked and published together."""
    from ordermill.operators.quality import enforce, reconcile_daily

    spark, seen = store.spark, store.head()
    checked, counts = validate_once(raw, rules, False, _work_path(store, run_id, "checked"))
    path = _work_path(store, run_id, "silver")
    _silver_batch(checked).write.parquet(path)
    silver = spark.read.schema(SILVER_SCHEMA).parquet(path)
    quarantine = to_quarantine(checked.filter(F.col(ERRORS) != ""), lineage=("_source_file", "_ingested_at"))
    valid = F.col(ERRORS) == ""
    ledger = _ledger_rows(checked, bronze_rows=F.count(F.lit(1)), valid_rows=_n(valid), rejected_rows=_n(~valid)).unionByName(
        _ledger_rows(silver, silver_rows=F.count(F.lit(1))))

    def gate(paths: dict[str, str | None]) -> None:
        try:
            enforce(reconcile_daily(silver, spark.read.parquet(paths[GOLD])))
        except QualityError as e:
            raise PipelineError(str(e)) from e

    done = store.publish({BRONZE: checked.select(*raw.columns), QUARANTINE: quarantine, GOLD: G.daily_metrics(silver, stamp=True),
                          SILVER: silver, LEDGER: ledger}, run_id, hook=gate, operation="OVERWRITE",
                         partition_by={BRONZE: ["_source_file"]}, rebuilds={SILVER: ["order_id"]}, seen=seen)
    return {"silver_rows": done.rows[SILVER], "quarantine_rows": done.rows[QUARANTINE]}


# -- staging flow: staging load -> upsert -> rejects -> report -> run log ----------------

STAGING_TABLE, STAGED_ORDERS, STAGED_REJECTS, REPORTS = "stg_orders", "orders_staged", "rejected_orders_staged", "dq_reports"
STAGED_SCHEMA = ("order_id string, customer_id string, status string, amount_cents bigint, updated_at timestamp_ntz, "
                 "source_file string")
STAGED_REJECTS_SCHEMA = ("order_id string, error_message string, raw_row string, source_file string, _digest bigint, "
                         "rejected_at timestamp")
STAGED_REJECT_KEYS = ["order_id", "error_message", "raw_row", "source_file"]


def run_staging(store: Store, raw: DataFrame, run_id: str, file_pattern: str, rules: RuleSet = STAGING) -> dict:
    """The staging flow as one run: truncate and load staging (K2), upsert newer-or-equal rows (M3),
    insert rejects where NULL counts as '' (M8), update or insert the run's quality report by run
    id (D5, M9) and end the run (A1, A4: rows read and copied to staging). ``raw`` has the text
    columns, ``_source_file`` and, for malformed lines, their raw text."""
    start_run(store, run_id, "STAGING", source_file_pattern=file_pattern)
    try:
        seen = store.head()
        checked, counts = validate_once(load_staging(raw), rules, False, _work_path(store, run_id, "checked"))
        counts.pop("top")
        line = [MALFORMED] if MALFORMED in checked.columns else []
        staging = checked.select(*ORDER_COLUMNS, *line, "source_file", "loaded_at")
        valid = to_orders(checked.filter(F.col(ERRORS) == ""), ("source_file",))
        changes = M.upsert_changes(store.read(STAGED_ORDERS, STAGED_SCHEMA), valid, ["order_id"], ["updated_at"], ">=",
                                   source_order=[*BATCH_ORDER, "source_file"]).drop(M.CHANGE)
        rejects = rejects_of(checked, STAGED_REJECT_KEYS, "source_file", coalesce_blank=True)
        added = M.new_content(store.read(STAGED_REJECTS, STAGED_REJECTS_SCHEMA), rejects, STAGED_REJECT_KEYS,
                              coalesce_blank=True).withColumn("rejected_at", F.current_timestamp())
        report = run_report(staging, rules, run_id, file_pattern)
        reports = store.read(REPORTS, report.schema)
        reports = M.replace_by_key(reports, report, ["run_id"], source_order=["checked_at"]).drop(M.CHANGE)

        def end(rows: dict[str, int]) -> DataFrame:
            written = {"changed_count": rows[STAGED_ORDERS], "quarantined_count": rows[STAGED_REJECTS]}
            return finish_event(store, run_id, "STAGING", {**counts, **written}, rows_read=counts["extracted_count"],
                                rows_copied=rows[STAGING_TABLE], source_file_pattern=file_pattern)

        done = store.publish({STAGED_REJECTS: added, STAGING_TABLE: staging, REPORTS: reports, STAGED_ORDERS: changes, RUNS: end},
                             run_id, appends=[STAGED_REJECTS, RUNS], upserts={STAGED_ORDERS: ["order_id"]}, shared=[RUNS], seen=seen)
    except Exception as e:
        fail_run(store, run_id, "STAGING", e, source_file_pattern=file_pattern)
        raise
    return {"changed_count": done.rows[STAGED_ORDERS], "quarantined_count": done.rows[STAGED_REJECTS]}
