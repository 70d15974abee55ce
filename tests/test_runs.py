import pytest
from pyspark.sql import functions as F

from ordermill.operators.audit import mart_pipeline_runs, run_state
from ordermill.plans.runs import (ORDERS_TABLE, REJECTS_TABLE, PipelineError, fail_run, finish_event, read_watermark, run_incremental,
                                  run_log, run_replay, run_staging, start_run)
from ordermill.plans.store import Store
from ordermill.schema import ORDER_SCHEMA

from tests.conftest import write_csv


def _counts(s):
    return tuple(s[k] for k in ("extracted_count", "valid_count", "rejected_count", "changed_count",
                                "quarantined_count"))


def test_incremental_idempotent_then_day2(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    s1 = run_incremental(spark, store, order_files["day1"])
    assert _counts(s1) == (8, 4, 4, 4, 4)
    assert read_watermark(store) == "2026-08-01T08:35:00"
    s2 = run_incremental(spark, store, order_files["day1"])
    assert _counts(s2) == (8, 4, 4, 0, 0)
    s3 = run_incremental(spark, store, order_files["day2"])
    assert _counts(s3) == (5, 4, 1, 3, 1)
    assert s3["late_count"] == 1                       # ORD-1001 at 08:10 is below the watermark
    assert read_watermark(store) == "2026-08-02T09:10:00"
    orders = {r["order_id"]: (r["status"], r["amount_cents"]) for r in store.read(ORDERS_TABLE).collect()}
    assert orders == {"ORD-1001": ("PAID", 4990), "ORD-1002": ("SHIPPED", 8950), "ORD-1004": ("CANCELLED", 0),
                      "ORD-1008": ("PAID", 1550), "ORD-1009": ("PENDING", 3200)}
    assert store.read(REJECTS_TABLE).count() == 5
    hist = store.history(ORDERS_TABLE).collect()
    assert len(hist) == 3 and all(h["operation"] == "UPSERT" for h in hist)
    assert {h["operation"] for h in store.history(REJECTS_TABLE).collect()} == {"APPEND"}


def test_replay_window_and_idempotency(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    r1 = run_replay(spark, store, order_files["day1"], "2026-08-01T08:15:00", "2026-08-01T08:25:00")
    assert r1 == {"replay_count": 5, "valid_count": 3, "invalid_count": 2, "changed_count": 3, "quarantined_count": 2}
    r2 = run_replay(spark, store, order_files["day1"], "2026-08-01T08:15:00", "2026-08-01T08:25:00")
    assert (r2["changed_count"], r2["quarantined_count"]) == (0, 0)
    assert read_watermark(store) is None               # replay never moves the watermark
    r3 = run_replay(spark, store, order_files["day2"], "2026-08-02T09:00:00", "2026-08-02T09:11:00")
    assert r3["replay_count"] == 3


def test_window_bounds_and_invalid_window(spark, tmp_path):
    p = write_csv(tmp_path, "w.csv", "START,C,PAID,1,2026-08-01T08:15:00\nMIDDLE,C,PAID,1,2026-08-01T08:20:00\n"
                                     "END,C,PAID,1,2026-08-01T08:25:00")
    store = Store(spark, str(tmp_path / "lake"))
    run_replay(spark, store, p, "2026-08-01T08:15:00", "2026-08-01T08:25:00")
    assert sorted(r["order_id"] for r in store.read(ORDERS_TABLE).collect()) == ["MIDDLE", "START"]
    with pytest.raises(ValueError, match="start_at must be earlier than end_at"):
        run_replay(spark, store, p, "2026-08-01T08:25:00", "2026-08-01T08:15:00")


def test_failed_commit_writes_nothing_then_rerun_succeeds(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))

    def boom():
        raise RuntimeError("simulated failure before commit")

    with pytest.raises(RuntimeError, match="simulated"):
        run_incremental(spark, store, order_files["day1"], hook=boom)
    assert store.read(ORDERS_TABLE, ORDER_SCHEMA).count() == 0
    assert read_watermark(store) is None
    s = run_incremental(spark, store, order_files["day1"])
    assert _counts(s) == (8, 4, 4, 4, 4)
    runs = mart_pipeline_runs(run_state(run_log(store))).orderBy("started_at").collect()
    assert [r["run_status"] for r in runs] == ["FAILED", "SUCCESS"]
    assert runs[0]["error_message"] == "simulated failure before commit"
    assert runs[1]["changed_count"] == 4


def test_duplicate_ids_fail_the_batch(spark, tmp_path):
    p = write_csv(tmp_path, "d.csv", "B,C,PAID,1,2026-08-01T08:15:00\nA,C,PAID,1,2026-08-01T08:15:00\n"
                                     "B,C,PAID,2,2026-08-01T09:15:00\nA,C,PAID,2,2026-08-01T09:15:00")
    store = Store(spark, str(tmp_path / "lake"))
    with pytest.raises(PipelineError, match=r"Duplicate order IDs: 2, listed in (.*)") as e:
        run_incremental(spark, store, p)
    listed = spark.read.parquet(str(e.value).rsplit(" ", 1)[1])
    assert [tuple(r) for r in listed.collect()] == [("A", 2), ("B", 2)]
    s = run_incremental(spark, store, p, on_duplicates="latest")
    assert s["changed_count"] == 2
    got = {r["order_id"]: r["amount_cents"] for r in store.read(ORDERS_TABLE).collect()}
    assert got == {"A": 2, "B": 2}


def test_interrupted_runs_are_reported_failed(spark):
    from datetime import datetime
    ev = spark.createDataFrame([
        ("r1", "RUNNING", datetime(2026, 8, 1, 8), 0), ("r2", "RUNNING", datetime(2026, 8, 1, 9), 0),
        ("r2", "SUCCESS", datetime(2026, 8, 1, 9, 5), 1), ("r3", "RUNNING", datetime(2026, 8, 1, 10), 0)],
        "run_id string, run_status string, event_at timestamp_ntz, event_seq bigint")
    st = {r["run_id"]: (r["run_status"], r["finished_at"]) for r in run_state(ev).collect()}
    assert st["r1"][0] == "FAILED" and st["r2"][0] == "SUCCESS" and st["r3"] == ("RUNNING", None)


def test_header_must_match_exactly(spark, tmp_path):
    p = write_csv(tmp_path, "h.csv", "A,C,PAID,1,2026-08-01T08:15:00",
                  header="ORDER_ID,customer_id,status,amount_cents,updated_at")
    store = Store(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception):
        run_incremental(spark, store, p)
    assert spark.conf.get("spark.sql.caseSensitive", "false") == "false"   # the override is scoped
    runs = run_state(run_log(store)).collect()
    assert [r["run_status"] for r in runs] == ["FAILED"]
    ok = write_csv(tmp_path, "ok.csv", "A,C,PAID,1,2026-08-01T08:15:00")
    assert run_incremental(spark, store, ok)["changed_count"] == 1


def test_all_duplicates_are_listed(spark, tmp_path):
    rows = "\n".join(f"ID-{i:04d},C,PAID,1,2026-08-01T08:15:00\nID-{i:04d},C,PAID,2,2026-08-01T09:15:00"
                     for i in range(150))
    p = write_csv(tmp_path, "many.csv", rows)
    store = Store(spark, str(tmp_path / "lake"))
    with pytest.raises(PipelineError, match="Duplicate order IDs: 150, listed in") as e:
        run_incremental(spark, store, p)
    listed = spark.read.parquet(str(e.value).rsplit(" ", 1)[1]).collect()
    assert [r["order_id"] for r in listed] == [f"ID-{i:04d}" for i in range(150)]


def test_rerun_under_the_same_id_changes_nothing(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    state = lambda: (sorted(tuple(r) for r in store.read(ORDERS_TABLE).collect()),
                     sorted(tuple(r)[:3] for r in store.read(REJECTS_TABLE).collect()), read_watermark(store))
    for day in ("day1", "day2"):
        run_incremental(spark, store, order_files[day], run_id="job-42")
        before = state()
        run_incremental(spark, store, order_files[day], run_id="job-42")
        assert state() == before and len(before[0]) >= 4


def test_full_error_text_is_kept(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))

    def boom():
        raise RuntimeError("x" * 5000 + "end")

    with pytest.raises(RuntimeError):
        run_incremental(spark, store, order_files["day1"], hook=boom)
    assert run_state(run_log(store)).first()["error_message"] == "x" * 5000 + "end"


def test_writers_of_one_table_are_ordered_by_commit(spark, order_files, tmp_path):
    """A run id that sorts before an earlier commit's still wins with its newer row."""
    store = Store(spark, str(tmp_path / "lake"))
    run_incremental(spark, store, order_files["day1"], run_id="zzz")
    run_incremental(spark, store, order_files["day3"], run_id="aaa")
    got = {r["order_id"]: r["status"] for r in store.read(ORDERS_TABLE).collect()}
    assert got["ORD-1001"] == "SHIPPED" and got["ORD-1002"] == "SHIPPED"


def test_other_pipelines_keep_their_watermark(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    run_incremental(spark, store, order_files["day1"], name="one")
    run_incremental(spark, store, order_files["day2"], name="two")
    assert read_watermark(store, "one") == "2026-08-01T08:35:00" and read_watermark(store, "two") == "2026-08-02T09:10:00"


def test_malformed_lines_are_rejected_with_their_text(spark, tmp_path):
    p = write_csv(tmp_path, "m.csv", "A,C,PAID,1,2026-08-01T08:15:00\nB,C,PAID,1,2026-08-01T08:15:00,extra\nshort,row")
    store = Store(spark, str(tmp_path / "lake"))
    run_incremental(spark, store, p)
    assert [r["order_id"] for r in store.read(ORDERS_TABLE).collect()] == ["A"]
    assert {r["raw_row"] for r in store.read(REJECTS_TABLE).collect()} == {"B,C,PAID,1,2026-08-01T08:15:00,extra", "short,row"}


def test_malformed_lines_stay_rejects_in_staging(spark, tmp_path):
    from ordermill.plans.runs import STAGED_ORDERS, STAGED_REJECTS
    from ordermill.sources.files import read_orders
    p = write_csv(tmp_path, "m.csv", "A,C,PAID,1,2026-08-01T08:15:00\nB,C,PAID,1,2026-08-01T08:15:00,extra\nshort,row")
    store = Store(spark, str(tmp_path / "lake"))
    for _ in range(2):
        run_staging(store, read_orders(spark, p), "s", "m.csv")
    assert [r["order_id"] for r in store.read(STAGED_ORDERS).collect()] == ["A"]
    assert sorted(r["raw_row"] for r in store.read(STAGED_REJECTS).collect()) == ["B,C,PAID,1,2026-08-01T08:15:00,extra", "short,row"]
    st = run_state(run_log(store)).first()
    assert (st["run_status"], st["event_count"], st["rows_read"], st["rows_copied"], st["source_file_pattern"]) == ("SUCCESS", 4, 3, 3, "m.csv")


def test_a_run_ends_once_and_only_while_it_runs(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    with pytest.raises(PipelineError, match="not running"):
        finish_event(store, "r", "INCREMENTAL", {})
    run_incremental(spark, store, order_files["day1"], run_id="r")
    with pytest.raises(PipelineError, match="not running"):
        finish_event(store, "r", "INCREMENTAL", {})
    fail_run(store, "r", "INCREMENTAL", RuntimeError("late"))            # the data is out: the run stays a success
    assert run_state(run_log(store)).first()["run_status"] == "SUCCESS"
    start_run(store, "r", "INCREMENTAL")
    assert finish_event(store, "r", "INCREMENTAL", {}).first()["event_seq"] == 3


def test_a_failure_behind_the_publish_leaves_a_success(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception, match="nowhere"):
        run_incremental(spark, store, order_files["day1"], export_dirs={"processed": "nowhere://x", "rejected": "nowhere://y"})
    assert store.read(ORDERS_TABLE).count() == 4
    st = run_state(run_log(store)).first()
    assert (st["run_status"], st["changed_count"], st["rows_read"]) == ("SUCCESS", 4, 8)


def test_unicode_blanks_are_missing_values(spark):
    from ordermill.operators.rules import ERRORS, LOCAL, apply_rules
    blanks = ["", " ", "\t", "\u00a0", "\u3000", "\u2003 ", "\x1f", "\x85"]
    rows = [("A", b, "PAID", "1", "2026-08-01T08:15:00") for b in blanks] + [("A", "\u200b", "PAID", "1", "2026-08-01T08:15:00")]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, status string, amount_cents string, updated_at string")
    errors = [r[0] for r in apply_rules(df, LOCAL).select(ERRORS).collect()]
    assert errors == ["A: missing customer_id"] * len(blanks) + [""]         # as str.strip() decides
    assert [not b.strip() for b in blanks] == [True] * len(blanks) and "\u200b".strip()


def test_gate_fails_before_the_commit(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from ordermill.operators import quality
    from ordermill.plans.runs import GOLD, SILVER, full_load, ingest_bronze, reprocess_file
    store = Store(spark, str(tmp_path / "lake"))
    raw = spark.createDataFrame([("A", "C", "PAID", "1", "2026-08-01T08:15:00", "f.csv", datetime(2026, 8, 1))],
                                "order_id string, customer_id string, status string, amount_cents string, updated_at string, "
                                "_source_file string, _ingested_at timestamp")
    ingest_bronze(store, raw, "b")
    assert ingest_bronze(store, raw, "b") == {"bronze_inserted": 0}
    plan = store.read("bronze_orders").filter("_source_file = 'f.csv'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_source_file" in plan
    monkeypatch.setattr(quality, "enforce", lambda checks: (_ for _ in ()).throw(quality.QualityError("bad gold")))
    for attempt in (lambda: reprocess_file(store, "f.csv", "r"), lambda: full_load(store, raw, "f")):
        with pytest.raises(PipelineError, match="bad gold"):
            attempt()
        assert not store.exists(GOLD) and not store.exists(SILVER)
    monkeypatch.undo()
    assert reprocess_file(store, "f.csv", "r") == {"valid_rows": 1, "rejected_rows": 0, "silver_changed": 1, "quarantine_added": 0}
    assert store.read(GOLD).first()["total_orders"] == 1
