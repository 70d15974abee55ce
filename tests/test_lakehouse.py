from pyspark.sql import functions as F

from ordermill.operators.dedupe import latest_per_key
from ordermill.operators.metrics import daily_metrics, status_summary, with_amount
from ordermill.operators.quality import conservation, dq_report, enforce, event_gate, reconcile_daily
from ordermill.operators.metrics import total_metrics
from ordermill.operators.rules import ERRORS, LAKEHOUSE, STAGING, apply_rules, to_orders, valid_rows
from ordermill.plans.runs import BRONZE, GOLD, QUARANTINE, SILVER, ingest_bronze, reprocess_file
from ordermill.plans.store import Store
from ordermill.sources.files import read_orders, status_dimension


def _silver(checked):
    return latest_per_key(to_orders(valid_rows(checked), ("_source_file",)), ["order_id"],
                          ["updated_at", "_source_file"])


def test_full_load_counts_and_current_orders(spark, order_files):
    checked = apply_rules(read_orders(spark, [order_files["day1"], order_files["day2"]]), LAKEHOUSE)
    c = conservation(checked).first()
    assert (c["bronze_rows"], c["valid_rows"], c["superseded_rows"], c["silver_rows"], c["quarantine_rows"]) == \
        (13, 8, 3, 5, 5)
    assert c["balanced"]
    silver = {r["order_id"]: (r["status"], r["amount_cents"], str(r["updated_at"])) for r in _silver(checked).collect()}
    assert silver == {"ORD-1001": ("PAID", 4990, "2026-08-01 08:15:00"),
                      "ORD-1002": ("SHIPPED", 8950, "2026-08-02 09:00:00"),
                      "ORD-1004": ("CANCELLED", 0, "2026-08-01 08:22:00"),
                      "ORD-1008": ("PAID", 1550, "2026-08-02 09:05:00"),
                      "ORD-1009": ("PENDING", 3200, "2026-08-02 09:10:00")}
    all3 = apply_rules(read_orders(spark, order_files["dir"]), LAKEHOUSE)
    c3 = conservation(all3).first()
    assert (c3["bronze_rows"], c3["valid_rows"], c3["superseded_rows"], c3["silver_rows"], c3["quarantine_rows"]) == \
        (18, 12, 6, 6, 6)


def _daily(df):
    return {str(r["report_date"]): (r["total_orders"], r["total_amount_cents"], r["paid_orders"], r["shipped_orders"],
                                    r["pending_orders"], r["cancelled_orders"], r["paid_amount_cents"])
            for r in df.collect()}


def test_daily_metrics_goldens(spark, order_files):
    day1 = _silver(apply_rules(read_orders(spark, order_files["day1"]), LAKEHOUSE))
    assert _daily(daily_metrics(day1)) == {"2026-08-01": (4, 15490, 1, 1, 1, 1, 4990)}
    d12 = _silver(apply_rules(read_orders(spark, [order_files["day1"], order_files["day2"]]), LAKEHOUSE))
    assert _daily(daily_metrics(d12)) == {"2026-08-01": (2, 4990, 1, 0, 0, 1, 4990),
                                          "2026-08-02": (3, 13700, 1, 1, 1, 0, 1550)}
    d123 = _silver(apply_rules(read_orders(spark, order_files["dir"]), LAKEHOUSE))
    assert _daily(daily_metrics(d123)) == {"2026-08-01": (1, 0, 0, 0, 0, 1, 0),
                                           "2026-08-02": (2, 10500, 1, 1, 0, 0, 1550),
                                           "2026-08-03": (3, 14690, 2, 1, 0, 0, 9700)}
    enforce(reconcile_daily(d123, daily_metrics(d123)))
    # the event gate also demands amount > 0: the zero-amount ORD-1004 is valid here, not there
    import pytest
    from ordermill.operators.quality import QualityError
    with pytest.raises(QualityError, match="^data quality failed: silver has no invalid rows$"):
        enforce(event_gate(d123, total_metrics(d123)))
    enforce(event_gate(d123.filter(F.col("amount_cents") > 0), total_metrics(d123.filter(F.col("amount_cents") > 0))))


def test_dq_report_days_1_2(spark, order_files):
    raw = read_orders(spark, [order_files["day1"], order_files["day2"]])
    r = dq_report(raw, STAGING).first().asDict()
    assert {k: r[k] for k in ("total_rows", "valid_rows", "rejected_rows", "missing_order_id_rows",
                              "missing_customer_id_rows", "invalid_status_rows", "invalid_amount_rows",
                              "invalid_updated_at_rows", "duplicate_order_id_rows", "dq_status")} == {
        "total_rows": 13, "valid_rows": 8, "rejected_rows": 5, "missing_order_id_rows": 0,
        "missing_customer_id_rows": 2, "invalid_status_rows": 1, "invalid_amount_rows": 1,
        "invalid_updated_at_rows": 1, "duplicate_order_id_rows": 3, "dq_status": "WARN"}
    per_file = {r["_file_name"]: r["dq_status"] for r in dq_report(raw, STAGING, by=["_file_name"]).collect()}
    assert per_file == {"orders_2026-08-01.csv": "WARN", "orders_2026-08-02.csv": "WARN"}


def test_status_summary_on_current_orders(spark, order_files):
    d12 = _silver(apply_rules(read_orders(spark, [order_files["day1"], order_files["day2"]]), LAKEHOUSE))
    got = {r["status"]: (r["status_label"], r["order_count"], round(r["total_amount"], 2))
           for r in status_summary(with_amount(d12), status_dimension(spark)).collect()}
    assert got == {"PAID": ("Paid", 2, 65.40), "SHIPPED": ("Shipped", 1, 89.50), "PENDING": ("Pending", 1, 32.00),
                   "CANCELLED": ("Cancelled", 1, 0.00)}
    partial = {r["status"]: r["status_label"]
               for r in status_summary(with_amount(d12), status_dimension(spark, ["PAID"])).collect()}
    assert partial["PAID"] is None


def test_bronze_silver_gold_flow(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    for i, day in enumerate(("day1", "day2", "day3")):
        raw = read_orders(spark, order_files[day])
        assert ingest_bronze(store, raw, f"r{i}a")["bronze_inserted"] == raw.count()
        again = ingest_bronze(store, read_orders(spark, order_files[day]), f"r{i}b")
        assert again["bronze_inserted"] == 0
        src = store.read(BRONZE).select("_source_file").distinct().collect()
        file_of_day = [r[0] for r in src if r[0].endswith(order_files[day].split("/")[-1])][0]
        out = reprocess_file(store, file_of_day, f"r{i}c")
    assert out == {"valid_rows": 4, "rejected_rows": 1, "silver_changed": 3, "quarantine_added": 1}
    assert store.read(SILVER).count() == store.read(QUARANTINE).count() == 6
    from ordermill.plans.runs import file_ledger
    ledger = {r["_source_file"][-14:-4]: tuple(r)[1:] for r in file_ledger(store).collect()}
    assert ledger == {"2026-08-01": (8, 4, 4, 1, 3, True), "2026-08-02": (5, 4, 1, 2, 2, True), "2026-08-03": (5, 4, 1, 3, 1, True)}
    again = reprocess_file(store, file_of_day, "again")
    assert again == {"valid_rows": 4, "rejected_rows": 1, "silver_changed": 0, "quarantine_added": 0}
    assert {r["_source_file"][-14:-4]: tuple(r)[1:] for r in file_ledger(store).collect()} == ledger
    silver = {r["order_id"]: r["status"] for r in store.read(SILVER).collect()}
    assert silver["ORD-1001"] == "SHIPPED" and silver["ORD-1002"] == "SHIPPED" and silver["ORD-1009"] == "PAID"
    assert _daily(store.read(GOLD).drop("_calculated_at"))["2026-08-03"] == (3, 14690, 2, 1, 0, 0, 9700)
    assert store.read(QUARANTINE).filter(F.col("_error_reason") == "missing_customer_id").count() == 3


def test_gold_refresh_of_touched_dates_equals_full_recompute(spark, order_files):
    from ordermill.operators import merge as M
    from ordermill.operators.metrics import refresh_daily_metrics
    d1 = _silver(apply_rules(read_orders(spark, order_files["day1"]), LAKEHOUSE)).drop("_source_file")
    gold = daily_metrics(d1)
    state = d1
    for day in ("day2", "day3"):
        batch = to_orders(valid_rows(apply_rules(read_orders(spark, order_files[day]), LAKEHOUSE)))
        changes = M.upsert_changes(state, batch, ["order_id"], ["updated_at"])
        after = M.apply_changes(state, changes, ["order_id"])
        gold = refresh_daily_metrics(gold, state, changes, after)
        assert _daily(gold) == _daily(daily_metrics(after))
        state = after
    assert _daily(gold)["2026-08-03"] == (3, 14690, 2, 1, 0, 0, 9700)
