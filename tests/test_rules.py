from pyspark.sql import functions as F

from ordermill.operators.rules import ERRORS, LAKEHOUSE, LOCAL, STAGING, EVENTS, apply_rules, to_orders, valid_rows
from ordermill.sources.files import read_orders

from tests.conftest import write_csv


def _errors(spark, path, rules, empty_as_null=True):
    df = apply_rules(read_orders(spark, path, empty_as_null=empty_as_null), rules)
    return {r["order_id"]: r[ERRORS] for r in df.select("order_id", ERRORS).collect()}


def test_first_error_messages_day1(spark, order_files):
    errs = _errors(spark, order_files["day1"], LOCAL, empty_as_null=False)
    assert {k: v for k, v in errs.items() if v} == {
        "ORD-1003": "ORD-1003: missing customer_id",
        "ORD-1005": "ORD-1005: invalid status UNKNOWN",
        "ORD-1006": "ORD-1006: negative amount -500",
        "ORD-1007": "ORD-1007: invalid updated_at not-a-date",
    }


def test_coded_reasons_days_1_to_3(spark, order_files):
    df = apply_rules(read_orders(spark, [order_files["day1"], order_files["day2"], order_files["day3"]]), LAKEHOUSE)
    got = sorted((r["order_id"], r[ERRORS]) for r in df.filter(F.col(ERRORS) != "").collect())
    assert got == [("ORD-1003", "missing_customer_id"), ("ORD-1005", "invalid_status"),
                   ("ORD-1006", "negative_amount"), ("ORD-1007", "invalid_updated_at"),
                   ("ORD-1010", "missing_customer_id"), ("ORD-1012", "missing_customer_id")]


def test_all_errors_joined_and_normalised(spark, tmp_path):
    p = write_csv(tmp_path, "x.csv", " ,  , paid ,abc,2026\nORD-9, C-1 , paid , 12 ,2026-08-01T10:00:00")
    df = apply_rules(read_orders(spark, p), STAGING)
    rows = {r["_order_id"]: (r[ERRORS], r["_status"], r["_amount_cents"]) for r in df.collect()}
    assert rows[""][0] == "order_id is missing; customer_id is missing; amount_cents is invalid; updated_at is invalid"
    assert rows["ORD-9"] == ("", "PAID", 12)
    coded = _errors(spark, p, LAKEHOUSE)
    assert coded["ORD-9"] == "invalid_status"     # case- and space-sensitive in the lakehouse dialect


def test_routing_and_typing(spark, tmp_path):
    p = write_csv(tmp_path, "r.csv", 'ORD-VALID-1,C-TEST,PENDING,"4990",2026-08-01T10:00:00\n'
                                     'ORD-INVALID-1,C-TEST,created,"4990",2026-08-01T10:00:00')
    checked = apply_rules(read_orders(spark, p, empty_as_null=False), LOCAL)
    valid = to_orders(valid_rows(checked)).collect()
    assert [(r["order_id"], r["amount_cents"]) for r in valid] == [("ORD-VALID-1", 4990)]
    assert _errors(spark, p, LOCAL, empty_as_null=False)["ORD-INVALID-1"] == "ORD-INVALID-1: invalid status created"


def test_unicode_whitespace_and_int_guard(spark):
    df = spark.createDataFrame([("A", "\t", "PAID", "12", "2026-08-01T10:00:00"),
                                ("B", "C", "PAID", "1_000", "2026-08-01T10:00:00"),
                                ("C", "C", "PAID", "3000000000", "2026-08-01T10:00:00"),
                                ("D", "C", "PAID", "0", "2026-08-01")],
                               "order_id string, customer_id string, status string, amount_cents string, updated_at string")
    first = {r["order_id"]: r[ERRORS] for r in apply_rules(df, LOCAL).collect()}
    assert first["A"] == "A: missing customer_id"       # any whitespace counts as blank here
    assert first["B"] == "B: invalid amount"
    assert first["C"] == "" and first["D"] == ""
    coded = {r["order_id"]: r[ERRORS] for r in apply_rules(df, LAKEHOUSE).collect()}
    assert coded["A"] == ""                              # only spaces are trimmed here
    staged = {r["order_id"]: r[ERRORS] for r in apply_rules(df, STAGING).collect()}
    assert staged["C"] == "amount_cents is invalid"     # 32-bit amount
    events = {r["order_id"]: r[ERRORS] for r in apply_rules(df, EVENTS).collect()}
    assert events["D"] == "non_positive_amount"


def test_strict_header_rejects_other_layout(spark, tmp_path):
    import pytest
    p = write_csv(tmp_path, "bad.csv", "1,2,3,4,5", header="order_id,status,customer_id,amount_cents,updated_at")
    with pytest.raises(Exception):
        read_orders(spark, p).collect()
    # without the check Spark would silently mislabel the columns
    assert read_orders(spark, p, strict_header=False).count() == 1


def test_pattern_scan_and_lineage(spark, order_files, tmp_path):
    write_csv(tmp_path / "raw", "notes.csv", "x,y,z,1,2026-08-01T00:00:00")
    df = read_orders(spark, order_files["dir"], pattern="orders_*.csv")
    assert df.count() == 18
    names = {r["_file_name"] for r in df.select("_file_name").distinct().collect()}
    assert names == {"orders_2026-08-01.csv", "orders_2026-08-02.csv", "orders_2026-08-03.csv"}


def test_malformed_rows_are_flagged(spark, tmp_path):
    p = write_csv(tmp_path, "m.csv", "A,C,PAID,1,2026-08-01T10:00:00\nB,C,PAID,1,2026-08-01T10:00:00,extra\nC,C,PAID")
    plain = read_orders(spark, p, flag_malformed=False)
    assert plain.count() == 3 and "_corrupt_record" not in plain.columns      # Spark would pad / cut silently
    df = read_orders(spark, p, flag_malformed=True)
    coded = {r["order_id"]: r[ERRORS] for r in apply_rules(df, LAKEHOUSE).collect()}
    assert coded["A"] == ""
    assert coded["B"] == "malformed_row"
    assert coded["C"].startswith("malformed_row; ")
    first = {r["order_id"]: r[ERRORS] for r in apply_rules(df, LOCAL).collect()}
    assert first["B"] == "B: malformed row"
