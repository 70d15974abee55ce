import pytest
from pyspark.sql import functions as F

from ordermill.operators.audit import append_event, mart_pipeline_runs, read_events, run_event, run_state
from ordermill.plans.runs import ORDERS_TABLE, run_incremental
from ordermill.plans.store import Store, export_csv, load_staging
from ordermill.schema import ORDER_SCHEMA
from ordermill.sources.files import read_orders, read_orders_inferred, read_seed, register_external_view, resolve_uri

from tests.conftest import write_csv


def test_blob_uri_mapping(order_files):
    base = order_files["dir"]
    assert resolve_uri("blob://raw/orders_2026-08-01.csv", {"raw": base}) == base + "/orders_2026-08-01.csv"
    assert resolve_uri("file:/x/y.csv") == "file:/x/y.csv"
    with pytest.raises(ValueError):
        resolve_uri("blob://nope/x.csv", {"raw": base})


def test_blob_source_and_exports(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    exports = {"processed": str(tmp_path / "processed"), "rejected": str(tmp_path / "rejected")}
    raw = read_orders(spark, "blob://raw/orders_2026-08-01.csv", containers={"raw": order_files["dir"]},
                      empty_as_null=False)
    s = run_incremental(spark, store, raw, export_dirs=exports, run_id="20260801T000000000000-a")
    assert s["changed_count"] == 4
    processed = spark.read.option("header", True).csv(f"{exports['processed']}/20260801T000000000000-a")
    assert processed.count() == 4
    assert processed.filter(F.col("order_id") == "ORD-1001").first()["updated_at"] == "2026-08-01 08:15:00"
    rejected = spark.read.option("header", True).csv(f"{exports['rejected']}/20260801T000000000000-a")
    assert rejected.columns == ["order_id", "customer_id", "status", "amount_cents", "updated_at", "error_message"]
    assert rejected.count() == 4


def test_staging_load_external_view_and_seed(spark, order_files, tmp_path):
    staging = load_staging(read_orders(spark, order_files["day1"]))
    assert staging.columns == ["order_id", "customer_id", "status", "amount_cents", "updated_at", "_corrupt_record",
                               "source_file", "loaded_at"]
    path = str(tmp_path / "gold")
    spark.createDataFrame([("2026-08-02", 3), ("2026-08-01", 2)], "report_date string, total_orders long") \
        .write.parquet(path)
    v = register_external_view(spark, "gold_daily_view", path)
    assert [r["report_date"] for r in v.orderBy("report_date").collect()] == ["2026-08-01", "2026-08-02"]
    seed = write_csv(tmp_path, "order_statuses.csv", "PAID,Paid\nSHIPPED,Shipped\nCANCELLED,Cancelled\nPENDING,Pending",
                     header="status,status_label")
    assert read_seed(spark, seed).count() == 4
    inferred = read_orders_inferred(spark, order_files["day1"])
    assert dict(inferred.dtypes)["amount_cents"] == "int"


def test_store_ensure_history_and_rebuild(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    store.ensure("orders", ORDER_SCHEMA)
    store.ensure("orders", ORDER_SCHEMA)
    assert store.read("orders").count() == 0
    one = spark.createDataFrame([("A", None, None, None, None)], ORDER_SCHEMA)
    store.publish({"orders": one}, "r1", appends=["orders"])
    store.publish({"orders": one}, "r2", appends=["orders"])
    assert store.read("orders").count() == 2
    store.publish({"orders": store.read("orders")}, "r3", operation="REBUILD")
    assert len(store.current_paths("orders")) == 1 and store.read("orders").count() == 2
    assert [h["operation"] for h in store.history("orders").collect()] == ["REBUILD", "APPEND", "APPEND", "CREATE"]


def test_copy_metrics_in_run_log(spark, tmp_path):
    log = str(tmp_path / "runs")
    append_event(run_event(spark, "c1", "RUNNING", 0, "COPY", source_file_pattern="orders_*.csv"), log)
    append_event(run_event(spark, "c1", "SUCCESS", 1, "COPY", rows_read=13, rows_copied=13,
                           source_file_pattern="orders_*.csv"), log)
    st = run_state(read_events(spark, log)).first()
    assert (st["run_status"], st["rows_read"], st["rows_copied"], st["source_file_pattern"]) == \
        ("SUCCESS", 13, 13, "orders_*.csv")
    assert mart_pipeline_runs(run_state(read_events(spark, log))).columns[:3] == ["run_id", "run_type", "run_status"]


def test_orders_table_survives_reader_of_old_version(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    run_incremental(spark, store, order_files["day1"], run_id="20260801T000000000000-a")
    old = store.read(ORDERS_TABLE)
    paths = store.current_paths(ORDERS_TABLE)
    run_incremental(spark, store, order_files["day2"], run_id="20260802T000000000000-b")
    assert store.current_paths(ORDERS_TABLE) != paths
    assert old.count() == 4                                # earlier snapshot still readable


def test_lookup_by_id_reaches_the_scan(spark, order_files, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    run_incremental(spark, store, order_files["day1"], run_id="20260801T000000000000-a")
    run_incremental(spark, store, order_files["day2"], run_id="20260802T000000000000-b")
    got = store.lookup(ORDERS_TABLE, "order_id", ["ORD-1002", "ORD-1009", "ORD-9999"])
    assert {r["order_id"]: r["status"] for r in got.collect()} == {"ORD-1002": "SHIPPED", "ORD-1009": "PENDING"}
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(order_id" in p
    assert len(got.inputFiles()) < len(store.read(ORDERS_TABLE).inputFiles())      # other buckets aren't opened
    full = {r["order_id"]: r["status"] for r in store.read(ORDERS_TABLE).collect()}
    assert full["ORD-1002"] == "SHIPPED" and len(full) == 5


def test_upserts_rewrite_the_buckets_they_touch(spark, tmp_path):
    from datetime import datetime

    from ordermill.operators import merge as M
    from ordermill.plans.buckets import touched
    store = Store(spark, str(tmp_path / "lake"), buckets=8)
    schema = "order_id string, status string, updated_at timestamp_ntz"
    rows = lambda keys, hour: spark.createDataFrame([(k, str(hour), datetime(2026, 8, 1, hour)) for k in keys], schema)
    keys = [f"K{i}" for i in range(30)]
    for batch in (rows(keys, 8), rows(["K3", "new"], 9)):
        before = store.current_paths("t")
        ch = M.upsert_changes(store.read("t", schema), batch, ["order_id"], ["updated_at"]).drop(M.CHANGE)
        store.publish({"t": ch}, "r", upserts={"t": ["order_id"]})
    hit = touched(batch, ["order_id"], 8)
    assert len(set(store.current_paths("t")) - set(before)) == len(hit) < 8
    got = {r["order_id"]: r["status"] for r in store.read("t").collect()}
    assert got == {**{k: "8" for k in keys}, "K3": "9", "new": "9"} and store.read("t").count() == 31
    assert store.publish({"t": ch.limit(0)}, "r", upserts={"t": ["order_id"]}).paths == {"t": None}
    store.publish({"plain": batch}, "r")
    with pytest.raises(ValueError, match="not keyed"):
        store.publish({"plain": batch}, "r", upserts={"plain": ["order_id"]})


def test_appended_folders_are_listed_in_a_chain(spark, tmp_path, monkeypatch):
    from ordermill.plans import store as S
    monkeypatch.setattr(S, "LISTED", 3)
    store = Store(spark, str(tmp_path / "lake"))
    for k in range(10):
        store.publish({"b": spark.createDataFrame([(k,)], "k long")}, f"r{k}", appends=["b"])
        store.publish({"other": spark.createDataFrame([(k,)], "k long")}, f"o{k}")
    assert sorted(r["k"] for r in store.read("b").collect()) == list(range(10))
    assert len(store._layout("b")["folders"]) <= 3 and len(store.current_paths("b")) == 10


def test_schema_changes(spark, tmp_path):
    from ordermill.plans.store import SchemaConflict
    store = Store(spark, str(tmp_path / "lake"))
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    store.publish({"t": make([(1, "a")], "k int, gone string")}, "1")
    store.publish({"t": make([(2, 1.5)], "k bigint, added double")}, "2", appends=["t"])
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a", None), (2, None, 1.5)]
    assert dict(store.read("t").dtypes) == {"k": "bigint", "gone": "string", "added": "double"}
    store.publish({"t": make([(3,)], "k int")}, "3", appends=["t"])           # a narrower type is read as the wide one
    assert store.read("t").count() == 3
    with pytest.raises(SchemaConflict, match="'k' is bigint in the table and string"):
        store.publish({"t": make([("x",)], "k string")}, "4", appends=["t"])
    assert store.read("t").count() == 3
    store.publish({"t": make([("x",)], "k string")}, "5", operation="OVERWRITE")
    assert [tuple(r) for r in store.read("t").collect()] == [("x",)]


def test_catalog_table_before_and_after_a_replace(spark, tmp_path):
    from ordermill.sources.catalog import create_if_absent, create_or_replace
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "k long")
    name, root = "gold_by_name", str(tmp_path)
    seen = lambda: sorted(r["k"] for r in spark.sql(f"SELECT k FROM {name}").collect())
    try:
        create_if_absent(spark, name, "k long", root)
        assert seen() == []
        create_or_replace(spark, name, rows(1, 2), root)
        create_if_absent(spark, name, "k long", root)
        assert seen() == [1, 2]
        create_or_replace(spark, name, spark.table(name).union(rows(3)), root)       # a replacement may read what it replaces
        assert seen() == [1, 2, 3]
        create_or_replace(spark, name, rows(7).withColumn("label", F.lit("x")), root)
        assert [tuple(r) for r in spark.table(name).collect()] == [(7, "x")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_logs_are_shared_and_other_tables_are_not(spark, tmp_path):
    from ordermill.plans.store import CommitConflict
    store = Store(spark, str(tmp_path / "lake"))
    row = lambda k: spark.createDataFrame([(k,)], "k long")
    seen = store.head()
    store.publish({"log": row(1)}, "a", appends=["log"], shared=["log"])
    store.publish({"x": row(1), "log": row(2)}, "b", appends=["log"], shared=["log"], seen=seen)
    assert sorted(r["k"] for r in store.read("log").collect()) == [1, 2]
    with pytest.raises(CommitConflict, match="x"):
        store.publish({"x": row(2), "log": row(3)}, "c", appends=["log"], shared=["log"], seen=seen)
    assert store.read("log").count() == 2


def test_publish_refuses_a_state_that_moved_on(spark, tmp_path):
    from ordermill.plans.store import CommitConflict
    store, other = Store(spark, str(tmp_path / "lake")), Store(spark, str(tmp_path / "lake"))
    row = lambda k: spark.createDataFrame([(k,)], "k long")
    seen = store.head()
    other.publish({"t": row(1)}, "first", appends=["t"])
    with pytest.raises(CommitConflict):
        store.publish({"t": row(2)}, "second", appends=["t"], seen=seen)
    assert [r["k"] for r in store.read("t").collect()] == [1]
    store.publish({"t": row(2)}, "second", appends=["t"])
    assert sorted(r["k"] for r in other.read("t").collect()) == [1, 2]


def test_unreadable_log_is_an_error_not_an_empty_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    assert store.commits().count() == 0 and store.head() == 0
    store.publish({"t": spark.createDataFrame([(1,)], "k long")}, "a")
    (tmp_path / "lake" / "_commits" / "000000000002.json").write_text("{broken")
    with pytest.raises(ValueError):
        store.read("t")
    with pytest.raises(ValueError):
        store.publish({"t": spark.createDataFrame([(2,)], "k long")}, "b", appends=["t"])


def test_a_reader_opens_two_small_files_however_long_the_history(spark, tmp_path, monkeypatch):
    from ordermill.plans import store as S
    store = Store(spark, str(tmp_path / "lake"))
    store.publish({"other": spark.createDataFrame([(0,)], "k long")}, "first")
    for i in range(300):                                    # commits without data: only the log grows
        store._publish(store.head(), {"t": lambda layout, at: {"folders": [], "more": None, "schema": "{}"}}, [], f"r{i}")
    opened = []
    read = S.Files.read
    monkeypatch.setattr(S.Files, "read", lambda self, path: opened.append(path) or read(self, path))
    assert store.head() == 301 and store.read("other").count() == 1
    assert len(opened) <= 4                                 # the hint twice, the head, the table's own commit


def test_stale_hint_is_only_a_starting_point(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    for i in range(3):
        store.publish({"t": spark.createDataFrame([(i,)], "k long")}, f"r{i}", appends=["t"])
    (tmp_path / "lake" / "_head").write_text("1")
    (tmp_path / "lake" / "._head.crc").unlink(missing_ok=True)
    assert store.head() == 3 and store.read("t").count() == 3
