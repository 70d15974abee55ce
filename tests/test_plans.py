"""Plan-shape assertions: the physical plans we rely on for scale."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators.incremental import after_watermark
from ordermill.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    p = plan(QUERIES["latest_per_key"](spark, SF))
    partial = p.index("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # textual plan lists parents first: Final ... Exchange ... Partial
    assert p.rfind("Exchange hashpartitioning") < p.rfind("Partial")
    assert partial >= 0


def test_null_safe_merge_is_hash_anti_join(spark):
    p = plan(QUERIES["merge_null_safe"](spark, SF))
    assert "LeftAnti" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


# queries that execute whole runs and return a plain read of what they stored
RUNS = {"stream_bronze", "stream_silver", "stream_bronze_replay", "stream_silver_restart", "stream_order_files", "event_job",
        "incremental_run", "incremental_rerun", "replay_run", "mixed_writers", "order_messages", "event_quarantine", "staging_run",
        "dq_report_by_run", "full_load_run", "reprocess_run", "run_history", "order_lookup", "csv_roundtrip", "daily_metrics_signed",
        "total_metrics_signed", "status_summary_signed", "merge_bucketed", "stream_audit", "file_ledger", "run_state_transitions",
        "csv_malformed", "csv_inferred", "blob_roundtrip", "catalog_gold", "overwrite_schema", "duplicate_id_table"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_watermark_filter_and_pruning_reach_parquet(spark, tmp_path):
    silver = QUERIES["latest_per_key"](spark, SF)
    path = str(tmp_path / "silver")
    (spark.createDataFrame([("A", "2026-08-01 10:00:00")], "order_id string, updated_at string")
     .selectExpr("order_id", "CAST(updated_at AS TIMESTAMP_NTZ) AS updated_at", "'x' AS status")
     .write.parquet(path))
    df = after_watermark(spark.read.parquet(path), "updated_at", "2026-08-01T08:00:00").select("order_id")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at" in p
    assert "ReadSchema: struct<order_id:string,updated_at:timestamp_ntz>" in p
    daily = plan(QUERIES["daily_metrics"](spark, SF))
    assert "o_orderpriority" not in daily                     # unused columns are never read
    assert silver is not None


def test_change_rows_read_only_batch_keys_of_the_base(spark, tmp_path):
    from ordermill.operators import merge as M
    from ordermill.plans.store import Store
    store = Store(spark, str(tmp_path / "lake"), buckets=4)
    base = spark.range(0, 20000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("order_id"),
                                        F.lit("x").alias("status"), F.lit(1).alias("payload"),
                                        F.current_timestamp().cast("timestamp_ntz").alias("updated_at"))
    store.publish({"t": base}, "r000", rebuilds={"t": ["order_id"]})
    later = base.limit(50).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR"))
    store.publish({"t": M.upsert_changes(store.read("t"), later, ["order_id"], ["updated_at"]).drop(M.CHANGE)},
                  "r001", upserts={"t": ["order_id"]})
    batch = base.limit(10).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 2 HOUR"))
    ch = M.upsert_changes(store.read("t"), batch, ["order_id"], ["updated_at"])
    assert ch.count() == 10
    p = plan(ch)
    # the table is read pruned to key + compare column and filtered by a semi join
    assert "ReadSchema: struct<order_id:string,updated_at:timestamp_ntz>" in p
    assert "LeftSemi" in p and store.read("t").count() == 20000


def test_gates_compute_silver_once(spark):
    for name in ("quality_gate", "reconcile_gold"):
        p = plan(QUERIES[name](spark, SF))
        assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning(order_id") == 1, name


def test_insert_only_merge_follows_the_batch(spark, tmp_path):
    from ordermill.operators import merge as M
    path = str(tmp_path / "t")
    spark.range(0, 50000).selectExpr("id % 1000 as k", "id as payload").write.parquet(path)
    batch = spark.createDataFrame([(5,), (5000,), (None,)], "k long")
    added = M.new_rows(spark.read.parquet(path), batch, ["k"])
    assert sorted((r["k"] or 0) for r in added.collect()) == [0, 5000]
    p = plan(added)
    assert "LeftAnti" in p and "payload" not in p and "Aggregate" not in p
    bounded = M.new_rows(spark.read.parquet(path), batch, ["k"], bound=M.values_bound(batch, "k"))
    assert sorted((r["k"] or 0) for r in bounded.collect()) == [0, 5000]
    assert "PushedFilters: [Or(In(k, [5,5000])" in plan(bounded)


def test_bronze_ingest_reads_the_files_of_its_batch_only(spark, tmp_path):
    from ordermill.operators import merge as M
    from ordermill.plans.runs import BRONZE, ingest_bronze
    from ordermill.plans.store import Store
    store = Store(spark, str(tmp_path / "lake"))
    raw = QUERIES["slice_by_file"](spark, SF).drop("_k", "_version").withColumn("_ingested_at", F.current_timestamp())
    for name in ("a.csv", "b.csv", "c.csv"):
        ingest_bronze(store, raw.withColumn("_source_file", F.lit(name)), name)
    batch = raw.withColumn("_source_file", F.lit("b.csv"))
    keys = ["_source_file", "order_id", "updated_at"]
    added = M.new_rows(store.read(BRONZE), batch, keys, bound=M.values_bound(batch, "_source_file"))
    assert added.count() == 0
    p = plan(added)
    assert "PartitionFilters: [" in p and "(_source_file" in p.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_signed_gold_reads_the_state_only_by_the_keys_of_the_batch(spark, tmp_path):
    from ordermill.operators import merge as M
    from ordermill.operators.metrics import add_signed, daily_metrics, signed_daily
    path = str(tmp_path / "state")
    QUERIES["full_load_run"](spark, SF).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")).write.parquet(path)
    state = spark.read.parquet(path)
    daily_metrics(state).write.parquet(str(tmp_path / "gold"))
    state.limit(5).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR")).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    signed = M.signed_changes(state, batch, ["order_id"], ["updated_at"])
    gold = add_signed(spark.read.parquet(str(tmp_path / "gold")), signed_daily(signed), ["report_date"], rows="total_orders")
    got = {tuple(r) for r in gold.collect()}
    assert got == {tuple(r) for r in daily_metrics(M.apply_changes(state, signed.filter("_sign > 0"), ["order_id"])).collect()}
    p = plan(gold).split("Initial Plan")[-1]
    assert p.count("/state]") == 1 and "LeftSemi" in p    # only the rows that the batch meets
