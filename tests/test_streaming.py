import itertools
import json

import pytest
from pyspark.sql import functions as F

from ordermill.plans.registry import QUERIES
from ordermill.plans.runs import ORDERS_TABLE, REJECTS_TABLE, BRONZE, ingest_bronze
from ordermill.plans.store import Store
from ordermill.sources.orderfeed import event_envelope, load_tables, raw_orders
from ordermill.streaming.jobs import publish_files, run_available_now
from ordermill.streaming.sinks import BronzeSink, EventSilverSink, OrderMessageSink
from ordermill.streaming.sources import read_envelope_files, read_order_files, read_order_messages

from tests.conftest import DAY1, DAY2, write_csv

SF = "/root/testdata/sf0.001"
COLS = ["raw_json", "eventhub_partition", "kafka_offset", "enqueued_at"]


def _envelope(spark):
    (orders,) = load_tables(spark, SF, "orders")
    return event_envelope(raw_orders(orders))


def test_bronze_stream_is_idempotent(spark, tmp_path):
    env = _envelope(spark)
    inbox = str(tmp_path / "inbox")
    env.select(*COLS).repartition(4).write.parquet(inbox)
    store = Store(spark, str(tmp_path / "lake"))
    sink = BronzeSink(store)
    run_available_now(read_envelope_files(spark, inbox, max_files_per_trigger=1), sink, str(tmp_path / "ck1"))
    n = env.count()
    assert store.read("bronze_events").count() == n
    assert sink.batches >= 4
    # same checkpoint: nothing new; lost checkpoint: everything replayed, nothing added
    run_available_now(read_envelope_files(spark, inbox), sink, str(tmp_path / "ck1"))
    run_available_now(read_envelope_files(spark, inbox), BronzeSink(store, prefix="replay"), str(tmp_path / "ck2"))
    assert store.read("bronze_events").count() == n
    assert store.read("bronze_events").select("eventhub_partition", "kafka_offset").distinct().count() == n


def test_silver_sink_is_batch_order_independent(spark, tmp_path):
    env = _envelope(spark).select(*COLS, "_batch")
    parts = [env.filter(F.col("_batch") == b).drop("_batch") for b in (0, 1)]
    want = {tuple(r) for r in QUERIES["latest_per_key_tiebreak"](spark, SF).collect()}
    for i, perm in enumerate(itertools.permutations(parts)):
        store = Store(spark, str(tmp_path / f"lake{i}"))
        sink = EventSilverSink(store)
        for bid, part in enumerate(perm):
            sink(part, bid)
        sink(perm[-1], 99)                                  # a replayed batch changes nothing
        got = store.read("silver_events").select(
            "order_id", "status", "amount_cents",
            F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
            F.date_format("enqueued_at", "yyyy-MM-dd HH:mm:ss").alias("enqueued_at"),
            "eventhub_partition", "kafka_offset")
        assert {tuple(r) for r in got.collect()} == want


def test_new_file_discovery_feeds_bronze(spark, tmp_path):
    raw = tmp_path / "raw"
    write_csv(raw, "orders_2026-08-01.csv", DAY1)
    write_csv(raw, "orders_2026-08-02.csv", DAY2)
    write_csv(raw, "ignore_me.csv", "X,C,PAID,1,2026-08-01T00:00:00")
    store = Store(spark, str(tmp_path / "lake"))

    def sink(batch, bid):
        ingest_bronze(store, batch, f"files-{bid:06d}")

    run_available_now(read_order_files(spark, str(raw), max_files_per_trigger=1), sink, str(tmp_path / "ck"))
    assert store.read(BRONZE).count() == 13


def test_order_message_consumer(spark, tmp_path):
    msgs = tmp_path / "topic"
    msgs.mkdir()
    rows = [dict(zip(["order_id", "customer_id", "status", "amount_cents", "updated_at"], line.split(",")))
            for line in DAY1.splitlines()]
    (msgs / "m1.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n{poison\nnot json\n[1\n")
    store = Store(spark, str(tmp_path / "lake"))
    run_available_now(read_order_messages(spark, str(msgs)), OrderMessageSink(store), str(tmp_path / "ck"))
    assert store.read(ORDERS_TABLE).count() == 4
    rejects = store.read(REJECTS_TABLE)
    assert rejects.count() == 7                            # the four bad orders and every poison message, with its text
    assert {r["raw_row"] for r in rejects.collect()} >= {"{poison", "not json", "[1"}
    out = tmp_path / "published"
    publish_files(store.read(ORDERS_TABLE), str(out))
    back = spark.read.json(str(out)).collect()
    assert sorted(r["key"] for r in back) == ["ORD-1001", "ORD-1002", "ORD-1004", "ORD-1008"]
    assert json.loads(back[0]["value"]).keys() == {"order_id", "customer_id", "status", "amount_cents", "updated_at"}


def test_replayed_batch_ids_and_lost_checkpoints_lose_nothing(spark, tmp_path):
    env = _envelope(spark).select(*COLS, "_batch")
    old, new = [env.filter(F.col("_batch") == b).drop("_batch") for b in (0, 1)]
    store = Store(spark, str(tmp_path / "lake"))
    for sink in (BronzeSink(store), EventSilverSink(store)):
        sink(old, 0)
        rows = store.read(sink.table).count()
        assert rows > 0
        sink(old, 0)                                        # the same batch under the same id
        assert store.read(sink.table).count() == rows
        type(sink)(store)(new, 0)                           # a restarted query counts from 0 again
    assert store.read("bronze_events").count() == env.count()
    want = QUERIES["latest_per_key_tiebreak"](spark, SF)
    assert store.read("silver_events").count() == want.count()


def test_each_batch_is_audited_once_with_what_it_did(spark, tmp_path):
    from ordermill.streaming.sinks import AUDIT
    env = _envelope(spark).select(*COLS, "_batch")
    old, new = [env.filter(F.col("_batch") == b).drop("_batch") for b in (0, 1)]
    store = Store(spark, str(tmp_path / "lake"))
    sink = BronzeSink(store)
    for batch, i in ((old, 0), (old, 0), (old.limit(0), 1), (old.unionAll(new), 2), (old.unionAll(new), 0)):
        sink(batch, i)
    n = {b: batch.count() for b, batch in ((0, old), (2, old.unionAll(new)))}
    assert sorted((r["batch_id"], r["rows_read"], r["rows_copied"]) for r in store.read(AUDIT).collect()) == [(0, n[0], n[0]), (2, n[2], n[2] - n[0])]


def test_failed_chain_is_replayed_whole(spark, tmp_path):
    from ordermill.streaming.jobs import chain_sinks
    env = _envelope(spark).select(*COLS)
    inbox = str(tmp_path / "inbox")
    env.coalesce(1).write.parquet(inbox)
    store = Store(spark, str(tmp_path / "lake"))

    def fail(batch, bid):
        raise RuntimeError("simulated")

    with pytest.raises(Exception, match="simulated"):
        run_available_now(read_envelope_files(spark, inbox), chain_sinks(BronzeSink(store), fail), str(tmp_path / "ck"))
    run_available_now(read_envelope_files(spark, inbox), chain_sinks(BronzeSink(store)), str(tmp_path / "ck"))
    assert store.read("bronze_events").count() == env.count()


def test_rows_without_coordinates_are_kept_as_rejects(spark, tmp_path):
    from datetime import datetime
    t = datetime(2026, 8, 1)
    rows = [("{}", 0, 1, t), ("{}", None, 5, t), ("{}", 0, None, t), ("x", None, None, t), ("x", None, None, t)]
    batch = spark.createDataFrame(rows, "raw_json string, eventhub_partition int, kafka_offset bigint, enqueued_at timestamp_ntz")
    store = Store(spark, str(tmp_path / "lake"))
    sink = BronzeSink(store)
    for part in (batch, batch, batch.filter("kafka_offset is null and eventhub_partition is null")):
        sink(part, 0)
    assert store.read("bronze_events").count() == 1
    assert store.read("bronze_events_rejects").count() == 3
