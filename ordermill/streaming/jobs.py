"""Drain-and-stop streaming jobs and the topic publish side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ordermill.operators.events import build_envelope


def run_available_now(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                      name: str | None = None, timeout_s: float | None = None):
    """Process everything available now in micro-batches, then stop (checkpointed offsets)."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def publish_topic(rows: DataFrame, bootstrap: str, topic: str, key: str = "order_id") -> None:
    """Publish rows as (key, JSON value) messages; idempotent, all-acks producer settings."""
    (build_envelope(rows, key).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())


def publish_files(rows: DataFrame, path: str, key: str = "order_id") -> None:
    """Local stand-in for a topic: append (key, value) messages as JSON files."""
    build_envelope(rows, key).write.mode("append").json(path)


def chain_sinks(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One foreachBatch callback running several idempotent sinks on the same micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(batch, batch_id)
    return run


def run_event_job(store, stream: DataFrame, checkpoint: str, run_id: str, enforce_gate: bool = True) -> DataFrame:
    """The event job: drain the topic into bronze and silver, rebuild the gold totals, gate.

    Each micro-batch goes to the bronze sink (insert-only on topic coordinates) and the
    silver sink (newest per order, upsert as change rows); then the one-row gold table is
    replaced (create-or-replace) and the five checks run. Returns the check rows; raises
    ``QualityError`` listing failures when ``enforce_gate``.
    """
    from ordermill.operators.metrics import total_metrics
    from ordermill.operators.quality import enforce, event_gate
    from ordermill.streaming.sinks import BronzeSink, EventSilverSink
    bronze, silver = BronzeSink(store), EventSilverSink(store)
    run_available_now(stream, chain_sinks(bronze, silver), checkpoint)
    silver_df = store.read(silver.table)

    def gate(paths: dict[str, str]) -> None:              # before the commit: bad gold never becomes visible
        if enforce_gate:
            enforce(event_gate(silver_df, store.spark.read.parquet(paths["gold_event_metrics"])))

    store.publish({"gold_event_metrics": total_metrics(silver_df, stamp=True)}, run_id, hook=gate, operation="OVERWRITE")
    return event_gate(silver_df, store.read("gold_event_metrics"))
