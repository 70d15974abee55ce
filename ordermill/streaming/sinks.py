"""Idempotent ``foreachBatch`` sinks.

Structured Streaming gives at-least-once delivery into ``foreachBatch``: after a
failure the last micro-batch is replayed from the checkpoint. Every sink here
is an idempotent merge against the committed state, written to a folder of its
own, so a replayed batch — also under the same batch id, or after a lost
checkpoint — changes nothing. The checkpoint replaces manual offset commits:
offsets advance only after the batch function returned.

Each micro-batch is read from its source once: a sink writes the checked rows as a
work table and every later step reads that. The counts of the audit row
(``stream_audit``) are observed by these writes and published with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators import merge as M
from ordermill.operators.dedupe import latest_per_key
from ordermill.operators.events import parse_envelope
from ordermill.operators.rules import ERRORS, EVENTS, LOCAL, MALFORMED, RuleSet, apply_rules, to_orders
from ordermill.plans.observed import counted_write
from ordermill.plans.store import Store

EVENT_SILVER_COLS = ("order_id", "customer_id", "status", "amount_cents", "updated_at", "eventhub_partition",
                     "kafka_offset", "enqueued_at", "ingested_at")
EVENT_ORDER = ["updated_at", "enqueued_at", "eventhub_partition", "kafka_offset"]
EVENT_SILVER_SCHEMA = ("order_id string, customer_id string, status string, amount_cents bigint, "
                       "updated_at timestamp_ntz, eventhub_partition int, kafka_offset bigint, "
                       "enqueued_at timestamp_ntz, ingested_at timestamp")
BRONZE_SCHEMA = ("raw_json string, eventhub_partition int, kafka_offset bigint, enqueued_at timestamp_ntz, "
                 "ingested_at timestamp")
BRONZE_REJECT_SCHEMA = ("raw_json string, eventhub_partition int, kafka_offset bigint, enqueued_at timestamp_ntz, "
                        "error_message string")
EVENT_QUARANTINE_SCHEMA = BRONZE_REJECT_SCHEMA + ", quarantined_at timestamp"
AUDIT = "stream_audit"
AUDIT_SCHEMA = ("sink string, batch_id bigint, content bigint, rows_read bigint, rows_copied bigint, rows_rejected bigint, "
                "audited_at timestamp")


def once(store: Store, rows: DataFrame, *identity: str) -> tuple[DataFrame, int, int]:
    """The rows of a micro-batch as a written work table, their number, and a number made of their contents."""
    path = f"{store.root}/_work/{uuid.uuid4().hex}"
    # a sum of 31-bit digests: it does not depend on the order of the rows, and repeats count
    content = F.sum(F.pmod(F.xxhash64(*identity), F.lit(1 << 31)))
    seen = counted_write(rows, lambda df: df.write.parquet(path), content=content)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), seen["rows"], seen.get("content", 0)


def audit_row(store: Store, sink: str, batch_id: int, content: int, read: int, copied: int, rejected: int) -> DataFrame:
    """The audit row of a batch; none if these very rows have been audited for this sink before (a replay)."""
    row = store.spark.createDataFrame([(sink, batch_id, content, read, copied, rejected)], ", ".join(AUDIT_SCHEMA.split(", ")[:-1]))
    known = store.read(AUDIT, AUDIT_SCHEMA)
    return M.new_rows(known, row, ["sink", "content", "rows_read"]).withColumn("audited_at", F.current_timestamp())


def _run_id(batch_id: int, prefix: str) -> str:
    """Recorded in the commit only: commits are numbered by the store, and a repeated id overwrites nothing."""
    return f"{prefix}-{batch_id:012d}"


class BronzeSink:
    """Insert-only merge of envelopes on (partition, offset) into the bronze table.

    Rows without a partition or offset have no identity there: they go to ``<table>_rejects``,
    each different row once.
    """

    keys = ["eventhub_partition", "kafka_offset"]

    def __init__(self, store: Store, table: str = "bronze_events", prefix: str | None = None):
        self.store, self.table = store, table
        self.prefix = prefix or table
        self.batches = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.store.head()
        cols = ["raw_json", "eventhub_partition", "kafka_offset", "enqueued_at"]
        batch, read, content = once(self.store, batch.select(*cols), *cols)
        if not read:
            return
        # per topic partition (a few rows) the lowest offset of the batch: only stored rows at or above it
        # can match, and the bound reaches parquet as a pushed filter that skips row groups
        lows = batch.groupBy("eventhub_partition").agg(F.min("kafka_offset").alias("low")).collect()
        has_place = F.col("eventhub_partition").isNotNull() & F.col("kafka_offset").isNotNull()
        rows = batch.filter(has_place).dropDuplicates(self.keys).withColumn("ingested_at", F.current_timestamp())
        reach = F.lit(False)
        for r in lows:
            if r["eventhub_partition"] is not None and r["low"] is not None:
                reach = reach | ((F.col("eventhub_partition") == r["eventhub_partition"]) & (F.col("kafka_offset") >= r["low"]))
        target, rejects = self.store.read(self.table, BRONZE_SCHEMA), f"{self.table}_rejects"
        bad = batch.filter(~has_place).withColumn("error_message", F.lit("missing topic coordinates")).distinct()
        self.store.publish({
            self.table: M.new_rows(target, rows, self.keys, null_safe=False, bound=reach),
            rejects: M.new_rows(self.store.read(rejects, BRONZE_REJECT_SCHEMA), bad, cols),
            AUDIT: lambda n: audit_row(self.store, self.table, batch_id, content, read, n[self.table], n[rejects]),
        }, _run_id(batch_id, self.prefix), appends=[self.table, rejects, AUDIT], shared=[AUDIT], seen=seen)
        self.batches += 1


class EventSilverSink:
    """Parse -> event rules -> newest per id -> upsert where newer; invalid events and broken
    messages go to ``<table>_quarantine`` with their raw text, each topic position once.

    "Newer" is the full 4-level order (time, enqueue time, partition, offset): the
    upstream rule stops after enqueue time, which would let the micro-batch split
    decide between events equal on both; a total order makes per-batch ranking
    plus merge associative, so the stream equals the batch result."""

    def __init__(self, store: Store, table: str = "silver_events", rules: RuleSet = EVENTS, prefix: str | None = None):
        self.store, self.table, self.rules = store, table, rules
        self.prefix = prefix or table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.store.head()
        keep = ("eventhub_partition", "kafka_offset", "enqueued_at")
        checked = apply_rules(parse_envelope(batch, keep=("raw_json", *keep), flag_malformed=False, corrupt=MALFORMED), self.rules)
        checked, read, content = once(self.store, checked, "raw_json", *keep)
        if not read:
            return
        valid = to_orders(checked.filter(F.col(ERRORS) == ""), keep).withColumn("ingested_at", F.current_timestamp())
        bad = checked.filter(F.col(ERRORS) != "").select("raw_json", *keep, F.col(ERRORS).alias("error_message")).distinct()
        target = self.store.read(self.table, EVENT_SILVER_SCHEMA)
        changes = M.upsert_changes(target, valid.select(*EVENT_SILVER_COLS), ["order_id"], EVENT_ORDER,
                                   source_order=EVENT_ORDER).drop(M.CHANGE)
        quarantine = f"{self.table}_quarantine"
        added = M.new_rows(self.store.read(quarantine, EVENT_QUARANTINE_SCHEMA), bad, ["eventhub_partition", "kafka_offset", "raw_json"])
        self.store.publish({
            quarantine: added.withColumn("quarantined_at", F.current_timestamp()), self.table: changes,
            AUDIT: lambda n: audit_row(self.store, self.table, batch_id, content, read, n[self.table], n[quarantine]),
        }, _run_id(batch_id, self.prefix), appends=[quarantine, AUDIT], upserts={self.table: ["order_id"]}, shared=[AUDIT], seen=seen)


class OrderMessageSink:
    """Single JSON order messages through the first-error rules into orders + rejected orders
    (upsert if newer, insert-ignore rejects; a broken message is one reject with its raw text),
    one atomic publish per micro-batch."""

    def __init__(self, store: Store, rules: RuleSet = LOCAL, prefix: str = "messages"):
        self.store, self.rules, self.prefix = store, rules, prefix

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from ordermill.plans.runs import BATCH_ORDER, ORDERS_TABLE, REJECTS_TABLE, load
        seen = self.store.head()
        checked = apply_rules(batch, self.rules)
        checked, read, content = once(self.store, checked, *batch.columns)
        if not read:
            return
        valid = latest_per_key(to_orders(checked.filter(F.col(ERRORS) == "")), ["order_id"], BATCH_ORDER)
        load(self.store, checked, valid, _run_id(batch_id, self.prefix), None, {
            AUDIT: lambda n: audit_row(self.store, self.prefix, batch_id, content, read, n[ORDERS_TABLE], n[REJECTS_TABLE])}, seen)
