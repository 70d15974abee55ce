"""Registered queries: name -> (Spark query, reference SQL).

Every query reads the benchmark tables under ``sf_dir`` whole (``orders``,
``customer``, ``events``) and derives the order feed from them, so its work
grows with the data. Temporal outputs are rendered as text so both engines
print them identically. Batches are the two versions of each order
(``_version`` 0 = existing state, 1 = incoming batch), never subsets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.json import raw_row_json
from ordermill.functions.money import cents_to_amount
from ordermill.operators import merge as M
from ordermill.operators import quality as Q
from ordermill.operators.dedupe import duplicate_keys, latest_per_key, surplus_duplicates
from ordermill.operators.events import build_envelope, parse_envelope
from ordermill.operators.incremental import after_watermark, increment_vs_target, replay_window
from ordermill.operators.metrics import daily_metrics, daily_metrics_display, status_summary, total_metrics, with_amount
from ordermill.operators.rules import (ERRORS, EVENTS, LAKEHOUSE, LOCAL, STAGING, apply_rules, rejected_rows,
                                       to_orders, valid_rows)
from ordermill.operators.audit import run_state
from ordermill.plans import oracle as O
from ordermill.schema import ALLOWED_STATUSES
from ordermill.session import scratch_path
from ordermill.sources.files import slice_by_file, status_dimension
from ordermill.sources.bronze import bronze
from ordermill.sources.orderfeed import load_tables, run_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ts_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# Parameters of the registered queries (fixed values of the check, not data subsets).
WATERMARK = "1996-06-30T00:00:00"
REPLAY_START, REPLAY_END = "1995-01-01T00:00:00", "1996-01-01T00:00:00"
SLICE_FILE = "orders_1995.csv"
ORDER_COLS = ("order_id", "customer_id", "status", "amount_cents", "updated_at")
LINEAGE = ("_source_file", "_loaded_at")
# Total order for "latest": time, then load time, then file name (all descending).
LATEST_ORDER = ("updated_at", "_loaded_at", "_source_file")
EVENT_ORDER = ("updated_at", "enqueued_at", "eventhub_partition", "kafka_offset")
EVENT_COLS = ORDER_COLS + ("eventhub_partition", "kafka_offset", "enqueued_at")


# ---------------------------------------------------------------------------
# Shared derivations
# ---------------------------------------------------------------------------

def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze raw orders derived from ``orders`` (stored once per session)."""
    return bronze(spark, sf, "raw_orders")


def _envelope(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "event_envelope")


def _checked(spark, sf, rules=LAKEHOUSE) -> DataFrame:
    return apply_rules(_raw(spark, sf), rules)


def _orders_of(checked: DataFrame, keep=LINEAGE + ("_version",)) -> DataFrame:
    return to_orders(valid_rows(checked), keep)


def _silver(orders: DataFrame) -> DataFrame:
    return latest_per_key(orders, ["order_id"], list(LATEST_ORDER))


def _events(spark, sf) -> DataFrame:
    env = _envelope(spark, sf)
    return apply_rules(parse_envelope(env, keep=("eventhub_partition", "kafka_offset", "enqueued_at", "_batch")),
                       EVENTS)


def _valid_events(spark, sf) -> DataFrame:
    return to_orders(valid_rows(_events(spark, sf)), ("eventhub_partition", "kafka_offset", "enqueued_at", "_batch"))


def _event_silver(events: DataFrame) -> DataFrame:
    return latest_per_key(events, ["order_id"], list(EVENT_ORDER))


_CODED_SQL = (O.RAW_ORDERS, O.CODED)
_SILVER_SQL = """
silver AS (
  SELECT order_id, customer_id, status, amt AS amount_cents, ts AS updated_at, _source_file, _loaded_at, _version
  FROM coded WHERE _error_reason = ''
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, _loaded_at DESC, _source_file DESC) = 1
)"""
_EVENT_SILVER_SQL = """
event_silver AS (
  SELECT * FROM valid_events
  QUALIFY row_number() OVER (PARTITION BY order_id
                             ORDER BY updated_at DESC, enqueued_at DESC, eventhub_partition DESC, kafka_offset DESC) = 1
)"""
_EVENT_SQL = (O.RAW_ORDERS, O.EVENT_ENVELOPE, O.PARSED_EVENTS)


def _count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_DAILY_SQL = f"""
daily AS (
  SELECT CAST(updated_at AS DATE) AS report_date, COUNT(*) AS total_orders,
         CAST(SUM(amount_cents) AS BIGINT) AS total_amount_cents,
         {_count_if("status = 'PAID'")} AS paid_orders, {_count_if("status = 'SHIPPED'")} AS shipped_orders,
         {_count_if("status = 'PENDING'")} AS pending_orders, {_count_if("status = 'CANCELLED'")} AS cancelled_orders,
         CAST(SUM(CASE WHEN status = 'PAID' THEN amount_cents ELSE 0 END) AS BIGINT) AS paid_amount_cents
  FROM silver GROUP BY 1
)"""


# ---------------------------------------------------------------------------
# Metrics (AG1-AG4, X11, J-L)
# ---------------------------------------------------------------------------

def _gold(spark, sf) -> DataFrame:
    return daily_metrics(_silver(_orders_of(_checked(spark, sf))))


@register("daily_metrics", O.with_ctes(*_CODED_SQL, _SILVER_SQL, _DAILY_SQL, body="""
SELECT CAST(report_date AS VARCHAR) AS report_date, total_orders, total_amount_cents, paid_orders, shipped_orders,
       pending_orders, cancelled_orders, paid_amount_cents FROM daily"""))
def q_daily_metrics(spark, sf):
    return _gold(spark, sf).withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


@register("daily_metrics_eur", O.with_ctes(*_CODED_SQL, _SILVER_SQL, _DAILY_SQL, body="""
SELECT CAST(report_date AS VARCHAR) AS report_date, total_orders,
       round(CAST(total_amount_cents AS DOUBLE) / 100.0, 2) AS total_amount_eur,
       paid_orders, shipped_orders, pending_orders, cancelled_orders,
       round(CAST(paid_amount_cents AS DOUBLE) / 100.0, 2) AS paid_amount_eur FROM daily"""))
def q_daily_metrics_eur(spark, sf):
    return daily_metrics_display(_gold(spark, sf)).withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


@register("total_metrics", O.with_ctes(*_EVENT_SQL, _EVENT_SILVER_SQL, body=f"""
SELECT COUNT(*) AS total_orders, CAST(coalesce(SUM(amount_cents), 0) AS BIGINT) AS total_amount_cents,
       {_count_if("status = 'PENDING'")} AS pending_orders, {_count_if("status = 'PAID'")} AS paid_orders,
       {_count_if("status = 'SHIPPED'")} AS shipped_orders, {_count_if("status = 'CANCELLED'")} AS cancelled_orders
FROM event_silver"""))
def q_total_metrics(spark, sf):
    return total_metrics(_event_silver(_valid_events(spark, sf)))


def _summary_sql(omit: tuple[str, ...]) -> str:
    from ordermill.schema import STATUS_LABELS
    rows = ", ".join(f"('{s}', '{lab}')" for s, lab in STATUS_LABELS if s not in omit)
    return O.with_ctes(*_CODED_SQL, _SILVER_SQL, f"statuses AS (SELECT * FROM (VALUES {rows}) v(status, status_label))",
                       body="""
SELECT o.status, st.status_label, COUNT(*) AS order_count,
       round(SUM(CAST(o.amount_cents AS DOUBLE) / 100.0), 2) AS total_amount
FROM silver o LEFT JOIN statuses st ON o.status = st.status
GROUP BY o.status, st.status_label""")


def _q_summary(spark, sf, statuses):
    orders = with_amount(_silver(_orders_of(_checked(spark, sf))))
    out = status_summary(orders, statuses)
    return out.withColumn("total_amount", F.round("total_amount", 2))


@register("status_summary", _summary_sql(()))
def q_status_summary(spark, sf):
    return _q_summary(spark, sf, status_dimension(spark))


@register("status_summary_partial_dim", _summary_sql(("CANCELLED",)))
def q_status_summary_partial(spark, sf):
    return _q_summary(spark, sf, status_dimension(spark, ("CANCELLED",)))


# ---------------------------------------------------------------------------
# Validation and quarantine (V1-V4, F5, F6, Q1, X6, X13, X18)
# ---------------------------------------------------------------------------

@register("validate_first_error", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, body=f"""
SELECT _k, _version, order_id, error_message, {O.RAW_ROW_JSON} AS raw_row
FROM first_error WHERE error_message <> ''"""))
def q_validate_first_error(spark, sf):
    rej = rejected_rows(_checked(spark, sf, LOCAL))
    return rej.select("_k", "_version", "order_id", F.col(ERRORS).alias("error_message"), raw_row_json().alias("raw_row"))


@register("validate_all_errors", O.with_ctes(*_CODED_SQL, body=f"""
SELECT _k, _version, order_id, _error_reason, amt AS amount_cents, {O.ts_text('ts')} AS updated_at FROM coded"""))
def q_validate_all_errors(spark, sf):
    c = _checked(spark, sf)
    return c.select("_k", "_version", "order_id", F.col(ERRORS).alias("_error_reason"),
                    F.col("_amount_cents").alias("amount_cents"), ts_text("_updated_at").alias("updated_at"))


@register("validate_normalised", O.with_ctes(O.RAW_ORDERS, O.STAGED, body="""
SELECT _k, _version, trim(order_id, ' ') AS order_id, trim(customer_id, ' ') AS customer_id, upper(trim(status, ' ')) AS status,
       amt32 AS amount_cents, error_message FROM staged"""))
def q_validate_normalised(spark, sf):
    c = _checked(spark, sf, STAGING)
    return c.select("_k", "_version", F.col("_order_id").alias("order_id"), F.col("_customer_id").alias("customer_id"),
                    F.col("_status").alias("status"), F.col("_amount_cents").alias("amount_cents"),
                    F.col(ERRORS).alias("error_message"))


@register("quarantine_rows", O.with_ctes(*_CODED_SQL, body=f"""
SELECT order_id, customer_id, status, amount_cents, updated_at, _source_file, _error_reason, {O.RAW_ROW_JSON} AS raw_row
FROM coded WHERE _error_reason <> ''"""))
def q_quarantine_rows(spark, sf):
    from ordermill.operators.rules import to_quarantine
    q = to_quarantine(rejected_rows(_checked(spark, sf)), lineage=("_source_file",), stamp=False)
    return q.withColumn("raw_row", raw_row_json())


@register("event_valid", O.with_ctes(*_EVENT_SQL, body=f"""
SELECT order_id, customer_id, status, amount_cents, {O.ts_text('updated_at')} AS updated_at,
       eventhub_partition, kafka_offset, {O.ts_text('enqueued_at')} AS enqueued_at FROM valid_events"""))
def q_event_valid(spark, sf):
    v = _valid_events(spark, sf)
    return v.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    "eventhub_partition", "kafka_offset", ts_text("enqueued_at").alias("enqueued_at"))


@register("parse_events", O.with_ctes(*_EVENT_SQL, body="""
SELECT order_id, customer_id, status, amount_text, updated_text, malformed, eventhub_partition, kafka_offset
FROM parsed_events"""))
def q_parse_events(spark, sf):
    p = parse_envelope(_envelope(spark, sf))
    return p.select("order_id", "customer_id", "status", F.col("amount_cents").alias("amount_text"),
                    F.col("updated_at").alias("updated_text"), F.col("_malformed").alias("malformed"),
                    "eventhub_partition", "kafka_offset")


@register("build_events", O.with_ctes(O.RAW_ORDERS, body="""
SELECT order_id AS key,
       json_object('order_id', order_id, 'customer_id', customer_id, 'status', status,
                   'amount_cents', amount_cents, 'updated_at', updated_at)::VARCHAR AS value
FROM raw_orders"""))
def q_build_events(spark, sf):
    return build_envelope(_raw(spark, sf))


# ---------------------------------------------------------------------------
# Deduplication (W1-W4, AG5, AG6, D1)
# ---------------------------------------------------------------------------

@register("latest_per_key", O.with_ctes(*_CODED_SQL, _SILVER_SQL, body=f"""
SELECT order_id, customer_id, status, amount_cents, {O.ts_text('updated_at')} AS updated_at, _source_file FROM silver"""))
def q_latest_per_key(spark, sf):
    s = _silver(_orders_of(_checked(spark, sf)))
    return s.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    "_source_file")


@register("latest_per_key_tiebreak", O.with_ctes(*_EVENT_SQL, _EVENT_SILVER_SQL, body=f"""
SELECT order_id, status, amount_cents, {O.ts_text('updated_at')} AS updated_at,
       {O.ts_text('enqueued_at')} AS enqueued_at, eventhub_partition, kafka_offset FROM event_silver"""))
def q_latest_tiebreak(spark, sf):
    s = _event_silver(_valid_events(spark, sf))
    return s.select("order_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    ts_text("enqueued_at").alias("enqueued_at"), "eventhub_partition", "kafka_offset")


@register("latest_normalised", O.with_ctes(O.RAW_ORDERS, O.STAGED, body=f"""
SELECT trim(order_id, ' ') AS order_id, trim(customer_id, ' ') AS customer_id, upper(trim(status, ' ')) AS status,
       amt32 AS amount_cents, {O.ts_text('ts')} AS updated_at, _source_file
FROM staged WHERE error_message = ''
QUALIFY row_number() OVER (PARTITION BY trim(order_id, ' ') ORDER BY ts DESC, _loaded_at DESC, _source_file DESC) = 1"""))
def q_latest_normalised(spark, sf):
    o = _orders_of(_checked(spark, sf, STAGING))
    s = latest_per_key(o, ["order_id"], list(LATEST_ORDER))
    return s.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    "_source_file")


@register("superseded_count", O.with_ctes(*_CODED_SQL, body="""
SELECT bronze_rows, valid_rows, quarantine_rows, silver_rows, valid_rows - silver_rows AS superseded_rows,
       bronze_rows = silver_rows + quarantine_rows + (valid_rows - silver_rows) AS balanced
FROM (SELECT COUNT(*) AS bronze_rows,
             CAST(SUM(CASE WHEN _error_reason = '' THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
             CAST(SUM(CASE WHEN _error_reason <> '' THEN 1 ELSE 0 END) AS BIGINT) AS quarantine_rows,
             COUNT(DISTINCT CASE WHEN _error_reason = '' THEN order_id END) AS silver_rows
      FROM coded) c"""))
def q_superseded_count(spark, sf):
    return Q.conservation(_checked(spark, sf))


@register("duplicate_keys", O.with_ctes(*_CODED_SQL, body="""
SELECT order_id, COUNT(*) AS row_count FROM coded WHERE _error_reason = '' GROUP BY order_id HAVING COUNT(*) >= 2"""))
def q_duplicate_keys(spark, sf):
    return duplicate_keys(valid_rows(_checked(spark, sf)), "order_id")


@register("surplus_duplicates", O.with_ctes(O.RAW_ORDERS, body="""
SELECT CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS duplicate_order_id_rows
FROM (SELECT trim(order_id, ' ') AS id, COUNT(*) AS n FROM raw_orders
      WHERE order_id IS NOT NULL AND trim(order_id, ' ') <> '' GROUP BY 1 HAVING COUNT(*) > 1) d"""))
def q_surplus_duplicates(spark, sf):
    return surplus_duplicates(_raw(spark, sf), "order_id")


# ---------------------------------------------------------------------------
# Merges (M1-M10, AG10)
# ---------------------------------------------------------------------------

MERGE_COLS = ORDER_COLS + LINEAGE


def _merge_inputs(spark, sf, rules=LAKEHOUSE):
    o = _orders_of(_checked(spark, sf, rules))
    tgt = _silver(o.filter(F.col("_version") == 0)).select(*MERGE_COLS)
    src = o.filter(F.col("_version") == 1).select(*MERGE_COLS)
    return tgt, src


def _merged_out(m: DataFrame) -> DataFrame:
    return m.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    "_source_file", M.CHANGE)


def _merge_sql(where_update: str, rules_cte=O.CODED, valid="_error_reason = ''", oid="order_id",
               cust="customer_id", st="status", amt="amt") -> str:
    pick = lambda side: f"""
  SELECT {oid} AS order_id, {cust} AS customer_id, {st} AS status, {amt} AS amount_cents, ts AS updated_at,
         _source_file, _loaded_at
  FROM {rules_cte.split(' AS')[0].strip()} WHERE {valid} AND _version = {side}
  QUALIFY row_number() OVER (PARTITION BY {oid} ORDER BY ts DESC, _loaded_at DESC, _source_file DESC) = 1"""
    return O.with_ctes(O.RAW_ORDERS, rules_cte, f"tgt AS ({pick(0)})", f"src AS ({pick(1)})", f"""
j AS (
  SELECT t.order_id AS t_id, s.order_id AS s_id, t.customer_id AS t_c, s.customer_id AS s_c, t.status AS t_st,
         s.status AS s_st, t.amount_cents AS t_a, s.amount_cents AS s_a, t.updated_at AS t_u, s.updated_at AS s_u,
         t._source_file AS t_f, s._source_file AS s_f,
         CASE WHEN t.order_id IS NULL THEN 'insert' WHEN s.order_id IS NULL THEN 'keep'
              WHEN {where_update} THEN 'update' ELSE 'stale' END AS _change
  FROM tgt t FULL OUTER JOIN src s ON t.order_id IS NOT DISTINCT FROM s.order_id
)""", body=f"""
SELECT CASE WHEN _change IN ('insert', 'update') THEN s_id ELSE t_id END AS order_id,
       CASE WHEN _change IN ('insert', 'update') THEN s_c ELSE t_c END AS customer_id,
       CASE WHEN _change IN ('insert', 'update') THEN s_st ELSE t_st END AS status,
       CASE WHEN _change IN ('insert', 'update') THEN s_a ELSE t_a END AS amount_cents,
       {O.ts_text("CASE WHEN _change IN ('insert', 'update') THEN s_u ELSE t_u END")} AS updated_at,
       CASE WHEN _change IN ('insert', 'update') THEN s_f ELSE t_f END AS _source_file,
       _change
FROM j""")


@register("merge_newer", _merge_sql("s.updated_at > t.updated_at"))
def q_merge_newer(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _merged_out(M.upsert(tgt, src, ["order_id"], ["updated_at"], ">", source_order=list(LATEST_ORDER)))


@register("merge_newer_or_equal", _merge_sql("s.updated_at >= t.updated_at", rules_cte=O.STAGED,
                                             valid="error_message = ''", oid="trim(order_id, ' ')",
                                             cust="trim(customer_id, ' ')", st="upper(trim(status, ' '))", amt="amt32"))
def q_merge_newer_or_equal(spark, sf):
    tgt, src = _merge_inputs(spark, sf, STAGING)
    return _merged_out(M.upsert(tgt, src, ["order_id"], ["updated_at"], ">=", source_order=list(LATEST_ORDER)))


@register("merge_replace", _merge_sql("TRUE"))
def q_merge_replace(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return _merged_out(M.replace_by_key(tgt, src, ["order_id"], source_order=list(LATEST_ORDER)))


@register("merge_change_counts", """
SELECT CAST(SUM(CASE WHEN _change = 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(SUM(CASE WHEN _change = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN _change = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       CAST(SUM(CASE WHEN _change = 'stale' THEN 1 ELSE 0 END) AS BIGINT) AS stale,
       CAST(SUM(CASE WHEN _change IN ('insert', 'update') THEN 1 ELSE 0 END) AS BIGINT) AS changed
FROM (""" + _merge_sql("s.updated_at > t.updated_at") + ") merged")
def q_merge_change_counts(spark, sf):
    tgt, src = _merge_inputs(spark, sf)
    return M.change_counts(M.upsert(tgt, src, ["order_id"], ["updated_at"], ">", source_order=list(LATEST_ORDER)))


_MERGE_NEWER_SQL = _merge_sql("s.updated_at > t.updated_at")


@register("merge_change_rows", "SELECT * FROM (" + _MERGE_NEWER_SQL + ") m WHERE _change IN ('insert', 'update')")
def q_merge_change_rows(spark, sf):
    """Upsert as change rows: only inserts and winning updates are produced."""
    tgt, src = _merge_inputs(spark, sf)
    return _merged_out(M.upsert_changes(tgt, src, ["order_id"], ["updated_at"], ">", source_order=list(LATEST_ORDER)))


@register("merge_on_read", "SELECT order_id, customer_id, status, amount_cents, updated_at, _source_file FROM ("
          + _MERGE_NEWER_SQL + ") m")
def q_merge_on_read(spark, sf):
    """State = target with the change rows applied (equals the full-rewrite upsert)."""
    tgt, src = _merge_inputs(spark, sf)
    changes = M.upsert_changes(tgt, src, ["order_id"], ["updated_at"], ">", source_order=list(LATEST_ORDER))
    state = M.apply_changes(tgt, changes, ["order_id"])
    return state.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                        "_source_file")


_TB_CTE = (O.RAW_ORDERS, O.EVENT_ENVELOPE, O.PARSED_EVENTS, """
tgt AS (SELECT * FROM valid_events WHERE _batch = 0
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, enqueued_at DESC,
                                   eventhub_partition DESC, kafka_offset DESC) = 1)""", """
src AS (SELECT * FROM valid_events WHERE _batch = 1
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, enqueued_at DESC,
                                   eventhub_partition DESC, kafka_offset DESC) = 1)""", """
j AS (
  SELECT t.*, s.order_id AS s_order_id, s.customer_id AS s_customer_id, s.status AS s_status,
         s.amount_cents AS s_amount_cents, s.updated_at AS s_updated_at, s.eventhub_partition AS s_eventhub_partition,
         s.kafka_offset AS s_kafka_offset, s.enqueued_at AS s_enqueued_at,
         CASE WHEN t.order_id IS NULL THEN 'insert' WHEN s.order_id IS NULL THEN 'keep'
              WHEN s.updated_at > t.updated_at OR (s.updated_at = t.updated_at AND s.enqueued_at > t.enqueued_at)
              THEN 'update' ELSE 'stale' END AS _change
  FROM tgt t FULL OUTER JOIN src s ON t.order_id IS NOT DISTINCT FROM s.order_id
)""")


def _pick(c: str) -> str:
    return f"CASE WHEN _change IN ('insert', 'update') THEN s_{c} ELSE {c} END"


@register("merge_tiebreak", O.with_ctes(*_TB_CTE, body=f"""
SELECT {_pick('order_id')} AS order_id, {_pick('customer_id')} AS customer_id, {_pick('status')} AS status,
       {_pick('amount_cents')} AS amount_cents, {O.ts_text(_pick('updated_at'))} AS updated_at,
       {_pick('eventhub_partition')} AS eventhub_partition, {_pick('kafka_offset')} AS kafka_offset,
       {O.ts_text(_pick('enqueued_at'))} AS enqueued_at, _change
FROM j"""))
def q_merge_tiebreak(spark, sf):
    ev = _valid_events(spark, sf).select(*EVENT_COLS, "_batch")
    tgt = _event_silver(ev.filter(F.col("_batch") == 0)).select(*EVENT_COLS)
    src = ev.filter(F.col("_batch") == 1).select(*EVENT_COLS)
    m = M.upsert(tgt, src, ["order_id"], ["updated_at", "enqueued_at"], ">", source_order=list(EVENT_ORDER))
    return m.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    "eventhub_partition", "kafka_offset", ts_text("enqueued_at").alias("enqueued_at"), M.CHANGE)


BRONZE_KEYS = ["_source_file", "order_id", "updated_at"]


@register("merge_insert_only", O.with_ctes(O.RAW_ORDERS, """
tgt AS (SELECT _k, _version, _source_file, order_id, updated_at FROM raw_orders WHERE _version = 0)""", body="""
SELECT _k, _version, _source_file, order_id, updated_at, 'keep' AS _change FROM tgt
UNION ALL
SELECT s._k, s._version, s._source_file, s.order_id, s.updated_at, 'insert' AS _change FROM raw_orders s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t._source_file = s._source_file AND t.order_id = s.order_id
                  AND t.updated_at = s.updated_at)"""))
def q_merge_insert_only(spark, sf):
    raw = _raw(spark, sf).select("_k", "_version", *BRONZE_KEYS)
    tgt = raw.filter(F.col("_version") == 0)
    return M.insert_only(tgt, raw, BRONZE_KEYS, null_safe=False)


@register("merge_topic_coordinates", O.with_ctes(O.RAW_ORDERS, O.EVENT_ENVELOPE, """
tgt AS (SELECT raw_json, eventhub_partition, kafka_offset, enqueued_at FROM event_envelope WHERE _batch = 0)""", body=f"""
SELECT raw_json, eventhub_partition, kafka_offset, {O.ts_text('enqueued_at')} AS enqueued_at, 'keep' AS _change FROM tgt
UNION ALL
SELECT raw_json, eventhub_partition, kafka_offset, {O.ts_text('enqueued_at')} AS enqueued_at, 'insert' AS _change
FROM event_envelope s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.eventhub_partition = s.eventhub_partition
                  AND t.kafka_offset = s.kafka_offset)"""))
def q_merge_topic_coordinates(spark, sf):
    env = _envelope(spark, sf).select("raw_json", "eventhub_partition", "kafka_offset", "enqueued_at", "_batch")
    cols = ["raw_json", "eventhub_partition", "kafka_offset", "enqueued_at"]
    m = M.insert_only(env.filter(F.col("_batch") == 0).select(*cols), env.select(*cols),
                      ["eventhub_partition", "kafka_offset"], null_safe=False)
    return m.withColumn("enqueued_at", ts_text("enqueued_at"))


QUARANTINE_COLS = ("order_id", "customer_id", "status", "amount_cents", "updated_at", "_source_file", "_error_reason")


@register("merge_null_safe", O.with_ctes(*_CODED_SQL, """
rej AS (SELECT order_id, customer_id, status, amount_cents, updated_at, _source_file, _error_reason, _version
        FROM coded WHERE _error_reason <> '')""", """
tgt AS (SELECT * FROM rej WHERE _version = 0)""", body="""
SELECT order_id, customer_id, status, amount_cents, updated_at, _source_file, _error_reason, 'keep' AS _change FROM tgt
UNION ALL
SELECT order_id, customer_id, status, amount_cents, updated_at, _source_file, _error_reason, 'insert' AS _change
FROM rej s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t._source_file = s._source_file
                  AND t.order_id IS NOT DISTINCT FROM s.order_id AND t.updated_at IS NOT DISTINCT FROM s.updated_at
                  AND t._error_reason IS NOT DISTINCT FROM s._error_reason)"""))
def q_merge_null_safe(spark, sf):
    from ordermill.operators.rules import to_quarantine
    rej = to_quarantine(rejected_rows(_checked(spark, sf)), lineage=("_source_file", "_version"), stamp=False)
    tgt = rej.filter(F.col("_version") == 0).select(*QUARANTINE_COLS)
    return M.insert_only(tgt, rej.select(*QUARANTINE_COLS), ["_source_file", "order_id", "updated_at", "_error_reason"],
                         null_safe=["order_id", "updated_at", "_error_reason"])


_P_REJECTS = f"""
prej AS (SELECT order_id, error_message, {O.RAW_ROW_JSON} AS raw_row, _version FROM first_error
         WHERE error_message <> '')"""


@register("merge_unique_content", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, _P_REJECTS, """
tgt AS (SELECT DISTINCT order_id, error_message, raw_row FROM prej WHERE _version = 0)""", """
src AS (SELECT DISTINCT order_id, error_message, raw_row FROM prej)""", body="""
SELECT order_id, error_message, raw_row, 'keep' AS _change FROM tgt
UNION ALL
SELECT order_id, error_message, raw_row, 'insert' AS _change FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.error_message = s.error_message AND t.raw_row = s.raw_row)"""))
def q_merge_unique_content(spark, sf):
    rej = rejected_rows(_checked(spark, sf, LOCAL)).select(
        "order_id", F.col(ERRORS).alias("error_message"), raw_row_json().alias("raw_row"), "_version")
    cols = ["order_id", "error_message", "raw_row"]
    # the order id is part of raw_row: distinct rows are distinct identities
    tgt = rej.filter(F.col("_version") == 0).select(*cols).distinct()
    return M.insert_only(tgt, rej.select(*cols).distinct(), ["error_message", "raw_row"], by_digest=True)


_T_REJECTS = f"""
trej AS (SELECT DISTINCT order_id, error_message, {O.RAW_ROW_JSON} AS raw_row, _source_file, _version FROM staged
         WHERE error_message <> '')"""


@register("merge_coalesced_key", O.with_ctes(O.RAW_ORDERS, O.STAGED, _T_REJECTS, """
tgt AS (SELECT DISTINCT order_id, error_message, raw_row, _source_file FROM trej WHERE _version = 0)""", """
src AS (SELECT DISTINCT order_id, error_message, raw_row, _source_file FROM trej)""", body="""
SELECT order_id, error_message, raw_row, _source_file, 'keep' AS _change FROM tgt
UNION ALL
SELECT order_id, error_message, raw_row, _source_file, 'insert' AS _change FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE coalesce(t.order_id, '') = coalesce(s.order_id, '')
                  AND t.error_message = s.error_message AND t.raw_row = s.raw_row
                  AND coalesce(t._source_file, '') = coalesce(s._source_file, ''))"""))
def q_merge_coalesced_key(spark, sf):
    rej = rejected_rows(_checked(spark, sf, STAGING)).select(
        "order_id", F.col(ERRORS).alias("error_message"), raw_row_json().alias("raw_row"), "_source_file", "_version")
    cols = ["order_id", "error_message", "raw_row", "_source_file"]
    tgt = rej.filter(F.col("_version") == 0).select(*cols).distinct()
    src = rej.select(*cols).distinct()
    return M.insert_only(tgt, src, cols, coalesce_blank=True, by_digest=True)


@register("distinct_rejects", O.with_ctes(O.RAW_ORDERS, O.STAGED, _T_REJECTS, body="""
SELECT DISTINCT order_id, error_message, raw_row, _source_file FROM trej"""))
def q_distinct_rejects(spark, sf):
    rej = rejected_rows(_checked(spark, sf, STAGING))
    return rej.select("order_id", F.col(ERRORS).alias("error_message"), raw_row_json().alias("raw_row"),
                      "_source_file").distinct()


# ---------------------------------------------------------------------------
# Increments and replay (F8-F10, I2, I4, I5, ST7)
# ---------------------------------------------------------------------------

@register("watermark_increment", O.with_ctes(*_CODED_SQL, body=f"""
SELECT _k, _version, order_id, {O.ts_text('ts')} AS updated_at FROM coded
WHERE _error_reason = '' AND ts > TIMESTAMP '{WATERMARK.replace('T', ' ')}'"""))
def q_watermark_increment(spark, sf):
    o = _orders_of(_checked(spark, sf), keep=("_k", "_version"))
    return after_watermark(o, "updated_at", WATERMARK).select("_k", "_version", "order_id",
                                                             ts_text("updated_at").alias("updated_at"))


_WM_SQL = """
wm0 AS (SELECT max(ts) AS wm FROM coded WHERE _error_reason = '' AND _version = 0)"""


@register("watermark_next", O.with_ctes(*_CODED_SQL, _WM_SQL, body="""
SELECT strftime(coalesce((SELECT max(ts) FROM coded WHERE _error_reason = '' AND _version = 1
                            AND ts > (SELECT wm FROM wm0)), (SELECT wm FROM wm0)), '%Y-%m-%dT%H:%M:%S') AS watermark"""))
def q_watermark_next(spark, sf):
    o = _orders_of(_checked(spark, sf))
    wm0 = o.filter(F.col("_version") == 0).agg(F.max("updated_at")).scalar()
    inc = o.filter((F.col("_version") == 1) & (F.col("updated_at") > wm0))
    return inc.agg(F.date_format(F.coalesce(F.max("updated_at"), wm0), "yyyy-MM-dd'T'HH:mm:ss").alias("watermark"))


@register("late_count", O.with_ctes(*_CODED_SQL, _WM_SQL, body="""
SELECT COUNT(*) AS late_count FROM coded WHERE _error_reason = '' AND _version = 1 AND ts <= (SELECT wm FROM wm0)"""))
def q_late_count(spark, sf):
    o = _orders_of(_checked(spark, sf))
    wm0 = o.filter(F.col("_version") == 0).agg(F.max("updated_at")).scalar()
    return o.filter((F.col("_version") == 1) & (F.col("updated_at") <= wm0)).agg(F.count(F.lit(1)).alias("late_count"))


@register("increment_vs_target", O.with_ctes(*_CODED_SQL, _SILVER_SQL.replace("FROM coded WHERE _error_reason = ''",
                                                                            "FROM coded WHERE _error_reason = '' AND _version = 0"),
                                             body=f"""
SELECT _k, order_id, amount_cents, round(CAST(amount_cents AS DOUBLE) / 100.0, 2) AS amount,
       {O.ts_text('updated_at')} AS updated_at, {O.ts_text('_loaded_at')} AS _loaded_at
FROM (SELECT _k, order_id, amt AS amount_cents, ts AS updated_at, _loaded_at FROM coded
      WHERE _error_reason = '' AND _version = 1) s
WHERE updated_at > (SELECT max(updated_at) FROM silver)"""))
def q_increment_vs_target(spark, sf):
    """Incremental model: batch rows updated after the newest update already in the target."""
    o = _orders_of(_checked(spark, sf), keep=LINEAGE + ("_version", "_k"))
    target = _silver(o.filter(F.col("_version") == 0))
    inc = increment_vs_target(o.filter(F.col("_version") == 1), target, "updated_at")
    return inc.select("_k", "order_id", "amount_cents", cents_to_amount("amount_cents", 2).alias("amount"),
                      ts_text("updated_at").alias("updated_at"), ts_text("_loaded_at").alias("_loaded_at"))


@register("replay_window", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, body=f"""
SELECT _k, _version, order_id, error_message FROM first_error
WHERE ts IS NULL OR (ts >= TIMESTAMP '{REPLAY_START.replace('T', ' ')}' AND ts < TIMESTAMP '{REPLAY_END.replace('T', ' ')}')"""))
def q_replay_window(spark, sf):
    rows = replay_window(_raw(spark, sf), REPLAY_START, REPLAY_END)
    return apply_rules(rows, LOCAL).select("_k", "_version", "order_id", F.col(ERRORS).alias("error_message"))


@register("slice_by_file", O.with_ctes(O.RAW_ORDERS, body=f"""
SELECT _k, _version, order_id, customer_id, status, amount_cents, updated_at, _source_file FROM raw_orders
WHERE _source_file = '{SLICE_FILE}'"""))
def q_slice_by_file(spark, sf):
    return slice_by_file(_raw(spark, sf), SLICE_FILE).select(
        "_k", "_version", "order_id", "customer_id", "status", "amount_cents", "updated_at", "_source_file")


# ---------------------------------------------------------------------------
# Quality reports, reconciliation, gates, column tests (D1-D7, AG7-AG9, J-S)
# ---------------------------------------------------------------------------

def _dq_counter(cond: str) -> str:
    return f"CAST(coalesce(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


@register("dq_report", O.with_ctes(O.RAW_ORDERS, O.STAGED, f"""
counters AS (
  SELECT _source_file, COUNT(*) AS total_rows,
         {_dq_counter("error_message <> ''")} AS rejected_rows,
         {_dq_counter(O.blank('order_id'))} AS missing_order_id_rows,
         {_dq_counter(O.blank('customer_id'))} AS missing_customer_id_rows,
         {_dq_counter(O.blank('status') + " OR upper(trim(status, ' ')) NOT IN " + O.STATUS_LIST)} AS invalid_status_rows,
         {_dq_counter("amt32 IS NULL OR amt32 < 0")} AS invalid_amount_rows,
         {_dq_counter("ts IS NULL")} AS invalid_updated_at_rows
  FROM staged GROUP BY _source_file)""", """
dups AS (
  SELECT _source_file, CAST(SUM(n - 1) AS BIGINT) AS duplicate_order_id_rows
  FROM (SELECT _source_file, trim(order_id, ' ') AS id, COUNT(*) AS n FROM raw_orders
        WHERE order_id IS NOT NULL AND trim(order_id, ' ') <> '' GROUP BY 1, 2 HAVING COUNT(*) > 1) d
  GROUP BY 1)""", body="""
SELECT c._source_file, total_rows, total_rows - rejected_rows AS valid_rows, rejected_rows, missing_order_id_rows,
       missing_customer_id_rows, invalid_status_rows, invalid_amount_rows, invalid_updated_at_rows,
       CAST(coalesce(d.duplicate_order_id_rows, 0) AS BIGINT) AS duplicate_order_id_rows,
       CASE WHEN rejected_rows = 0 AND coalesce(d.duplicate_order_id_rows, 0) = 0 THEN 'PASS' ELSE 'WARN' END AS dq_status
FROM counters c LEFT JOIN dups d ON c._source_file = d._source_file"""))
def q_dq_report(spark, sf):
    return Q.dq_report(_raw(spark, sf), STAGING, by=["_source_file"])


@register("reconcile_gold", O.with_ctes(*_CODED_SQL, _SILVER_SQL, _DAILY_SQL, """
s AS (SELECT COUNT(*) AS orders, coalesce(SUM(amount_cents), 0) AS amount FROM silver)""", """
g AS (SELECT coalesce(SUM(total_orders), 0) AS orders, coalesce(SUM(total_amount_cents), 0) AS amount,
             SUM(CASE WHEN total_orders <> paid_orders + shipped_orders + pending_orders + cancelled_orders
                      THEN 1 ELSE 0 END) AS bad_split,
             COUNT(*) - COUNT(DISTINCT report_date) AS dup_dates FROM daily)""", body="""
SELECT 'gold order count equals silver' AS "check", coalesce(g.orders = s.orders, false) AS passed FROM s, g
UNION ALL SELECT 'gold amount equals silver', coalesce(g.amount = s.amount, false) FROM s, g
UNION ALL SELECT 'status split adds up per day', coalesce(coalesce(g.bad_split, 0) = 0, false) FROM s, g
UNION ALL SELECT 'report dates are unique', coalesce(g.dup_dates = 0, false) FROM s, g"""))
def q_reconcile_gold(spark, sf):
    silver = _silver(_orders_of(_checked(spark, sf)))
    return Q.reconcile_daily(silver)


@register("quality_gate", O.with_ctes(*_EVENT_SQL, _EVENT_SILVER_SQL, f"""
s AS (SELECT COUNT(*) AS silver_rows, COUNT(DISTINCT order_id) AS distinct_order_ids,
             coalesce(SUM(amount_cents), 0) AS silver_total_amount,
             coalesce(SUM(CASE WHEN trim(coalesce(order_id, ''), ' ') = '' OR trim(coalesce(customer_id, ''), ' ') = ''
                                 OR status IS NULL OR status NOT IN {O.STATUS_LIST} OR amount_cents IS NULL
                                 OR amount_cents <= 0 OR updated_at IS NULL THEN 1 ELSE 0 END), 0) AS invalid_rows
      FROM event_silver)""", f"""
gold AS (SELECT COUNT(*) AS total_orders, coalesce(SUM(amount_cents), 0) AS total_amount_cents,
                {_count_if("status = 'PENDING'")} AS pending_orders, {_count_if("status = 'PAID'")} AS paid_orders,
                {_count_if("status = 'SHIPPED'")} AS shipped_orders,
                {_count_if("status = 'CANCELLED'")} AS cancelled_orders FROM event_silver)""", """
g AS (SELECT total_orders AS orders, total_amount_cents AS amount,
             pending_orders + paid_orders + shipped_orders + cancelled_orders AS status_total FROM gold)""", body="""
SELECT 'silver order ids are unique' AS "check", coalesce(s.silver_rows = s.distinct_order_ids, false) AS passed FROM s, g
UNION ALL SELECT 'silver has no invalid rows', coalesce(s.invalid_rows = 0, false) FROM s, g
UNION ALL SELECT 'gold total_orders matches silver', coalesce(g.orders = s.silver_rows, false) FROM s, g
UNION ALL SELECT 'gold total_amount matches silver', coalesce(g.amount = s.silver_total_amount, false) FROM s, g
UNION ALL SELECT 'status counts add up to total_orders', coalesce(g.status_total = g.orders, false) FROM s, g"""))
def q_quality_gate(spark, sf):
    return Q.event_gate(_event_silver(_valid_events(spark, sf)))


@register("test_not_null", O.with_ctes(O.RAW_ORDERS, body="""
SELECT _k, _version, _source_file FROM raw_orders WHERE order_id IS NULL"""))
def q_test_not_null(spark, sf):
    return Q.test_not_null(_raw(spark, sf), "order_id").select("_k", "_version", "_source_file")


@register("test_unique", O.with_ctes(O.RAW_ORDERS, body="""
SELECT order_id, COUNT(*) AS n_records FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1"""))
def q_test_unique(spark, sf):
    return Q.test_unique(_raw(spark, sf), "order_id")


@register("test_accepted_values", O.with_ctes(O.RAW_ORDERS, body=f"""
SELECT _k, _version, status FROM raw_orders WHERE status IS NOT NULL AND status NOT IN {O.STATUS_LIST}"""))
def q_test_accepted_values(spark, sf):
    return Q.test_accepted_values(_raw(spark, sf), "status", ALLOWED_STATUSES).select("_k", "_version", "status")


@register("test_relationships", O.with_ctes(O.RAW_ORDERS, body="""
SELECT _k, _version, customer_id FROM raw_orders r
WHERE customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE 'CUST-' || CAST(c.c_custkey AS VARCHAR) = r.customer_id)"""))
def q_test_relationships(spark, sf):
    (customer,) = load_tables(spark, sf, "customer")
    parent = customer.select(F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("customer_key"))
    return Q.test_relationships(_raw(spark, sf), "customer_id", parent, "customer_key").select(
        "_k", "_version", "customer_id")


@register("test_non_negative", O.with_ctes(*_CODED_SQL, body="""
SELECT _k, _version, amt AS amount_cents FROM coded WHERE amt < 0"""))
def q_test_non_negative(spark, sf):
    c = _checked(spark, sf)
    return Q.test_expression_false(c, F.col("_amount_cents") >= 0).select(
        "_k", "_version", F.col("_amount_cents").alias("amount_cents"))


# ---------------------------------------------------------------------------
# Run history (A2, A3, SC15) over the benchmark event log
# ---------------------------------------------------------------------------

@register("latest_run_state", """
WITH ev AS (
  SELECT user_id AS run_id,
         CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'click' THEN 'RUNNING' WHEN 'view' THEN 'RUNNING'
                         WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' END AS run_status,
         ts AS event_at, event_id AS event_seq
  FROM events),
latest AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_at DESC, event_seq DESC) = 1),
spans AS (SELECT run_id, min(event_at) AS started_at, COUNT(*) AS event_count FROM ev GROUP BY run_id),
st AS (
  SELECT l.run_id, CASE WHEN l.run_status = 'RUNNING' AND s.started_at < (SELECT max(started_at) FROM spans)
                        THEN 'FAILED' ELSE l.run_status END AS run_status,
         s.started_at, l.event_at, s.event_count
  FROM latest l JOIN spans s ON l.run_id = s.run_id)
SELECT run_id, run_status, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
       strftime(CASE WHEN run_status <> 'RUNNING' THEN event_at END, '%Y-%m-%d %H:%M:%S.%f') AS finished_at,
       event_count
FROM st""")
def q_latest_run_state(spark, sf):
    (events,) = load_tables(spark, sf, "events")
    st = run_state(run_events(events))
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return st.select("run_id", "run_status", F.date_format("started_at", fmt).alias("started_at"),
                     F.date_format("finished_at", fmt).alias("finished_at"), "event_count")


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A stored table in a fresh folder under the checkpoint folder."""
    path = scratch_path(spark, name, uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _store(spark: SparkSession, name: str):
    from ordermill.plans.store import Store
    return Store(spark, scratch_path(spark, name, uuid.uuid4().hex))


# ---------------------------------------------------------------------------
# Streaming (ST1-ST6, SC8): a file stream of the envelope drained into stores
# ---------------------------------------------------------------------------

def _stream_workdir(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Drop the bronze envelope into an inbox as three deliveries: batch 0, batch 1 and batch 0
    again (an at-least-once re-delivery the sink must absorb)."""
    root = scratch_path(spark, "stream", uuid.uuid4().hex)
    env = _envelope(spark, sf)
    cols = ["raw_json", "eventhub_partition", "kafka_offset", "enqueued_at"]
    inbox = f"{root}/inbox"
    for i, b in enumerate((0, 1, 0)):
        env.filter(F.col("_batch") == b).select(*cols).write.parquet(f"{inbox}/delivery={i}")
    return root, inbox


def _drain(spark, sf, sink_cls, table):
    from ordermill.plans.store import Store
    from ordermill.streaming.jobs import run_available_now
    from ordermill.streaming.sources import read_envelope_files
    root, inbox = _stream_workdir(spark, sf)
    store = Store(spark, f"{root}/lake")
    stream = read_envelope_files(spark, inbox, max_files_per_trigger=16)
    run_available_now(stream, sink_cls(store), f"{root}/checkpoint")
    return store.read(table)


@register("stream_bronze", O.with_ctes(O.RAW_ORDERS, O.EVENT_ENVELOPE, body=f"""
SELECT raw_json, eventhub_partition, kafka_offset, {O.ts_text('enqueued_at')} AS enqueued_at FROM event_envelope"""))
def q_stream_bronze(spark, sf):
    from ordermill.streaming.sinks import BronzeSink
    b = _drain(spark, sf, BronzeSink, "bronze_events")
    return b.select("raw_json", "eventhub_partition", "kafka_offset", ts_text("enqueued_at").alias("enqueued_at"))


@register("stream_silver", ORACLE["latest_per_key_tiebreak"])
def q_stream_silver(spark, sf):
    from ordermill.streaming.sinks import EventSilverSink
    s = _drain(spark, sf, EventSilverSink, "silver_events")
    return s.select("order_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                    ts_text("enqueued_at").alias("enqueued_at"), "eventhub_partition", "kafka_offset")



# ---------------------------------------------------------------------------
# Whole pipelines over the feed: CSV export/import (K3, SC1, SC2) and an incremental run (I3)
# ---------------------------------------------------------------------------

@register("csv_roundtrip", O.with_ctes(O.RAW_ORDERS, body="""
SELECT NULLIF(order_id, '') AS order_id, NULLIF(customer_id, '') AS customer_id, NULLIF(status, '') AS status,
       NULLIF(amount_cents, '') AS amount_cents, NULLIF(updated_at, '') AS updated_at FROM raw_orders"""))
def q_csv_roundtrip(spark, sf):
    """Export the feed as header CSV files, read them back with the strict header check."""
    from ordermill.plans.store import export_csv
    from ordermill.schema import ORDER_COLUMNS
    from ordermill.sources.files import read_orders
    path = scratch_path(spark, "csv", uuid.uuid4().hex)
    export_csv(_raw(spark, sf), path, columns=ORDER_COLUMNS, ts_columns=())
    return read_orders(spark, path, strict_header=True, pattern="part-*.csv").select(*ORDER_COLUMNS)


_P_VALID = """
pv AS (SELECT order_id, customer_id, status, amt AS amount_cents, ts AS updated_at, _version FROM first_error
       WHERE error_message = '')"""


@register("incremental_run", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, _P_VALID, """
wm AS (SELECT max(updated_at) AS wm FROM pv WHERE _version = 0)""", """
t AS (SELECT * FROM pv WHERE _version = 0)""", """
s AS (SELECT * FROM pv WHERE _version = 1 AND updated_at > (SELECT wm FROM wm))""", body=f"""
SELECT CASE WHEN w THEN s_id ELSE t_id END AS order_id, CASE WHEN w THEN s_c ELSE t_c END AS customer_id,
       CASE WHEN w THEN s_st ELSE t_st END AS status, CASE WHEN w THEN s_a ELSE t_a END AS amount_cents,
       {O.ts_text("CASE WHEN w THEN s_u ELSE t_u END")} AS updated_at
FROM (SELECT t.order_id AS t_id, s.order_id AS s_id, t.customer_id AS t_c, s.customer_id AS s_c,
             t.status AS t_st, s.status AS s_st, t.amount_cents AS t_a, s.amount_cents AS s_a,
             t.updated_at AS t_u, s.updated_at AS s_u,
             s.order_id IS NOT NULL AND (t.order_id IS NULL OR s.updated_at > t.updated_at) AS w
      FROM t FULL OUTER JOIN s ON t.order_id = s.order_id) j"""))
def q_incremental_run(spark, sf):
    """Two incremental runs (batch 0, then batch 1) of the first-error pipeline into a fresh store:
    watermark skip, upsert as change rows, insert-ignore quarantine, atomic publish, run log."""
    from ordermill.plans.runs import ORDERS_TABLE, run_incremental
    from ordermill.plans.store import Store
    from ordermill.schema import ORDER_COLUMNS
    raw = _raw(spark, sf)
    store = Store(spark, scratch_path(spark, "runs", uuid.uuid4().hex))
    for v in (0, 1):
        run_incremental(spark, store, raw.filter(F.col("_version") == v).select(*ORDER_COLUMNS),
                        run_id=f"{v:06d}-incremental")
    out = store.read(ORDERS_TABLE)
    return out.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"))


@register("replay_run", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, f"""
pv AS (SELECT order_id, customer_id, status, amt AS amount_cents, ts AS updated_at, _version FROM first_error
       WHERE error_message = '' AND ts >= TIMESTAMP '{REPLAY_START.replace('T', ' ')}'
         AND ts < TIMESTAMP '{REPLAY_END.replace('T', ' ')}')""", """
t AS (SELECT * FROM pv WHERE _version = 0)""", """
s AS (SELECT * FROM pv WHERE _version = 1)""", body=f"""
SELECT CASE WHEN w THEN s_id ELSE t_id END AS order_id, CASE WHEN w THEN s_c ELSE t_c END AS customer_id,
       CASE WHEN w THEN s_st ELSE t_st END AS status, CASE WHEN w THEN s_a ELSE t_a END AS amount_cents,
       {O.ts_text("CASE WHEN w THEN s_u ELSE t_u END")} AS updated_at
FROM (SELECT t.order_id AS t_id, s.order_id AS s_id, t.customer_id AS t_c, s.customer_id AS s_c,
             t.status AS t_st, s.status AS s_st, t.amount_cents AS t_a, s.amount_cents AS s_a,
             t.updated_at AS t_u, s.updated_at AS s_u,
             s.order_id IS NOT NULL AND (t.order_id IS NULL OR s.updated_at > t.updated_at) AS w
      FROM t FULL OUTER JOIN s ON t.order_id = s.order_id) j"""))
def q_replay_run(spark, sf):
    """Replay each batch over a half-open window into a fresh store (no watermark involved)."""
    from ordermill.plans.runs import ORDERS_TABLE, run_replay
    from ordermill.plans.store import Store
    from ordermill.schema import ORDER_COLUMNS
    raw = _raw(spark, sf)
    store = Store(spark, scratch_path(spark, "replays", uuid.uuid4().hex))
    for v in (0, 1):
        run_replay(spark, store, raw.filter(F.col("_version") == v).select(*ORDER_COLUMNS), REPLAY_START, REPLAY_END,
                   run_id=f"{v:06d}-replay")
    out = store.read(ORDERS_TABLE)
    return out.select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"))


@register("event_job", ORACLE["quality_gate"])
def q_event_job(spark, sf):
    """Topic -> bronze -> silver -> gold totals -> gate, as one streaming job over three deliveries."""
    from ordermill.plans.store import Store
    from ordermill.streaming.jobs import run_event_job
    from ordermill.streaming.sources import read_envelope_files
    root, inbox = _stream_workdir(spark, sf)
    store = Store(spark, f"{root}/lake")
    stream = read_envelope_files(spark, inbox, max_files_per_trigger=16)
    checks = run_event_job(store, stream, f"{root}/checkpoint", "event-gold-000001", enforce_gate=False)
    return checks


@register("daily_metrics_refresh", f"""
SELECT CAST(CAST(CAST(updated_at AS TIMESTAMP) AS DATE) AS VARCHAR) AS report_date, COUNT(*) AS total_orders,
       CAST(SUM(amount_cents) AS BIGINT) AS total_amount_cents,
       {_count_if("status = 'PAID'")} AS paid_orders, {_count_if("status = 'SHIPPED'")} AS shipped_orders,
       {_count_if("status = 'PENDING'")} AS pending_orders, {_count_if("status = 'CANCELLED'")} AS cancelled_orders,
       CAST(SUM(CASE WHEN status = 'PAID' THEN amount_cents ELSE 0 END) AS BIGINT) AS paid_amount_cents
FROM (""" + _MERGE_NEWER_SQL + """) merged GROUP BY 1""")
def q_daily_metrics_refresh(spark, sf):
    """Gold of the existing state, refreshed for the dates the update batch touches only.

    State and change set are stored tables, as in the pipeline, so each is computed once."""
    from ordermill.operators.metrics import refresh_daily_metrics
    tgt, src = _merge_inputs(spark, sf)
    tgt = _written(spark, tgt, "state")
    changes = _written(spark, M.upsert_changes(tgt, src, ["order_id"], ["updated_at"], ">",
                                               source_order=list(LATEST_ORDER)).drop(M.CHANGE), "changes")
    after = M.apply_changes(tgt, changes, ["order_id"])
    gold = refresh_daily_metrics(daily_metrics(tgt), tgt, changes, after)
    return gold.withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


@register("stream_order_files", ORACLE["csv_roundtrip"])
def q_stream_order_files(spark, sf):
    """New-file discovery: CSV files landing in a folder are picked up by a file stream (glob,
    strict header, lineage) and merged insert-only into bronze; the folder is drained twice."""
    from ordermill.plans.runs import BRONZE, ingest_bronze
    from ordermill.plans.store import Store, export_csv
    from ordermill.schema import ORDER_COLUMNS
    from ordermill.streaming.jobs import run_available_now
    from ordermill.streaming.sources import read_order_files
    root = scratch_path(spark, "files", uuid.uuid4().hex)
    export_csv(_raw(spark, sf), f"{root}/landing", columns=ORDER_COLUMNS, ts_columns=())
    store = Store(spark, f"{root}/lake")

    def sink(batch, batch_id):
        ingest_bronze(store, batch, f"files-{batch_id:012d}")

    for attempt in ("checkpoint", "checkpoint-lost"):     # a lost checkpoint replays every file
        run_available_now(read_order_files(spark, f"{root}/landing", pattern="part-*.csv", max_files_per_trigger=4),
                          sink, f"{root}/{attempt}")
    return store.read(BRONZE).select(*ORDER_COLUMNS)


# ---------------------------------------------------------------------------
# Replays, reruns and writers that share a table: each must equal its batch result (K7, ST2, ST5, ST6, M5)
# ---------------------------------------------------------------------------

@register("stream_bronze_replay", ORACLE["stream_bronze"])
def q_stream_bronze_replay(spark, sf):
    """Every micro-batch delivered twice under one and the same batch id."""
    from ordermill.streaming.sinks import BronzeSink
    env, store = _envelope(spark, sf), _store(spark, "replays")
    sink = BronzeSink(store)
    for b in (0, 0, 1, 1):
        sink(env.filter(F.col("_batch") == b), 0)
    return store.read(sink.table).select("raw_json", "eventhub_partition", "kafka_offset",
                                         ts_text("enqueued_at").alias("enqueued_at"))


@register("stream_silver_restart", ORACLE["stream_silver"])
def q_stream_silver_restart(spark, sf):
    """A lost checkpoint after the table was rebuilt: the restarted sink counts its batches from 0 again."""
    from ordermill.streaming.sinks import EventSilverSink
    env, store = _envelope(spark, sf), _store(spark, "restarts")
    old, new = [env.filter(F.col("_batch") == b) for b in (0, 1)]
    EventSilverSink(store)(old, 7)
    store.publish({"silver_events": store.read("silver_events")}, "silver-rebuild", rebuilds={"silver_events": ["order_id"]})
    sink = EventSilverSink(store)
    for i, batch in enumerate((new, old)):
        sink(batch, i)
    return store.read(sink.table).select("order_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                                         ts_text("enqueued_at").alias("enqueued_at"), "eventhub_partition", "kafka_offset")


def _order_state(store) -> DataFrame:
    from ordermill.plans.runs import ORDERS_TABLE
    return store.read(ORDERS_TABLE).select("order_id", "customer_id", "status", "amount_cents",
                                           ts_text("updated_at").alias("updated_at"))


def _run_batches(spark, sf, ids: tuple[str, ...], versions: tuple[int, ...]):
    from ordermill.plans.runs import run_incremental
    raw, store = _raw(spark, sf), _store(spark, "runs")
    for run_id, v in zip(ids, versions):
        run_incremental(spark, store, raw.filter(F.col("_version") == v).select(*ORDER_COLS), run_id=run_id)
    return store


@register("incremental_rerun", ORACLE["incremental_run"])
def q_incremental_rerun(spark, sf):
    """Each incremental run repeated under its run id: the repetition changes nothing."""
    return _order_state(_run_batches(spark, sf, ("job-1", "job-1", "job-2", "job-2"), (0, 0, 1, 1)))


_NEWER_BODY = f"""
SELECT CASE WHEN w THEN s_id ELSE t_id END AS order_id, CASE WHEN w THEN s_c ELSE t_c END AS customer_id,
       CASE WHEN w THEN s_st ELSE t_st END AS status, CASE WHEN w THEN s_a ELSE t_a END AS amount_cents,
       {O.ts_text("CASE WHEN w THEN s_u ELSE t_u END")} AS updated_at
FROM (SELECT t.order_id AS t_id, s.order_id AS s_id, t.customer_id AS t_c, s.customer_id AS s_c,
             t.status AS t_st, s.status AS s_st, t.amount_cents AS t_a, s.amount_cents AS s_a,
             t.updated_at AS t_u, s.updated_at AS s_u,
             s.order_id IS NOT NULL AND (t.order_id IS NULL OR s.updated_at > t.updated_at) AS w
      FROM t FULL OUTER JOIN s ON t.order_id = s.order_id) j"""


@register("mixed_writers", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, """
pv AS (SELECT order_id, customer_id, status, amt AS amount_cents, ts AS updated_at, _version, _k FROM first_error
       WHERE error_message = '')""", """
t AS (SELECT * FROM pv WHERE _version = 0 AND _k % 101 <> 0)""", """
s AS (SELECT * FROM pv WHERE _version = 1)""", body=_NEWER_BODY))
def q_mixed_writers(spark, sf):
    """The message sink and then an incremental load write one orders table."""
    from ordermill.plans.runs import run_incremental
    from ordermill.streaming.sinks import OrderMessageSink
    from ordermill.streaming.sources import order_messages
    store, env = _store(spark, "mixed"), _envelope(spark, sf)
    OrderMessageSink(store)(order_messages(env.filter(F.col("_batch") == 0)), 0)
    run_incremental(spark, store, _raw(spark, sf).filter(F.col("_version") == 1).select(*ORDER_COLS), run_id="1-load")
    return _order_state(store)


@register("order_messages", O.with_ctes(O.RAW_ORDERS, O.EVENT_ENVELOPE, f"""
m AS (SELECT raw_json, coalesce(json_valid(raw_json), false) AS ok, {O._jx('order_id')} AS order_id,
        {O._jx('customer_id')} AS customer_id, {O._jx('status')} AS status, {O._jx('amount_cents')} AS amount_cents,
        {O._jx('updated_at')} AS updated_at FROM event_envelope)""",
    O.FIRST_ERROR.replace("FROM raw_orders", "FROM m WHERE ok"), body=f"""
SELECT DISTINCT order_id, error_message, {O.RAW_ROW_JSON} AS raw_row FROM first_error WHERE error_message <> ''
UNION ALL SELECT NULL, 'None: malformed row', raw_json FROM m WHERE NOT ok"""))
def q_order_messages(spark, sf):
    """Order messages from the topic envelope: every broken message is one reject with its raw text."""
    from ordermill.plans.runs import REJECTS_TABLE
    from ordermill.streaming.sinks import OrderMessageSink
    from ordermill.streaming.sources import order_messages
    store, env = _store(spark, "messages"), _envelope(spark, sf)
    sink = OrderMessageSink(store)
    for b in (0, 1, 1):
        sink(order_messages(env.filter(F.col("_batch") == b)), b)
    return store.read(REJECTS_TABLE).select("order_id", "error_message", "raw_row")


@register("event_quarantine", O.with_ctes(*_EVENT_SQL, f"""
bad AS (SELECT *, concat_ws('; ', CASE WHEN malformed THEN 'malformed_row' END,
        CASE WHEN {O.blank('order_id')} THEN 'missing_order_id' END,
        CASE WHEN {O.blank('customer_id')} THEN 'missing_customer_id' END,
        CASE WHEN status IS NULL OR status NOT IN {O.STATUS_LIST} THEN 'invalid_status' END,
        CASE WHEN amount_cents IS NULL THEN 'invalid_amount' END,
        CASE WHEN amount_cents <= 0 THEN 'non_positive_amount' END,
        CASE WHEN updated_at IS NULL THEN 'invalid_updated_at' END) AS error_message FROM parsed_events)""", body="""
SELECT e.raw_json, b.eventhub_partition, b.kafka_offset, b.error_message
FROM bad b JOIN event_envelope e USING (eventhub_partition, kafka_offset) WHERE b.error_message <> ''"""))
def q_event_quarantine(spark, sf):
    """Rejected events and broken messages of the event stream, kept with their raw text."""
    from ordermill.streaming.sinks import EventSilverSink
    store, env = _store(spark, "quarantine"), _envelope(spark, sf)
    sink = EventSilverSink(store)
    for b in (0, 1, 0):
        sink(env.filter(F.col("_batch") == b), b)
    return store.read(f"{sink.table}_quarantine").select("raw_json", "eventhub_partition", "kafka_offset", "error_message")


# ---------------------------------------------------------------------------
# Whole runs: staging with its report, full load, one file, increment into the model, run history
# ---------------------------------------------------------------------------

def _staging_runs(spark, sf):
    from ordermill.plans.runs import run_staging
    raw, store = _raw(spark, sf), _store(spark, "staging")
    for v, run_id in ((0, "staging-0"), (1, "staging-1"), (1, "staging-1")):
        run_staging(store, raw.filter(F.col("_version") == v), run_id, "orders_*.csv")
    return store


@register("staging_run", O.with_ctes(O.RAW_ORDERS, O.STAGED, """
pv AS (SELECT trim(order_id, ' ') AS order_id, trim(customer_id, ' ') AS customer_id, upper(trim(status, ' ')) AS status,
              amt32 AS amount_cents, ts AS updated_at, _version FROM staged WHERE error_message = '')""", """
t AS (SELECT * FROM pv WHERE _version = 0)""", """
s AS (SELECT * FROM pv WHERE _version = 1)""", body=_NEWER_BODY.replace("s.updated_at > t.updated_at", "s.updated_at >= t.updated_at")))
def q_staging_run(spark, sf):
    """Staging load, newer-or-equal upsert, rejects, report and run log, per batch; the last run repeated."""
    from ordermill.plans.runs import STAGED_ORDERS
    return _staging_runs(spark, sf).read(STAGED_ORDERS).select(
        "order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"))


@register("dq_report_by_run", ORACLE["dq_report"].replace("GROUP BY _source_file)", "GROUP BY _version)")
          .replace("SELECT _source_file, COUNT(*) AS total_rows", "SELECT _version, COUNT(*) AS total_rows")
          .replace("SELECT _source_file, CAST(SUM(n - 1) AS BIGINT)", "SELECT _version, CAST(SUM(n - 1) AS BIGINT)")
          .replace("SELECT _source_file, trim(order_id, ' ') AS id", "SELECT _version, trim(order_id, ' ') AS id")
          .replace("SELECT c._source_file,", "SELECT 'staging-' || CAST(c._version AS VARCHAR) AS run_id, 'orders_*.csv' AS source_file_pattern,")
          .replace("ON c._source_file = d._source_file", "ON c._version = d._version"))
def q_dq_report_by_run(spark, sf):
    """One report row per run id, also when a run is repeated."""
    from ordermill.plans.runs import REPORTS
    return _staging_runs(spark, sf).read(REPORTS).drop("checked_at")


@register("full_load_run", O.with_ctes(*_CODED_SQL, body=f"""
SELECT order_id, customer_id, status, amt AS amount_cents, {O.ts_text('ts')} AS updated_at, _source_file FROM coded
WHERE _error_reason = ''
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, _loaded_at DESC, status DESC, amt DESC, customer_id DESC) = 1"""))
def q_full_load_run(spark, sf):
    """Bronze overwrite -> silver -> quarantine -> gold -> checks, published together (run twice)."""
    from ordermill.plans.runs import SILVER, full_load
    store = _store(spark, "full")
    raw = _raw(spark, sf).select(*ORDER_COLS, "_source_file", F.col("_loaded_at").alias("_ingested_at"))
    for run_id in ("full-1", "full-2"):
        full_load(store, raw, run_id)
    return store.read(SILVER).select("order_id", "customer_id", "status", "amount_cents",
                                     ts_text("updated_at").alias("updated_at"), "_source_file")


UPDATE_FILE = SLICE_FILE.replace(".csv", "_b.csv")


@register("reprocess_run", O.with_ctes(*_CODED_SQL, f"""
v AS (SELECT order_id, status, amt AS amount_cents, ts AS updated_at, _version FROM coded
      WHERE _error_reason = '' AND _source_file IN ('{SLICE_FILE}', '{UPDATE_FILE}'))""", """
silver AS (SELECT order_id, status, amount_cents, updated_at FROM v
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, _version) = 1)""", _DAILY_SQL, body="""
SELECT CAST(report_date AS VARCHAR) AS report_date, total_orders, total_amount_cents, paid_orders, shipped_orders,
       pending_orders, cancelled_orders, paid_amount_cents FROM daily"""))
def q_reprocess_run(spark, sf):
    """Bronze ingest of the whole feed, then one file and its update file reprocessed into silver and gold."""
    from ordermill.plans.runs import GOLD, ingest_bronze, reprocess_file
    store = _store(spark, "files")
    raw = _raw(spark, sf).select(*ORDER_COLS, "_source_file", F.col("_loaded_at").alias("_ingested_at"))
    ingest_bronze(store, raw, "ingest-1")
    for name in (SLICE_FILE, UPDATE_FILE):
        reprocess_file(store, name, f"file-{name}")
    return store.read(GOLD).drop("_calculated_at").withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


@register("incremental_model", O.with_ctes(*_CODED_SQL, """
t AS (SELECT order_id, customer_id, status, amt AS amount_cents, ts AS updated_at FROM coded WHERE _error_reason = '' AND _version = 0)""", """
s AS (SELECT trim(order_id, ' ') AS k, order_id, customer_id, status, amt AS amount_cents, ts AS updated_at FROM coded
      WHERE _error_reason = '' AND _version = 1 AND ts > (SELECT max(updated_at) FROM t))""", body=_NEWER_BODY))
def q_incremental_model(spark, sf):
    """The increment beyond the model's own newest update, merged into the model by id."""
    o = _orders_of(_checked(spark, sf), keep=("_version",))
    model = o.filter(F.col("_version") == 0).drop("_version")
    inc = increment_vs_target(o.filter(F.col("_version") == 1).drop("_version"), model, "updated_at")
    return M.replace_by_key(model, inc, ["order_id"], source_order=["updated_at"]).drop(M.CHANGE).withColumn(
        "updated_at", ts_text("updated_at"))


@register("run_history", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, """
wm AS (SELECT max(ts) AS wm FROM first_error WHERE error_message = '' AND _version = 0)""", body="""
SELECT 'job-' || CAST(_version + 1 AS VARCHAR) AS run_id, 'SUCCESS' AS run_status, COUNT(*) AS extracted_count,
       CAST(SUM(CASE WHEN error_message = '' THEN 1 ELSE 0 END) AS BIGINT) AS valid_count,
       CAST(SUM(CASE WHEN error_message <> '' THEN 1 ELSE 0 END) AS BIGINT) AS rejected_count
FROM first_error GROUP BY _version"""))
def q_run_history(spark, sf):
    """The run mart after two incremental runs, from the append-only run events they wrote."""
    from ordermill.operators.audit import mart_pipeline_runs
    from ordermill.plans.runs import run_log
    store = _run_batches(spark, sf, ("job-1", "job-2"), (0, 1))
    mart = mart_pipeline_runs(run_state(run_log(store)))
    return mart.select("run_id", "run_status", "extracted_count", "valid_count", "rejected_count")


LOOKUP_IDS = ("ORD-1", "ORD-7", "ORD-64", "ORD-4711")


@register("order_lookup", ORACLE["incremental_run"] + f"""
WHERE (CASE WHEN w THEN s_id ELSE t_id END) IN {LOOKUP_IDS}""")
def q_order_lookup(spark, sf):
    """Rows of the stored orders table by id."""
    from ordermill.plans.runs import ORDERS_TABLE
    store = _run_batches(spark, sf, ("job-1", "job-2"), (0, 1))
    return store.lookup(ORDERS_TABLE, "order_id", LOOKUP_IDS).select(
        "order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"))


@register("status_summary_seed", ORACLE["status_summary"])
def q_status_summary_seed(spark, sf):
    """The status summary with its labels read from a seed file."""
    from ordermill.sources.files import read_seed
    path = scratch_path(spark, "seed", uuid.uuid4().hex)
    status_dimension(spark).coalesce(1).write.option("header", True).csv(path)
    return _q_summary(spark, sf, read_seed(spark, path))


# ---------------------------------------------------------------------------
# Invertible aggregates kept up to date by signed change rows (AG1, AG3, AG4)
# ---------------------------------------------------------------------------

def _signed_gold(spark, state: DataFrame, batch: DataFrame, by: list[str], rows: str | None, compare: list[str], order: list[str],
                 start: Callable[[DataFrame], DataFrame], gain: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Gold of the state, then what the batch changes added to it; the batch comes twice, stale the second time."""
    from ordermill.operators.metrics import add_signed
    state, batch = _written(spark, state, "state"), _written(spark, batch, "batch")
    gold = _written(spark, start(state), "gold")
    for _ in range(2):
        signed = _written(spark, M.signed_changes(state, batch, ["order_id"], compare, ">", source_order=order), "signed")
        gold = _written(spark, add_signed(gold, gain(signed), by, rows), "gold")
        state = M.apply_changes(state, signed.filter(F.col(M.SIGN) > 0), ["order_id"])
    return gold


@register("daily_metrics_signed", ORACLE["daily_metrics_refresh"])
def q_daily_metrics_signed(spark, sf):
    """Daily gold from signed change rows alone: moved dates, replaced amounts, stale rows."""
    from ordermill.operators.metrics import signed_daily
    tgt, src = _merge_inputs(spark, sf)
    gold = _signed_gold(spark, tgt, src, ["report_date"], "total_orders", ["updated_at"], list(LATEST_ORDER), daily_metrics, signed_daily)
    return gold.withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


@register("total_metrics_signed", ORACLE["total_metrics"])
def q_total_metrics_signed(spark, sf):
    from ordermill.operators.metrics import signed_totals
    ev = _valid_events(spark, sf)
    old, new = [ev.filter(F.col("_batch") == b).select(*EVENT_COLS) for b in (0, 1)]
    return _signed_gold(spark, _event_silver(old).select(*EVENT_COLS), new, [], None, list(EVENT_ORDER), list(EVENT_ORDER),
                        total_metrics, signed_totals)


@register("status_summary_signed", """
SELECT status, COUNT(*) AS order_count, round(CAST(SUM(amount_cents) AS DOUBLE) / 100.0, 2) AS total_amount
FROM (""" + _MERGE_NEWER_SQL + ") merged GROUP BY status")
def q_status_summary_signed(spark, sf):
    from ordermill.operators.metrics import signed_by_status
    tgt, src = _merge_inputs(spark, sf)
    start = lambda state: signed_by_status(state.withColumn(M.SIGN, F.lit(1)))
    gold = _signed_gold(spark, tgt, src, ["status"], "order_count", ["updated_at"], list(LATEST_ORDER), start, signed_by_status)
    return gold.select("status", "order_count", cents_to_amount("total_cents", 2).alias("total_amount"))


# ---------------------------------------------------------------------------
# Upserts into touched buckets, ledgers, audits and run states (M2, M9, D1, D3, I6, A1, A4, ST2)
# ---------------------------------------------------------------------------

@register("merge_bucketed", ORACLE["merge_on_read"])
def q_merge_bucketed(spark, sf):
    """Both batches upserted into a table of key buckets, the second twice; only touched buckets are rewritten."""
    from ordermill.plans.buckets import BucketTable
    tgt, src = _merge_inputs(spark, sf)
    table = BucketTable(spark, scratch_path(spark, "buckets", uuid.uuid4().hex), tgt.schema, ["order_id"], 16)
    src = _written(spark, src, "batch")
    for batch in (_written(spark, tgt, "batch"), src, src):
        table.upsert(batch, ["updated_at"], ">", list(LATEST_ORDER))
    return table.read().select("order_id", "customer_id", "status", "amount_cents", ts_text("updated_at").alias("updated_at"),
                               "_source_file")


@register("stream_audit", O.with_ctes(*_EVENT_SQL, """
v AS (SELECT * FROM valid_events QUALIFY row_number() OVER (PARTITION BY _batch, order_id ORDER BY updated_at DESC, enqueued_at DESC,
      eventhub_partition DESC, kafka_offset DESC) = 1)""", """
changed AS (SELECT s._batch, COUNT(*) AS n FROM v s LEFT JOIN v t ON t._batch < s._batch AND t.order_id = s.order_id
  WHERE t.order_id IS NULL OR s.updated_at > t.updated_at OR (s.updated_at = t.updated_at AND (s.enqueued_at > t.enqueued_at
     OR (s.enqueued_at = t.enqueued_at AND (s.eventhub_partition > t.eventhub_partition
         OR (s.eventhub_partition = t.eventhub_partition AND s.kafka_offset > t.kafka_offset))))) GROUP BY 1)""", """
e AS (SELECT _batch, COUNT(*) AS n FROM event_envelope GROUP BY 1)""", """
g AS (SELECT _batch, COUNT(*) AS n FROM valid_events GROUP BY 1)""", body="""
SELECT 'bronze_events' AS sink, CAST(_batch AS BIGINT) AS batch_id, n AS rows_read, n AS rows_copied, CAST(0 AS BIGINT) AS rows_rejected FROM e
UNION ALL
SELECT 'silver_events', e._batch, e.n, changed.n, e.n - g.n FROM e JOIN changed USING (_batch) JOIN g USING (_batch)"""))
def q_stream_audit(spark, sf):
    """One audit row per micro-batch and sink with what was read, copied and rejected; a replay adds none."""
    from ordermill.streaming.sinks import AUDIT, BronzeSink, EventSilverSink
    env, store = _envelope(spark, sf), _store(spark, "audits")
    for sink in (BronzeSink(store), EventSilverSink(store)):
        for b in (0, 0, 1):
            sink(env.filter(F.col("_batch") == b), b)
    return store.read(AUDIT).drop("content", "audited_at")


@register("file_ledger", O.with_ctes(*_CODED_SQL, """
f AS (SELECT _source_file, COUNT(*) AS bronze_rows FROM coded GROUP BY 1)""", f"""
v AS (SELECT * FROM coded WHERE _source_file IN ('{SLICE_FILE}', '{UPDATE_FILE}'))""", """
p AS (SELECT _source_file, CAST(SUM(CASE WHEN _error_reason = '' THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
             CAST(SUM(CASE WHEN _error_reason <> '' THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows FROM v GROUP BY 1)""", """
c AS (SELECT _source_file, COUNT(*) AS silver_rows FROM (
        SELECT * FROM v WHERE _error_reason = '' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, _version) = 1)
      GROUP BY 1)""", body="""
SELECT _source_file, bronze_rows, coalesce(valid_rows, 0) AS valid_rows, coalesce(rejected_rows, 0) AS rejected_rows,
       coalesce(silver_rows, 0) AS silver_rows, coalesce(valid_rows, 0) - coalesce(silver_rows, 0) AS superseded_rows,
       coalesce(valid_rows + rejected_rows, 0) = bronze_rows AS balanced
FROM f LEFT JOIN p USING (_source_file) LEFT JOIN c USING (_source_file)"""))
def q_file_ledger(spark, sf):
    """The ledger after an ingest, two files processed (one of them twice) and everything ingested again."""
    from ordermill.plans.runs import file_ledger, ingest_bronze, reprocess_file
    store = _store(spark, "ledgers")
    raw = _raw(spark, sf).select(*ORDER_COLS, "_source_file", F.col("_loaded_at").alias("_ingested_at"))
    ingest_bronze(store, raw, "ingest-1")
    for name in (SLICE_FILE, UPDATE_FILE, SLICE_FILE):
        reprocess_file(store, name, f"file-{name}")
    ingest_bronze(store, raw, "ingest-2")
    return file_ledger(store)


@register("run_state_transitions", O.with_ctes(O.RAW_ORDERS, body="""
SELECT run_id, 'SUCCESS' AS run_status, event_count, n AS rows_read, n AS rows_copied
FROM (SELECT _version, COUNT(*) AS n FROM raw_orders GROUP BY 1) r
JOIN (VALUES ('job-1', 0, 2), ('job-2', 1, 4), ('job-3', 1, 2)) v(run_id, version, event_count) ON v.version = r._version"""))
def q_run_state_transitions(spark, sf):
    """A run that fails before its publish and is run again, and one whose export fails after it."""
    from ordermill.plans.runs import run_incremental, run_log
    raw, store = _raw(spark, sf), _store(spark, "states")
    old, new = [raw.filter(F.col("_version") == v).select(*ORDER_COLS) for v in (0, 1)]

    def broken():
        raise RuntimeError("before the commit")

    run_incremental(spark, store, old, run_id="job-1")
    for run_id, options in (("job-2", {"hook": broken}), ("job-2", {}), ("job-3", {"export_dirs": {"processed": "nowhere://x"}})):
        try:
            run_incremental(spark, store, new, run_id=run_id, **options)
        except Exception:
            if not options:
                raise
    return run_state(run_log(store)).select("run_id", "run_status", "event_count", "rows_read", "rows_copied")


# ---------------------------------------------------------------------------
# Files and catalog tables (SC2, SC3, SC5, SC6, SC7, SC13, K1, K2, K4, K5, O4, X14)
# ---------------------------------------------------------------------------

_LINE = "concat_ws(',', coalesce(order_id, ''), coalesce(customer_id, ''), coalesce(status, ''), coalesce(amount_cents, '')"


@register("csv_malformed", O.with_ctes(O.RAW_ORDERS, f"""
bad AS (SELECT DISTINCT CASE WHEN _k % 11 = 0 THEN {_LINE}) ELSE {_LINE}, updated_at, 'extra') END AS raw_row FROM raw_orders
        WHERE _k % 11 = 0 OR _k % 13 = 0)""", body="""
SELECT flow, raw_row FROM bad, (VALUES ('incremental'), ('staging'), ('full load')) f(flow)"""))
def q_csv_malformed(spark, sf):
    """Lines with too few and too many fields through every flow: each is rejected with its raw text."""
    from ordermill.plans.runs import (QUARANTINE, REJECTS_TABLE, STAGED_REJECTS, full_load, run_incremental, run_staging)
    from ordermill.sources.files import CORRUPT, read_orders
    path, store = scratch_path(spark, "malformed", uuid.uuid4().hex), _store(spark, "malformed")
    field = lambda *cols: F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in cols])
    short = field(*ORDER_COLS[:-1])
    line = F.when(F.col("_k") % 11 == 0, short).otherwise(
        F.when(F.col("_k") % 13 == 0, F.concat_ws(",", short, F.col("updated_at"), F.lit("extra"))).otherwise(field(*ORDER_COLS)))
    # one text column whose header line is the five names
    (_raw(spark, sf).select("_version", line.alias(",".join(ORDER_COLS))).write.partitionBy("_version").option("header", True)
     .option("sep", "\x01").option("quote", "\x00").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    for v in (0, 1):
        raw = read_orders(spark, f"{path}/_version={v}", pattern="part-*.csv", empty_as_null=False)
        run_incremental(spark, store, raw, run_id=f"load-{v}")
        run_staging(store, raw, f"staging-{v}", "part-*.csv")
    full_load(store, read_orders(spark, [f"{path}/_version={v}" for v in (0, 1)], pattern="part-*.csv"), "full")
    is_line = ~F.col("raw_row").startswith("{")
    return (store.read(REJECTS_TABLE).filter(is_line).select(F.lit("incremental").alias("flow"), "raw_row")
            .unionByName(store.read(STAGED_REJECTS).filter(is_line).select(F.lit("staging").alias("flow"), "raw_row"))
            .unionByName(store.read(QUARANTINE).filter(F.col(CORRUPT).isNotNull()).select(
                F.lit("full load").alias("flow"), F.col(CORRUPT).alias("raw_row")))).distinct()


@register("csv_inferred", ORACLE["csv_roundtrip"])
def q_csv_inferred(spark, sf):
    """The exported feed read with an inferred schema."""
    from ordermill.plans.store import export_csv
    from ordermill.sources.files import read_orders_inferred
    path = scratch_path(spark, "csv", uuid.uuid4().hex)
    export_csv(_raw(spark, sf), path, columns=ORDER_COLS, ts_columns=())
    return read_orders_inferred(spark, path).select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLS])


@register("blob_roundtrip", ORACLE["csv_roundtrip"])
def q_blob_roundtrip(spark, sf):
    """Export to and read from a ``blob://`` container."""
    from ordermill.plans.store import export_csv
    from ordermill.sources.files import read_orders
    containers = {"processed": scratch_path(spark, "blob", uuid.uuid4().hex)}
    export_csv(_raw(spark, sf), "blob://processed/orders", columns=ORDER_COLS, ts_columns=(), containers=containers)
    return read_orders(spark, "blob://processed/orders", pattern="part-*.csv", containers=containers).select(*ORDER_COLS)


@register("topic_projection", ORACLE["stream_bronze"])
def q_topic_projection(spark, sf):
    """Messages in a topic's own columns, projected to the envelope."""
    from ordermill.streaming.sources import ENVELOPE_EXPRS
    messages = _envelope(spark, sf).select(F.col("raw_json").cast("binary").alias("value"), F.col("eventhub_partition").alias("partition"),
                                           F.col("kafka_offset").alias("offset"), F.col("enqueued_at").cast("timestamp").alias("timestamp"))
    return messages.selectExpr(*ENVELOPE_EXPRS).withColumn("enqueued_at", ts_text("enqueued_at"))


@register("catalog_gold", ORACLE["daily_metrics"])
def q_catalog_gold(spark, sf):
    """A gold table by name: created empty if absent, replaced as select twice, read through SQL and an external view."""
    from ordermill.sources.catalog import create_if_absent, create_or_replace
    from ordermill.sources.files import register_external_view
    name, root = f"gold_daily_{uuid.uuid4().hex}", scratch_path(spark, "catalog")
    gold = _gold(spark, sf).withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))
    for _ in range(2):
        create_if_absent(spark, name, gold.schema, root)
        path = create_or_replace(spark, name, gold, root)
    register_external_view(spark, f"{name}_view", path)
    out = spark.sql(f"SELECT t.* FROM `{name}` t LEFT SEMI JOIN `{name}_view` v ON t.report_date <=> v.report_date")
    out.schema                                             # resolved now: the entries may go, the folder stays
    spark.sql(f"DROP TABLE `{name}`")
    spark.catalog.dropTempView(f"{name}_view")
    return out


@register("overwrite_schema", O.with_ctes(O.RAW_ORDERS, body="""
SELECT order_id, _source_file, CAST(_version AS BIGINT) AS version, CASE WHEN _version = 1 THEN _k END AS added_key FROM raw_orders"""))
def q_overwrite_schema(spark, sf):
    """Bronze overwritten with fewer columns, then appended to with a wider and a new one; all rows read back whole."""
    from ordermill.plans.runs import BRONZE, full_load, ingest_bronze
    store = _store(spark, "schemas")
    base = [*ORDER_COLS, "_source_file", F.col("_loaded_at").alias("_ingested_at")]
    old, new = [_raw(spark, sf).filter(F.col("_version") == v) for v in (0, 1)]
    full_load(store, old.select(*base, F.lit("x").alias("legacy")), "full-1")
    full_load(store, old.select(*base, F.col("_version").cast("int").alias("version")), "full-2")
    ingest_bronze(store, new.select(*base, F.col("_version").cast("bigint").alias("version"), F.col("_k").alias("added_key")), "append")
    out = store.read(BRONZE)
    return out.select(*[c for c in out.columns if c not in (*ORDER_COLS[1:], "_ingested_at")])


@register("duplicate_id_table", O.with_ctes(O.RAW_ORDERS, O.FIRST_ERROR, body="""
SELECT order_id, COUNT(*) AS row_count FROM first_error WHERE error_message = '' GROUP BY 1 HAVING COUNT(*) > 1"""))
def q_duplicate_id_table(spark, sf):
    """Both batches in one load: it fails, and all repeated ids are listed in a table of the run."""
    from ordermill.plans.runs import PipelineError, run_incremental
    try:
        run_incremental(spark, _store(spark, "duplicates"), _raw(spark, sf).select(*ORDER_COLS), run_id="both")
    except PipelineError as e:
        return spark.read.parquet(str(e).rsplit(" ", 1)[1])
    raise AssertionError("the load should have failed")
