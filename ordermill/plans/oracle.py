"""Reference SQL (DuckDB dialect) for the registered queries.

The CTEs re-derive the same order feed from the benchmark tables that
``ordermill.sources.orderfeed`` derives with DataFrames, so the driver can run
each registered Spark query and its SQL side by side. Conversions use the same
regex guards as ``ordermill.functions.text`` so both engines agree.
"""

from __future__ import annotations

from ordermill.functions.text import INT_TEXT, ISO_TS_TEXT, WHITESPACE  # the same guards as the Spark side

STATUS_LIST = "('PENDING', 'PAID', 'SHIPPED', 'CANCELLED')"
INT_GUARD = "'" + INT_TEXT + "'"
TS_GUARD = "'" + ISO_TS_TEXT + "'"


def int_of(x: str, bits: int = 64) -> str:
    t = "BIGINT" if bits == 64 else "INTEGER"
    return f"CAST(CASE WHEN regexp_matches({x}, {INT_GUARD}) THEN TRY_CAST(trim({x}, ' ') AS {t}) END AS BIGINT)"


def ts_of(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {TS_GUARD}) THEN TRY_CAST({x} AS TIMESTAMP) END"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}, ' ') = '')"


RAW_ORDERS = r"""
raw_orders AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN NULL
         WHEN k % 89 = 0 THEN '  '
         WHEN v = 1 AND k % 53 = 0 THEN ' ORD-' || CAST(k AS VARCHAR) || ' '
         ELSE 'ORD-' || CAST(k AS VARCHAR) END AS order_id,
    CASE WHEN (k + v) % 23 = 0 THEN '' WHEN k % 71 = 0 THEN chr(160) WHEN k % 73 = 0 THEN chr(12288) || ' '
         WHEN k % 79 = 0 THEN chr(9) ELSE 'CUST-' || CAST(c AS VARCHAR) END AS customer_id,
    CASE WHEN k % 29 = 0 THEN 'UNKNOWN' WHEN k % 31 = 0 THEN ' paid '
         WHEN s = 'F' THEN 'SHIPPED' WHEN s = 'O' THEN 'PENDING'
         WHEN k % 2 = 0 THEN 'PAID' ELSE 'CANCELLED' END AS status,
    CASE WHEN k % 37 = 0 THEN '-500' WHEN k % 41 = 0 THEN 'abc' WHEN k % 47 = 0 THEN '0'
         WHEN k % 61 = 0 THEN '3000000000' WHEN k % 67 = 0 THEN '49.9'
         WHEN k % 59 = 0 THEN ' ' || CAST(CAST(round(p * 100) AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(round(p * 100) AS BIGINT) AS VARCHAR) END AS amount_cents,
    CASE WHEN k % 43 = 0 THEN 'not-a-date'
         ELSE strftime(CASE WHEN v = 1 AND k % 3 = 0 THEN d + INTERVAL 10 YEAR ELSE d END, '%Y-%m-%d') || 'T'
              || lpad(CAST((k + CASE WHEN k % 7 = 0 THEN 0 ELSE 5 * v END) % 24 AS VARCHAR), 2, '0')
              || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':00' END AS updated_at,
    'orders_' || CAST(year(d) AS VARCHAR) || CASE WHEN v = 1 THEN '_b' ELSE '' END || '.csv' AS _source_file,
    CASE WHEN v = 1 THEN d + INTERVAL 1 DAY ELSE d END AS _loaded_at,
    v AS _version, k AS _k, d AS _d
  FROM (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_totalprice AS p, o_orderdate AS d, 0 AS v FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, 'F', o_totalprice, o_orderdate, 1 FROM orders
  ) x
)"""

# Typed columns + coded reasons (lakehouse dialect).
CODED = f"""
coded AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN {blank('order_id')} THEN 'missing_order_id' END,
      CASE WHEN {blank('customer_id')} THEN 'missing_customer_id' END,
      CASE WHEN status IS NULL OR status NOT IN {STATUS_LIST} THEN 'invalid_status' END,
      CASE WHEN amt IS NULL THEN 'invalid_amount' END,
      CASE WHEN amt < 0 THEN 'negative_amount' END,
      CASE WHEN ts IS NULL THEN 'invalid_updated_at' END) AS _error_reason
  FROM (SELECT *, {int_of('amount_cents')} AS amt, {ts_of('updated_at')} AS ts FROM raw_orders) t
)"""

# Normalised staging dialect: trimmed ids, upper status, 32-bit amount, messages.
STAGED = f"""
staged AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN {blank('order_id')} THEN 'order_id is missing' END,
      CASE WHEN {blank('customer_id')} THEN 'customer_id is missing' END,
      CASE WHEN {blank('status')} OR upper(trim(status, ' ')) NOT IN {STATUS_LIST} THEN 'status is invalid' END,
      CASE WHEN amt32 IS NULL OR amt32 < 0 THEN 'amount_cents is invalid' END,
      CASE WHEN ts IS NULL THEN 'updated_at is invalid' END) AS error_message
  FROM (SELECT *, {int_of('amount_cents', 32)} AS amt32, {ts_of('updated_at')} AS ts FROM raw_orders) t
)"""

_WS = "regexp_replace({x}, '^" + WHITESPACE + "+|" + WHITESPACE + "+$', '', 'g')"


def _p_missing(x: str) -> str:
    return f"WHEN {x} IS NULL OR {_WS.format(x=x)} = '' THEN coalesce(order_id, 'None') || ': missing {x}'"


# First-error local dialect with messages carrying values.
FIRST_ERROR = f"""
first_error AS (
  SELECT *,
    CASE
      {_p_missing('order_id')}
      {_p_missing('customer_id')}
      {_p_missing('status')}
      {_p_missing('amount_cents')}
      {_p_missing('updated_at')}
      WHEN status NOT IN {STATUS_LIST} THEN coalesce(order_id, 'None') || ': invalid status ' || coalesce(status, 'None')
      WHEN amt IS NULL THEN coalesce(order_id, 'None') || ': invalid amount'
      WHEN amt < 0 THEN coalesce(order_id, 'None') || ': negative amount ' || CAST(amt AS VARCHAR)
      WHEN ts IS NULL THEN coalesce(order_id, 'None') || ': invalid updated_at ' || coalesce(updated_at, 'None')
      ELSE '' END AS error_message
  FROM (SELECT *, {int_of('amount_cents')} AS amt, {ts_of('updated_at')} AS ts FROM raw_orders) t
)"""

RAW_ROW_JSON = ("json_object('amount_cents', amount_cents, 'customer_id', customer_id, 'order_id', order_id, "
                "'status', status, 'updated_at', updated_at)::VARCHAR")

EVENT_ENVELOPE = """
event_envelope AS (
  SELECT
    CASE WHEN _k % 101 = 0 THEN '{broken ' || CAST(_k * 2 + _version AS VARCHAR) ELSE
      '{"order_id":' || coalesce('"' || order_id || '"', 'null')
      || ',"customer_id":"' || replace(customer_id, chr(9), '\\t') || '","status":"' || status || '","amount_cents":'
      || CASE WHEN amount_cents = 'abc' OR _k % 2 = 1 THEN '"' || amount_cents || '"' ELSE amount_cents END
      || ',"updated_at":"' || updated_at || '"}' END AS raw_json,
    CAST(_k % 4 AS INTEGER) AS eventhub_partition,
    CAST(_k * 2 + _version AS BIGINT) AS kafka_offset,
    _loaded_at AS enqueued_at,
    _version AS _batch
  FROM raw_orders
)"""


def _jx(field: str) -> str:
    return f"CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.{field}') END"


PARSED_EVENTS = f"""
parsed_events AS (
  SELECT order_id, customer_id, status, {int_of('amount_text')} AS amount_cents,
         {ts_of('updated_text')} AS updated_at, amount_text, updated_text, malformed,
         eventhub_partition, kafka_offset, enqueued_at, _batch
  FROM (
    SELECT {_jx('order_id')} AS order_id, {_jx('customer_id')} AS customer_id, {_jx('status')} AS status,
           {_jx('amount_cents')} AS amount_text, {_jx('updated_at')} AS updated_text,
           NOT coalesce(json_valid(raw_json), false) AS malformed,
           eventhub_partition, kafka_offset, enqueued_at, _batch
    FROM event_envelope) j
),
valid_events AS (
  SELECT * FROM parsed_events
  WHERE NOT {blank('order_id')} AND NOT {blank('customer_id')} AND status IN {STATUS_LIST}
    AND amount_cents > 0 AND updated_at IS NOT NULL
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()
