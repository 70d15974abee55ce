"""Schemas and fixed domain values.

The values under "Fixed values" must equal the upstream order system's for the
results to agree (column order of the raw file, allowed statuses, labels).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the upstream order feed exactly)
# ---------------------------------------------------------------------------
ORDER_COLUMNS = ("order_id", "customer_id", "status", "amount_cents", "updated_at")
ALLOWED_STATUSES = ("PENDING", "PAID", "SHIPPED", "CANCELLED")
STATUS_LABELS = (
    ("PAID", "Paid"),
    ("SHIPPED", "Shipped"),
    ("CANCELLED", "Cancelled"),
    ("PENDING", "Pending"),
)
PIPELINE_NAME = "orders_pipeline"
REJECTED_EXPORT_COLUMNS = ORDER_COLUMNS + ("error_message",)
# ---------------------------------------------------------------------------

# Raw order file: five text columns, header in exactly this order.
RAW_ORDER_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ORDER_COLUMNS])

# Typed order row after validation.
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("amount_cents", T.LongType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), True),
    ]
)

# Topic message envelope as stored in a bronze table.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("raw_json", T.StringType(), True),
        T.StructField("eventhub_partition", T.IntegerType(), True),
        T.StructField("kafka_offset", T.LongType(), True),
        T.StructField("enqueued_at", T.TimestampNTZType(), True),
    ]
)

# Event payload, every field read as text: producers send numbers in quotes,
# so a LongType field would turn "4990" into NULL and silently drop the event.
PAYLOAD_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ORDER_COLUMNS])
