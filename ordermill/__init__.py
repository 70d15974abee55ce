"""ordermill: order-record operators for PySpark.

Schema-checked ingestion, rule-based validation with quarantine, latest-record
deduplication, idempotent merges, high-watermark increments and replay windows,
daily/total/per-status metrics, data-quality reports and run history, expressed
as DataFrame -> DataFrame functions (batch) and Structured Streaming jobs.
"""

__version__ = "0.1.0"
