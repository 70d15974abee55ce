"""Topic envelopes: parse JSON payloads into order columns, build envelopes from rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.json import to_envelope_value
from ordermill.schema import ORDER_COLUMNS

ENVELOPE_COLUMNS = ("eventhub_partition", "kafka_offset", "enqueued_at")


def parse_envelope(env: DataFrame, keep: Sequence[str] = ENVELOPE_COLUMNS, flag_malformed: bool = True,
                   corrupt: str | None = None) -> DataFrame:
    """``raw_json`` -> the five order fields as text, plus ``_malformed``.

    ``json_tuple`` parses each message once (it is a generator, so filters on
    the fields are not inlined back into repeated parses). Every field is read
    as text (numbers keep their JSON spelling) and converted later by the rule
    set, so quoted numbers are not lost. A malformed message yields NULL fields
    and ``_malformed = true`` instead of failing the batch; ``corrupt`` names a column that
    keeps the raw text of such messages.
    """
    fields = list(ORDER_COLUMNS)
    out = env.select(F.json_tuple(F.col("raw_json"), *fields).alias(*fields), F.col("raw_json").alias("_text"), *keep)
    broken = F.get_json_object("_text", "$").isNull()
    extra = [broken.alias("_malformed")] if flag_malformed else []
    if corrupt:
        extra.append(F.when(broken, F.coalesce("_text", F.lit(""))).alias(corrupt))
    return out.select(*fields, *extra, *keep)


def build_envelope(rows: DataFrame, key: str = "order_id", columns: Sequence[str] = ORDER_COLUMNS) -> DataFrame:
    """Rows -> (key, value) messages for a topic sink: key = order id, value = JSON of the row."""
    return rows.select(F.col(key).cast("string").alias("key"), to_envelope_value(columns).alias("value"))
