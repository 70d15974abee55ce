"""Streaming sources producing the topic envelope or raw order rows.

With the Kafka connector on the classpath, ``read_topic`` reads a topic; the
same envelope columns can also come from files (a folder the producer drops
envelope parquet/JSON into), which is how local tests run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.events import parse_envelope
from ordermill.schema import ENVELOPE_SCHEMA, RAW_ORDER_SCHEMA
from ordermill.sources.files import CORRUPT

ENVELOPE_EXPRS = ("CAST(value AS STRING) AS raw_json", "partition AS eventhub_partition",
                  "offset AS kafka_offset", "CAST(timestamp AS TIMESTAMP_NTZ) AS enqueued_at")


def read_topic(spark: SparkSession, bootstrap: str, topic: str, stream: bool = True,
               options: dict | None = None) -> DataFrame:
    """Topic -> envelope (raw_json, eventhub_partition, kafka_offset, enqueued_at), from the earliest offset.

    Batch mode reads earliest..latest once; stream mode is resumed from the checkpoint.
    """
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
         .option("startingOffsets", "earliest"))
    if not stream:
        r = r.option("endingOffsets", "latest")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().selectExpr(*ENVELOPE_EXPRS)


def read_envelope_files(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = True,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows from files dropped into ``path`` (file stream stand-in for a topic)."""
    reader = spark.readStream if stream else spark.read
    r = reader.schema(ENVELOPE_SCHEMA).format(fmt)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_order_files(spark: SparkSession, path: str, pattern: str = "orders_*.csv",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """New-file discovery: every CSV matching ``pattern`` that lands in ``path``, once,
    with file lineage (replaces a blob-created trigger). Lines with too few or too many fields
    keep their raw text in ``_corrupt_record``."""
    r = (spark.readStream.schema(T.StructType([*RAW_ORDER_SCHEMA, T.StructField(CORRUPT, T.StringType())])).option("header", True)
         .option("pathGlobFilter", pattern).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path).select("*", F.col("_metadata.file_path").alias("_source_file"),
                              F.current_timestamp().alias("_ingested_at"))


def order_messages(env: DataFrame) -> DataFrame:
    """Single JSON order messages out of a topic envelope: the five fields as text; a message that
    isn't a JSON object keeps its raw text in ``_corrupt_record``."""
    return parse_envelope(env, keep=(), flag_malformed=False, corrupt=CORRUPT)


def read_order_messages(spark: SparkSession, path: str) -> DataFrame:
    """Order messages, one JSON text per line, from files standing in for a topic."""
    return order_messages(spark.readStream.text(path).withColumnRenamed("value", "raw_json"))
