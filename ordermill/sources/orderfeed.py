"""Order feeds derived from the benchmark's ``orders`` / ``events`` tables.

The benchmark tables hold clean, unique keys. These functions derive what the
order operators consume from *all* their rows: every order appears twice (an
initial version and a later update batch), with deterministic defects injected
by key so every validation rule fires, equal-time pairs for tie rules, padded
ids for key normalisation, and a topic envelope over the same rows. Each
function is a narrow projection (no shuffle), so its work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def _s(c: Column) -> Column:
    return c.cast("string")


def raw_orders(orders: DataFrame) -> DataFrame:
    """Raw order rows (all text) with lineage: versions 0 and 1 of every order.

    Columns: order_id, customer_id, status, amount_cents, updated_at,
    _source_file, _loaded_at, _version, _k, _d.
    """
    base = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
                         F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"),
                         F.col("o_orderdate").alias("d"), F.lit(0).alias("v"))
    update = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
                           F.lit("F").alias("s"), F.col("o_totalprice").alias("p"),
                           F.col("o_orderdate").alias("d"), F.lit(1).alias("v"))
    k, c, s, p, d, v = (F.col(x) for x in "kcspdv")
    cents = _s(F.round(p * 100).cast("bigint"))
    hour = (k + F.when(k % 7 == 0, 0).otherwise(5 * v)) % 24
    # a third of the updates lie well past every existing time, so increments are substantial
    day = F.when((v == 1) & (k % 3 == 0), d + F.expr("INTERVAL 10 YEAR")).otherwise(d)
    return base.unionByName(update).select(
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 89 == 0, F.lit("  "))
         .when((v == 1) & (k % 53 == 0), F.concat(F.lit(" ORD-"), _s(k), F.lit(" ")))
         .otherwise(F.concat(F.lit("ORD-"), _s(k))).alias("order_id"),
        F.when((k + v) % 23 == 0, F.lit("")).when(k % 71 == 0, F.lit("\u00a0")).when(k % 73 == 0, F.lit("\u3000 "))
         .when(k % 79 == 0, F.lit("\t")).otherwise(F.concat(F.lit("CUST-"), _s(c))).alias("customer_id"),
        F.when(k % 29 == 0, F.lit("UNKNOWN")).when(k % 31 == 0, F.lit(" paid "))
         .when(s == "F", F.lit("SHIPPED")).when(s == "O", F.lit("PENDING"))
         .when(k % 2 == 0, F.lit("PAID")).otherwise(F.lit("CANCELLED")).alias("status"),
        F.when(k % 37 == 0, F.lit("-500")).when(k % 41 == 0, F.lit("abc")).when(k % 47 == 0, F.lit("0"))
         .when(k % 61 == 0, F.lit("3000000000")).when(k % 67 == 0, F.lit("49.9"))
         .when(k % 59 == 0, F.concat(F.lit(" "), cents)).otherwise(cents).alias("amount_cents"),
        F.when(k % 43 == 0, F.lit("not-a-date"))
         .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.lpad(_s(hour), 2, "0"), F.lit(":"),
                             F.lpad(_s(k % 60), 2, "0"), F.lit(":00"))).alias("updated_at"),
        F.concat(F.lit("orders_"), _s(F.year(d)), F.when(v == 1, F.lit("_b")).otherwise(F.lit("")),
                 F.lit(".csv")).alias("_source_file"),
        F.when(v == 1, d + F.expr("INTERVAL 1 DAY")).otherwise(d).alias("_loaded_at"),
        v.alias("_version"), k.alias("_k"), d.alias("_d"),
    )


def event_envelope(raw: DataFrame) -> DataFrame:
    """Topic messages carrying the raw rows as JSON text.

    Odd keys (and non-numeric amounts) send ``amount_cents`` in quotes, as a
    string-typed producer does; every 101st message is malformed. Offsets are
    unique and increasing per partition (``2*k + version``), computed per row.
    """
    k = F.col("_k")
    q = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    amount = F.when((F.col("amount_cents") == "abc") | (k % 2 == 1), q(F.col("amount_cents"))) \
        .otherwise(F.col("amount_cents"))
    body = F.concat(
        F.lit('{"order_id":'), F.coalesce(q(F.col("order_id")), F.lit("null")),
        F.lit(',"customer_id":"'), F.replace(F.col("customer_id"), F.lit("\t"), F.lit("\\t")), F.lit('","status":"'), F.col("status"),
        F.lit('","amount_cents":'), amount, F.lit(',"updated_at":"'), F.col("updated_at"), F.lit('"}'))
    return raw.select(
        F.when(k % 101 == 0, F.concat(F.lit("{broken "), _s(k * 2 + F.col("_version")))).otherwise(body).alias("raw_json"),
        (k % 4).cast("int").alias("eventhub_partition"),
        (k * 2 + F.col("_version")).cast("bigint").alias("kafka_offset"),
        F.col("_loaded_at").alias("enqueued_at"),
        F.col("_version").alias("_batch"),
    )


# How benchmark event types map onto pipeline run states.
RUN_STATE_OF_EVENT = (("signup", "RUNNING"), ("click", "RUNNING"), ("view", "RUNNING"),
                      ("purchase", "SUCCESS"), ("error", "FAILED"))


def run_events(events: DataFrame) -> DataFrame:
    """Append-only run events: run_id, run_status, event_at, event_seq."""
    state = F.lit(None).cast("string")
    for et, st in reversed(RUN_STATE_OF_EVENT):
        state = F.when(F.col("event_type") == et, F.lit(st)).otherwise(state)
    return events.select(F.col("user_id").alias("run_id"), state.alias("run_status"),
                         F.col("ts").alias("event_at"), F.col("event_id").alias("event_seq"))


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Benchmark tables."""
    return [spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names]
