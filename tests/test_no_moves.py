"""Bronze and keyed tables are written by the tasks that hold the rows; a first load joins with nothing."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ordermill.operators import merge as M
from ordermill.plans.store import BUCKET, Store
from ordermill.sources import bronze as B
from ordermill.sources.orderfeed import event_envelope, raw_orders


def _orders(spark, folder, files=3):
    path = f"{folder}/orders.parquet"
    (spark.range(600).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                             (F.col("id") * 1.5).alias("o_totalprice"),
                             F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_interval(id % 2)").alias("o_orderdate"))
     .repartition(files).write.parquet(path))
    return spark.read.parquet(path)


def _files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_bronze_is_written_alone_and_in_place(spark, tmp_path):
    orders = _orders(spark, tmp_path)
    before = set(B._WRITTEN)
    raw = B.bronze(spark, str(tmp_path), "raw_orders")
    (key,) = set(B._WRITTEN) - before                        # the envelope is not written for a query that reads raw orders
    assert _rows(raw) == _rows(raw_orders(orders))
    folder = f"{B._WRITTEN[key]}/_source_file=orders_1995.csv"
    assert len(_files(folder)) == orders.rdd.getNumPartitions() > 1     # every task wrote its own rows of it
    assert _rows(B.bronze(spark, str(tmp_path), "event_envelope")) == _rows(event_envelope(raw_orders(orders)))


def test_a_keyed_table_is_written_without_moving_rows_to_their_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=2)
    rows = spark.range(0, 400, 1, 4).select(F.col("id").alias("k"), F.lit(0).alias("x"))
    done = store.publish({"t": rows}, "a", rebuilds={"t": ["k"]})
    assert done.rows["t"] == 400 and not os.path.exists(tmp_path / "lake" / "_work")     # one write, no copy of it
    assert all(len(_files(f"{done.paths['t']}/{BUCKET}={b}")) == 4 for b in (0, 1))
    changes = spark.range(390, 410, 1, 2).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    assert store.publish({"t": changes}, "b", upserts={"t": ["k"]}).rows["t"] == 20
    assert {tuple(r) for r in store.read("t").collect()} == {(k, int(k >= 390)) for k in range(410)}


def test_a_new_keyed_table_without_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    done = store.publish({"t": spark.range(0).withColumnRenamed("id", "k")}, "a", upserts={"t": ["k"]})
    assert done.rows["t"] == 0 and done.paths["t"] is None and store.read("t").count() == 0


def test_a_first_load_is_not_joined_with_the_missing_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    new = M.new_rows(store.read("t", "k bigint, v string"), rows, ["k"])
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString() and new.count() == 10
