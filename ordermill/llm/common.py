"""Helpers shared by the operators: stored intermediates, gapless ranks, neighbours in key order, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.session import conf_override, scratch_path

#: Of the rows that go to a Python worker at a time: long texts fill a batch by bytes before they do by rows.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: later jobs and lost executors reread the table, and a result that
    several branches use is computed once. Readers get column pruning. Rows go to Python workers in
    small ``BATCHES``, so that neither they nor the JVM hold many whole texts at once.
    """
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    with conf_override(df.sparkSession, BATCHES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_bits(key: Column, salt: str = "") -> Column:
    """A stable 60-bit integer of a key: the first 15 hex digits of md5(salt || key as text).

    A null key counts as the empty text. md5 is the same in every engine and language.
    """
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, ``row``; ``select("row.*")`` gives them back, whatever their names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def with_rank(df: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Add a gapless rank from 0 within each ``group`` without ever sorting a whole group in one task.

    ``bucket`` (a deterministic integer) cuts each group into pieces. Pieces are counted with a
    partial aggregate, a running sum over the few counts of a group gives each piece its first
    rank, and rows are numbered inside their piece. The order is (bucket, order).
    """
    b, base = f"_{name}_bucket", f"_{name}_base"
    rows = df.withColumn(b, bucket)
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy(*group, b).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn(base, F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*group, b).orderBy(*order)
    numbered = rows.withColumn(name, (F.row_number().over(inside) - 1).cast("long"))
    return (numbered.join(counts, [*group, b])
            .withColumn(name, F.col(name) + F.col(base)).drop(b, base))


def neighbours(keys: DataFrame, key: str, size: str | None = None, room: int = 1 << 20) -> DataFrame:
    """For distinct non-null keys: ``lower`` and ``higher``, the adjacent keys, wrapping around at both ends.

    With a column of sizes, adjacent keys also form runs: ``run`` (long), ``at`` (long; one more than that of the
    key before in the run) and ``begins`` (first of its run). The sizes of a run, but for its first, stay within ``room``.

    Keys are range-partitioned and stored with their partition number (so that every later job
    sees the same ranges), adjacent keys are found inside each range, and only the first and last
    key of each range meet in a window over the ranges.
    """
    ranged = stored(keys.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_part").orderBy(key)
    parts = Window.orderBy("_part")
    ends = ranged.groupBy("_part").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (ends.withColumn("_below", F.coalesce(F.lag("_last").over(parts), F.last("_last").over(whole)))
            .withColumn("_above", F.coalesce(F.lead("_first").over(parts), F.first("_first").over(whole)))
            .select("_part", "_below", "_above"))
    found = ranged.withColumns({"lower": F.lag(key).over(inside), "higher": F.lead(key).over(inside)})
    if size:
        sizes = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = found.withColumns({"at": F.row_number().over(inside).cast("long"),
                                   "run": F.shiftleft(F.col("_part").cast("long"), 40) + F.floor(sizes / room)})
        found = found.withColumn("begins", F.coalesce(F.lag("run").over(inside) != F.col("run"), F.lit(True)))
    return (found.join(ends, "_part")
            .withColumns({"lower": F.coalesce("lower", "_below"), "higher": F.coalesce("higher", "_above")})
            .drop("_part", "_below", "_above"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected edge list (u, v); component is the smallest node reachable.

    Large-star / small-star contraction: every round hangs each neighbourhood under its smallest
    member, so a long chain halves and a hot hub stays a plain aggregate and an equi-join. The
    rounds end when the edge list no longer changes; each round's lists are stored.
    """
    def settle(e: DataFrame) -> tuple[DataFrame, tuple]:
        e = stored(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "edges")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        return e, tuple(mark)

    edges, mark = settle(edges)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are stored, so that the join behind them can split the edges of a hub
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))))
        edges, after = settle(small)
        if after == mark:
            break
        mark = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
