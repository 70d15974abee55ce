"""Embedding near-duplicates by Euclidean p-stable hashing (Datar et al.) and exact cosine checks.

Unit vectors are projected on Gaussian directions, the projections are shifted and cut into cells;
``PROJECTIONS`` cells form a bucket of one of ``TABLES`` tables. Two vectors of cosine 0.95 are
0.316 apart and share a cell of ``WIDTH`` with probability 0.87, so a bucket with 0.26 and at
least one of the tables with over 0.999. All vectors of a bucket are compared exactly in double
precision, block against block, each pair in the first table where it meets.

Equal vectors are compared once, as a class with its number of copies. A vector that is null, zero
or holds a null or non-finite component links with nothing; vectors of different dimension don't
link. Repeated rows are copies of each other. Classes are numbered, and vec_ids only name the
results: rows without a vec_id link like others, and a component whose rows all lack one has no
name (null) and keeps one row. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import components, key_bits, stored

THRESHOLD = 0.95
TABLES, PROJECTIONS, WIDTH = 24, 10, 2.0
#: Vectors of a block: a bucket's blocks are compared pair by pair, so no task holds more than two.
BLOCK = 1024
SEED = 20240501


def _directions(dimension: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([SEED, dimension])
    return draw.standard_normal((dimension, TABLES * PROJECTIONS)), draw.uniform(0, WIDTH, TABLES * PROJECTIONS)


def bucket_keys(vectors: np.ndarray) -> np.ndarray:
    """(n, TABLES) bucket keys of unit vectors."""
    directions, shift = _directions(vectors.shape[1])
    cells = np.floor((vectors @ directions + shift) / WIDTH).astype(np.int64).reshape(len(vectors), TABLES, PROJECTIONS)
    key = np.zeros((len(vectors), TABLES), np.uint64)
    for j in range(PROJECTIONS):
        key = (key ^ cells[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. Links are pairs found with cosine >= ``threshold``."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    sound = (F.coalesce(F.size("v"), F.lit(0)) > 0) & F.coalesce(F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(
        F.exists("v", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one value; equal vectors have equal digests
    text = F.array_join(F.transform("v", lambda x: (x + F.lit(0.0)).cast("string")), ",")
    rows = stored(rows.select("vec_id", "v", F.when(sound, F.sha2(text, 256)).alias("class"),
                              F.monotonically_increasing_id().alias("row")), "vectors")
    # any row's vector stands for its class; copies meet before the shuffle
    vectors = stored(rows.where("class is not null").groupBy("class").agg(
        F.min("vec_id").alias("first"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
        .withColumn("rep", F.monotonically_increasing_id()), "classes")

    def keys(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                found = bucket_keys(unit(part.column("v").flatten().to_numpy().reshape(part.num_rows, size)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(found), pa.list_(pa.int64()))],
                                                 ["class", "rep", "copies", "v", "keys"])

    keyed = stored(vectors.select("class", "rep", "copies", "v").mapInArrow(
        keys, "class string, rep long, copies long, v array<double>, keys array<long>"), "keyed")
    places = keyed.select("class", F.size("v").alias("dim"), F.posexplode("keys").alias("t", "key"))
    sizes = (places.groupBy("dim", "t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    met = places.join(sizes.select("dim", "t", "key", "blocks"), ["dim", "t", "key"])
    met = met.withColumn("block", (key_bits(F.col("class"), "block:") % F.col("blocks")).cast("int"))
    # a block meets itself and the blocks after and before it: pairs of blocks (low, high)
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("class", "dim", "t", "key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
                     (F.col("block") < F.col("with")).alias("left"), (F.col("block") > F.col("with")).alias("right"))
    met = met.join(keyed, "class")

    def compare(parts: list[pa.RecordBatch]) -> list[tuple]:
        column = lambda name: np.concatenate([x.column(name).to_numpy(zero_copy_only=False) for x in parts])
        wide = lambda name: np.concatenate([
            x.column(name).flatten().to_numpy().reshape(x.num_rows, -1) for x in parts])
        rep, copies, table = column("rep"), column("copies"), int(column("t")[0])
        vec, own = unit(wide("v")), wide("keys")
        a = np.flatnonzero(~column("right").astype(bool))
        b = np.flatnonzero(~column("left").astype(bool))
        x, y = np.nonzero((vec[a] @ vec[b].T) >= threshold)
        x, y = a[x], b[y]
        new = x < y if parts[0].column("low")[0] == parts[0].column("high")[0] else np.ones(len(x), bool)
        x, y = x[new], y[new]
        if table and len(x):                               # counted where the pair first meets
            first = np.ones(len(x), bool)
            for t in range(table):
                first &= own[x, t] != own[y, t]
            x, y = x[first], y[first]
        links = np.bincount(x, copies[y], len(rep)) + np.bincount(y, copies[x], len(rep))
        # a forest of the links instead of all of them
        root = list(range(len(rep)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out = [(int(rep[i]), int(links[i]), None) for i in np.flatnonzero(links)]
        for i, j in zip(x.tolist(), y.tolist()):
            p, q = find(i), find(j)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((int(rep[i]), 0, int(rep[j])))
        return out

    bucket = ["dim", "t", "key", "low", "high"]

    def walk(batches):
        """The buckets of a sorted partition one after another; only the current one is held."""
        held, at, size = [], None, 0

        def flush():
            out = compare(held) if size > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["rep", "links", "other"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in bucket], 1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                now = keys[s].tobytes()
                if now != at:
                    if size > 1:
                        yield flush()
                    held, at, size = [], now, 0
                held.append(batch.slice(s, e - s))
                size += e - s
        if size > 1:
            yield flush()

    found = stored(met.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(
        walk, "rep long, links long, other long"), "links")
    links = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select(F.col("rep").alias("u"), F.col("other").alias("v")))
    known = stored(vectors.select("class", "first", "row", "copies", "rep").join(links, "rep", "left")
                   .join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
                   .select("class", "first", "row", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                           F.coalesce("component", "rep").alias("component")), "known")
    # stored, so that the join deals both sides and a large component can be split
    named = stored(known.groupBy("component").agg(F.min("first").alias("component_id"), F.min("row").alias("_row")), "components")
    known = stored(known.select("class", "n_links", "component").join(named, "component").drop("component"), "named")
    out = rows.select("vec_id", "class", "row").join(known, "class", "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    unnamed = F.col("n_links").isNotNull() & F.col("component_id").isNull()
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.when(unnamed, F.col("row") == F.col("_row")).otherwise(own.eqNullSafe(F.col("vec_id"))).alias("kept"))
