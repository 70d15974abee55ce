"""Sharding by jump consistent hashing (Lamping and Veach): no ring table, minimal movement.

Inputs: any table with a key column. A null key counts as the empty text, so all null keys share
a shard. Repeated keys share a shard. An empty table gives an empty result. Columns of the input
that clash with the added names are replaced by them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import key_bits, with_rank

#: Multiplier of the published generator, and the pieces a shard is numbered in.
MULTIPLIER = 2862933555777941757
SLOT_PIECES = 4096


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key. All keys jump together; a key stops once it leaves the range."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Shard (int, from 0) of a key column of any type that casts to text."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def place(bits: pd.Series) -> pd.Series:
        return pd.Series(jump(bits.to_numpy(np.int64), shards).astype(np.int32))

    return place(key_bits(key))


def shard_table(df: DataFrame, key: str, shards: int, order: list[Column]) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (gapless from 0 in each shard).

    The key and the shard count decide, so one more shard takes rows only into itself. Slots
    follow (a hash piece of the ``order`` columns, ``order``), so rows that share a key but not the rest
    of ``order`` are numbered in many tasks; rows equal in ``order`` may swap slots.
    """
    df = df.drop("shard", "grown_shard", "slot")
    placed = df.withColumns({"shard": jump_shard(F.col(key), shards), "grown_shard": jump_shard(F.col(key), shards + 1)})
    whole = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in order])
    return with_rank(placed, ["shard"], (key_bits(whole, "slot:") % SLOT_PIECES).cast("int"), order, "slot")


def document_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Shards of documents with size and checksum of their texts (null text: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_table(light, "doc_id", shards, order).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
