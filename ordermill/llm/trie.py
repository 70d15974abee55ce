"""Prefix tree of conversations by padded turn-id matrices.

A turn is known by 120 bits of the md5 of its role and text; a conversation is the array of its turn
ids. Conversations are range-partitioned in the order of these arrays (copies by conv_id, so a group
of copies spreads over ranges). A task cuts its sorted range into blocks of at most ``BLOCK_CELLS``
cells: rows padded to the longest, ``np.lexsort``, column changes between neighbouring rows
OR-accumulated along the row, so that a set bit marks the first row of a node, and ``reduceat`` over
these starts gives every figure of every node of a depth.

All figures are sums or minima over a node's rows, so only nodes on the path of a block's first or
last row stay open. Open parts meet by the digest of their path. A block counts its first row as all
new and its last row as a leaf; where the row before or after it says otherwise (read from the ends
of the blocks alone) the surplus is taken off.

A node is given by its smallest member ``conv_id`` and its ``depth``: its turns are the first
``depth`` turns of that conversation.

Defined cases: rows without conv_id belong to no conversation. A null role or text is empty. Turns
are ordered by turn (null first), then role, then text; repeated rows are turns of their own. An empty
table gives no node. Other columns are ignored. One task holds the turn ids (not the texts) of one
conversation, and, for members that end at one node, their ids pass in pieces through one running
hash, as a SHA-256 is sequential.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored

#: Cells (rows x longest row) of a block's matrix.
BLOCK_CELLS = 1 << 21
#: Conversations that share one head, and the most turns that are taken from it.
FAMILY, HEAD = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
FOUND = ("kind string, part int, block int, depth long, key binary, pkey binary, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
         "first_keys array<binary>, last_keys array<binary>, first_words array<long>")
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """conv_id and ``t``, its turns in order as structs of two halves of the turn id and the turn's words."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", blank("role").alias("role"), blank("text").alias("text"))
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    half = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    placed = rows.select("conv_id", place.alias("place"), digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).alias("words"))
    turn = F.struct("place", half(1).alias("hi"), half(16).alias("lo"), F.col("words").cast("long").alias("words"))
    return placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["hi"].alias("hi"), x["lo"].alias("lo"), x["words"].alias("words"))).alias("t"))


def spliced(arrays: DataFrame) -> DataFrame:
    """Every conversation c with its first h = crc32(c) % HEAD turns replaced by those of conversation c - c % FAMILY."""
    arrays = stored(arrays, "turns")
    heads = arrays.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_base"), F.slice("t", 1, HEAD - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    joined = arrays.join(heads, arrays["conv_id"] - arrays["conv_id"] % FAMILY == heads["_base"], "left")
    own = F.slice("t", h + 1, F.greatest(F.size("t") - h, F.lit(0)))
    return joined.select("conv_id", F.when(F.col("_head").isNull(), own).otherwise(
        F.concat(F.slice("_head", F.lit(1), h), own)).alias("t"))


def path_keys(hi: np.ndarray, lo: np.ndarray) -> list[bytes]:
    """A digest of each prefix of a row, the empty one first."""
    out = [b""]
    for a, b in zip(hi.tolist(), lo.tolist()):
        out.append(hashlib.blake2b(out[-1] + a.to_bytes(8, "big") + b.to_bytes(8, "big"), digest_size=16).digest())
    return out


def joined_ids(conv: np.ndarray) -> str:
    return ",".join(map(str, conv.tolist()))


def block_nodes(part: int, block: int, conv: np.ndarray, lens: np.ndarray, turns: np.ndarray) -> pa.RecordBatch:
    """Nodes of a block's matrix: closed ones ('n'), parts of open ones ('o') and one row of its ends ('e').

    ``turns`` holds (hi, lo, words) of all rows one after another; ``lens`` the turns of each row.
    """
    n, width = len(conv), int(lens.max())
    hi, lo = np.full((n, width), -1, np.int64), np.full((n, width), -1, np.int64)
    words = np.zeros((n, width), np.int64)
    cells = np.arange(width) < lens[:, None]
    hi[cells], lo[cells], words[cells] = turns
    order = np.lexsort([conv, *(m[:, c] for c in range(width - 1, -1, -1) for m in (lo, hi))])
    conv, lens, hi, lo, words, cells = conv[order], lens[order], hi[order], lo[order], words[order], cells[order]
    changed = np.logical_or.accumulate((hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]), axis=1)
    start = np.ones((n, width + 2), bool)
    start[1:, 0], start[:, -1] = False, False
    start[1:, 1:-1] = changed
    start[:, 1:-1] &= cells
    leaf = np.ones(n, np.int64)
    leaf[:-1] = np.where(lens[:-1] > 0, changed[np.arange(n - 1), np.maximum(lens[:-1], 1) - 1], False) if width else 0
    saved = np.zeros((n, width + 1), np.int64)
    saved[:, 1:] = np.cumsum(np.where(start[:, 1:-1], 0, words)[:, ::-1], axis=1)[:, ::-1]
    if width:
        saved[:, 0] = saved[:, 1]
    paths = [path_keys(hi[r, :lens[r]], lo[r, :lens[r]]) for r in (0, n - 1)]
    cols: dict[str, list] = {c: [] for c in ("depth", "key", "pkey", "open", "conv_id", "parent_conv_id", *SUMS, "ends")}
    above = None                                          # of the depth before: node of each row, smallest member, open
    for depth in range(width + 1):
        rows = np.flatnonzero(lens >= depth)
        first = np.flatnonzero(start[rows, depth])
        node = np.cumsum(start[rows, depth]) - 1
        m, conv_here = len(first), conv[rows]
        low = np.minimum.reduceat(conv_here, first)
        add = lambda x: np.add.reduceat(x[rows].astype(np.int64), first)
        key: list[bytes | None] = [None] * m
        if rows[-1] == n - 1:
            key[-1] = paths[1][depth]
        if rows[0] == 0:
            key[0] = paths[0][depth]
        ended = add(lens == depth)
        sizes = np.diff(np.append(first, len(rows)))
        cols["depth"] += [depth] * m
        cols["key"] += key
        cols["conv_id"] += low.tolist()
        cols["n_convs"] += sizes.tolist()
        cols["n_children"] += add(start[:, depth + 1]).tolist()
        cols["n_leaves"] += add(leaf).tolist()
        cols["saved_tokens"] += add(saved[:, depth]).tolist()
        for at, many, k in zip(first.tolist(), ended.tolist(), key):
            ids = joined_ids(conv_here[at:at + many]) if many else None
            cols["ends"].append(ids if k is not None else hashlib.sha256(ids.encode()).hexdigest() if many else NOTHING)
        if above is None:
            cols["parent_conv_id"] += [None] * m
            cols["pkey"] += [None] * m
        else:
            up = above[0][rows[first]].tolist()
            cols["pkey"] += [above[2][u] for u in up]
            cols["parent_conv_id"] += [None if above[2][u] is not None else above[1][u] for u in up]
        of_row = np.zeros(n, np.int64)
        of_row[rows] = node
        above = of_row, low.tolist(), key
    total = len(cols["depth"])
    cols["kind"] = ["n" if k is None else "o" for k in cols["key"]] + ["e"]
    cols.pop("open")
    cols["part"], cols["block"] = [part] * (total + 1), [block] * (total + 1)
    for c in ("depth", "key", "pkey", "conv_id", "parent_conv_id", *SUMS, "ends"):
        cols[c].append(None)
    cols["first_keys"] = [None] * total + [paths[0]]
    cols["last_keys"] = [None] * total + [paths[1]]
    cols["first_words"] = [None] * total + [[0, *np.cumsum(words[0, :lens[0]]).tolist()]]
    kinds = {"kind": pa.string(), "part": pa.int32(), "block": pa.int32(), "key": pa.binary(), "pkey": pa.binary(),
             "ends": pa.string(), "first_keys": pa.list_(pa.binary()), "last_keys": pa.list_(pa.binary()),
             "first_words": pa.list_(pa.int64())}
    names = [c.split()[0] for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(cols[c], kinds.get(c, pa.int64())) for c in names], names)


def _blocks(batches, cells: int):
    """A sorted range cut into (conv, lens, turns) of at most ``cells`` matrix cells, or one row."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = width = 0

    def joined():
        conv, lens, turns = zip(*held)
        return np.concatenate(conv), np.concatenate(lens), np.concatenate(turns, axis=1)

    for batch in batches:
        conv = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        lens = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = lists.flatten()
        turns = np.stack([flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
        ends = np.cumsum(lens)
        at = 0
        while at < len(conv):
            wide = np.maximum.accumulate(np.maximum(lens[at:], width))
            fits = int(np.searchsorted((rows + np.arange(1, len(wide) + 1)) * np.maximum(wide, 1), cells, "right"))
            if not fits and held:
                yield joined()
                held, rows, width = [], 0, 0
                continue
            fits = max(fits, 1)
            begin = ends[at] - lens[at]
            held.append((conv[at:at + fits], lens[at:at + fits], turns[:, begin:ends[at + fits - 1]]))
            rows, width = rows + fits, int(wide[fits - 1])
            at += fits
    if held:
        yield joined()


def prefix_trie(arrays: DataFrame) -> DataFrame:
    """One row per node of the prefix tree of ``t`` (see ``turn_arrays``), with figures of its subtree."""
    cells = BLOCK_CELLS

    def run(batches):
        part = TaskContext.get().partitionId()
        for block, (conv, lens, turns) in enumerate(_blocks(batches, cells)):
            yield block_nodes(part, block, conv, lens, turns)

    ranged = arrays.select("conv_id", "t").repartitionByRange("t", "conv_id").sortWithinPartitions("t", "conv_id")
    found = stored(ranged.mapInArrow(run, FOUND), "trie")
    parts = found.where("kind = 'o'")
    named = parts.select("depth", "key", "pkey", "conv_id", *SUMS).unionByName(_surplus(found), allowMissingColumns=True)
    merged = stored(named.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("pkey").alias("pkey"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in SUMS)), "open-nodes")
    upper = merged.select(F.col("key").alias("pkey"), F.col("conv_id").alias("_parent"))
    opened = (merged.join(upper, "pkey", "left").join(_digests(parts), "key", "left")
              .withColumns({"parent_conv_id": F.col("_parent"), "ends": F.coalesce("ends", F.lit(NOTHING))}))
    # each block's closed children of open nodes meet that block's copy of the parent, so no parent is a hot key
    near = parts.select("part", "block", F.col("key").alias("pkey")).join(upper, "pkey")
    closed = found.where("kind = 'n'")
    beneath = (closed.where("pkey is not null").join(near, ["part", "block", "pkey"])
               .withColumn("parent_conv_id", F.col("_parent")))
    out = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends"]
    return closed.where("pkey is null").select(*out).unionByName(beneath.select(*out)).unionByName(opened.select(*out))


def _surplus(found: DataFrame) -> DataFrame:
    """What blocks count twice: the nodes that a block's first row shares with the row before, and a last row's leaf."""
    ends = found.where("kind = 'e'").select("part", "block", "first_keys", "first_words", "last_keys")
    before = F.lag("last_keys").over(Window.orderBy("part", "block"))   # one light row per block
    shared = ends.withColumn("before", before).where("before is not null").select(
        "first_words", (F.size("before") - 1).alias("length"), F.array_intersect("first_keys", "before").alias("keys"))
    shared = shared.withColumn("common", F.size("keys") - 1)
    rows = shared.select("first_words", "length", "common", F.posexplode("keys").alias("at", "key"))
    words = F.col("first_words")[F.col("common")] - F.col("first_words")[F.greatest(F.col("at") - 1, F.lit(0))]
    return rows.select("key", F.col("at").cast("long").alias("depth"),
                       F.when(F.col("at") < F.col("common"), -1).otherwise(0).cast("long").alias("n_children"),
                       F.when(F.col("common") == F.col("length"), -1).otherwise(0).cast("long").alias("n_leaves"),
                       words.cast("long").alias("saved_tokens"))


def _digests(parts: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined member ids that end at each open node; a node's pieces come in order of the blocks."""
    def run(batches):
        key, digest = None, None
        for batch in batches:
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key:
                    digest.update(b"," + piece.encode())
                    continue
                if digest:
                    yield _digest_row(key, digest)
                key, digest = k, hashlib.sha256(piece.encode())
        if digest:
            yield _digest_row(key, digest)

    pieces = parts.where("ends is not null").select("key", "ends", "part", "block")
    return pieces.repartition("key").sortWithinPartitions("key", "part", "block").mapInArrow(run, "key binary, ends string")


def _digest_row(key: bytes, digest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The prefix tree of the spliced conversations, with the digest of the members that end at each node."""
    return prefix_trie(spliced(turn_arrays(conversations))).withColumnRenamed("ends", "ends_sha256")
