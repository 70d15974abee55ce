"""Near-duplicate documents by BagMinHash (Ertl): weighted-Jaccard signatures of word shingles.

A document is the multiset of its runs of five words (lower-cased, cut at white space); likeness is
the weighted Jaccard similarity, the overlap of two multisets over their union.

Signature: the weight axis of a shingle is discretised at the integers and grouped in the blocks
(0, 1], (1, 2], (2, 4], (4, 8], ... A block is a Poisson process seeded by shingle and block, with
a rate in proportion to its length; each point picks one of ``REGISTERS`` registers. A point of a
longer block falls into one half, both halves go on as processes of their own, and halves above the
shingle's count are dropped. A register keeps its earliest point, so two registers agree with
probability equal to the likeness. Points come in ascending order and stop at the latest register.

Search: registers are banded. In each bucket all members are first compared with the smallest one
(a star, not all pairs). Buckets whose members are then still in different classes are compared
completely, block against block inside tasks, so no link between bucket members is lost.

Equal texts are compared once, as one text, whatever the doc_ids of their rows: a text is known by
its digest, and a doc_id only names the class. A text of fewer than five words has one shingle of
all its words; null texts and texts without words only equal themselves: null texts are classes of
their own, equal texts one class. The class of rows that all lack a doc_id has no name (null).
Repeated rows keep their class; rows sharing a doc_id but not the text are in the classes of their
texts. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import components, key_bits, stored, whole_row

WORDS, THRESHOLD = 5, 0.8
#: 32 bands of 8 registers: two texts of likeness 0.8 share a band with probability 0.997, of 0.5 with 0.12.
BANDS, ROWS = 32, 8
REGISTERS = BANDS * ROWS
#: Documents of a block of the complete comparison.
BLOCK = 128
#: Odd 64-bit constants of the hash mixing.
GOLDEN, MIX_A, MIX_B, BASE = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x100000001B3
POINTS = np.dtype([("doc", np.int64), ("shingle", np.uint64), ("low", np.int64), ("size", np.int64),
                   ("count", np.int64), ("x", np.float64)])


def mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(MIX_A)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(MIX_B)
    return v ^ (v >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


INVERSE = pow(BASE, -1, 1 << 64)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of a text's shingles: polynomial hashes of all shingles from one running sum."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), np.uint8)
    run = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), BASE))))
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    if len(words) >= WORDS:
        starts, ends = starts[:len(words) - WORDS + 1], ends[WORDS - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    value = (run[ends] - run[starts]) * _powers(len(data), INVERSE)[starts]
    return np.unique(mixed(value ^ (ends - starts).astype(np.uint64) * np.uint64(GOLDEN)), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum()) + int(b[1].sum()) - both
    return both / total if total else 0.0


def signatures(docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(documents, REGISTERS) ids of the earliest points; the row of a document without shingles is 0."""
    best = np.full((len(docs), REGISTERS), np.inf)
    ids = np.zeros((len(docs), REGISTERS), np.uint64)
    sizes = np.array([len(s) for s, _ in docs], np.int64)
    shingle = np.concatenate([s for s, _ in docs]) if len(docs) else np.zeros(0, np.uint64)
    count = np.concatenate([c for _, c in docs]) if len(docs) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    leaves, inner = [], []
    low, size = 0, 1
    while len(doc):                                       # blocks (0, 1], (1, 2], (2, 4], ... below each count
        part = np.zeros(len(doc), POINTS)
        part["doc"], part["shingle"], part["low"], part["size"], part["count"] = doc, shingle, low, size, count
        (leaves if size == 1 else inner).append(part)
        low, size = low + size, max(1, low + size) if low else 1
        more = count > low
        doc, shingle, count = doc[more], shingle[more], count[more]
    leaf = np.concatenate(leaves) if leaves else np.zeros(0, POINTS)
    node = np.concatenate(inner) if inner else np.zeros(0, POINTS)
    drawn = np.zeros(len(leaf), np.uint64)

    def seed(p: np.ndarray) -> np.ndarray:
        return mixed(p["shingle"] + p["low"].astype(np.uint64) * np.uint64(GOLDEN) + p["size"].astype(np.uint64))

    def gap(r: np.ndarray) -> np.ndarray:
        return -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))

    def note(doc: np.ndarray, x: np.ndarray, r: np.ndarray) -> None:
        point = mixed(r + np.uint64(GOLDEN))
        at = doc * REGISTERS + (point % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(best.ravel(), at, x)
        won = best.ravel()[at] == x
        ids.ravel()[at[won]] = point[won] | np.uint64(1)

    latest = np.full(len(docs), np.inf)
    aim = 1.2 * REGISTERS * (np.log(REGISTERS) + 2)
    while len(leaf) or len(node):
        if len(leaf):
            many = np.bincount(leaf["doc"], minlength=len(docs))
            k = np.maximum(1, np.ceil(aim / np.maximum(many, 1))).astype(np.int64)[leaf["doc"]]
            at = np.repeat(np.arange(len(leaf)), k)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(k) - k, k)
            r = mixed(np.repeat(seed(leaf), k) + (drawn[at] + nth.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
            run = np.cumsum(gap(r))
            ends = np.cumsum(k) - 1
            before = np.append(0.0, run[ends[:-1]])
            x = leaf["x"][at] + (run - before[at]) / REGISTERS
            note(leaf["doc"][at], x, r)
            leaf["x"], drawn = x[ends], drawn + k.astype(np.uint64)
            latest = best.max(1)
            live = leaf["x"] < latest[leaf["doc"]]
            leaf, drawn = leaf[live], drawn[live]
            aim = max(aim / 4, 1.0)
        if len(node):
            r = mixed(seed(node) + np.uint64(GOLDEN))
            node["x"] += gap(r) / (REGISTERS * node["size"])
            live = node["x"] < latest[node["doc"]]
            node, r = node[live], r[live]
            todo, new = [], []
            turn = 0
            while len(node):                               # a point goes down to a unit interval
                half = node["size"] // 2
                right = (mixed(r ^ np.uint64(MIX_A)) >> np.uint64(turn) & np.uint64(1)).astype(np.int64)
                hit, other = node.copy(), node.copy()
                hit["size"], other["size"] = half, half
                hit["low"] += half * right
                other["low"] += half * (1 - right)
                other = other[other["low"] < other["count"]]
                new.append(other[other["size"] == 1])
                todo.append(other[other["size"] > 1])
                kept = hit["low"] < hit["count"]
                hit, r = hit[kept], r[kept]
                unit = hit["size"] == 1
                if unit.any():
                    note(hit["doc"][unit], hit["x"][unit], r[unit])
                    new.append(hit[unit])
                node, r, turn = hit[~unit], r[~unit], turn + 1
            node = np.concatenate(todo) if todo else np.zeros(0, POINTS)
            fresh = np.concatenate(new) if new else np.zeros(0, POINTS)
            leaf, drawn = np.concatenate((leaf, fresh)), np.concatenate((drawn, np.zeros(len(fresh), np.uint64)))
            latest = best.max(1) if len(docs) else latest
    return ids


def bands(ids: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys."""
    key = np.zeros((len(ids), BANDS), np.uint64)
    rows = ids.reshape(len(ids), BANDS, ROWS)
    for j in range(ROWS):
        key = mixed(key * np.uint64(GOLDEN) + rows[:, :, j])
    return key.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, same, keys, row): digest of the text (null for null), its band keys (null without words), row number; stored."""
    def run(batches):
        for batch in batches:
            ids, same, texts = (batch.column(i) for i in range(3))
            texts = texts.to_pylist()
            for at in range(0, len(texts), 128):
                found = [shingles(t) for t in texts[at:at + 128]]
                keys = bands(signatures(found))
                yield pa.RecordBatch.from_arrays(
                    [ids[at:at + 128], same[at:at + 128],
                     pa.array([k if len(s) else None for k, (s, _) in zip(keys, found)], pa.list_(pa.int64()))],
                    ["doc_id", "same", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.col("text"), 256).alias("same"), "text")
    found = rows.mapInArrow(run, "doc_id long, same string, keys array<long>")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "signed")


def compared(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``threshold`` alike; ``texts`` has (id, text)."""
    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            out = []
            for a, b, one, two in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last[0] != (a, one):
                    last = ((a, one), shingles(one))
                if overlap(last[1], shingles(two)) >= threshold:
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())],
                                             ["u", "v"])

    joined = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("two")), "b")
              .join(texts.select(F.col("id").alias("a"), F.col("text").alias("one")), "a"))
    return joined.select("a", "b", "one", "two").mapInArrow(run, "u long, v long")


def rest_links(groups: DataFrame, threshold: float) -> DataFrame:
    """Links between members of different classes inside (band, key, low, high) groups, as a forest (u, v)."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        pdf = pdf.sort_values("id")
        group, ids = pdf["class"].to_numpy(), pdf["id"].to_numpy()
        if (group == group[0]).all():
            return none
        a = np.flatnonzero(~pdf["right"].to_numpy(bool))
        b = np.flatnonzero(~pdf["left"].to_numpy(bool))
        found = [shingles(t) for t in pdf["text"]]
        weight = np.array([c.sum() for _, c in found])
        # a shingle's copies count as features of their own, so the overlap is a product of 0/1 matrices
        feature = [mixed(np.repeat(s, c) + (np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)).astype(np.uint64)
                         * np.uint64(GOLDEN)) for s, c in found]
        doc = np.repeat(np.arange(len(found)), weight)
        _, column, times = np.unique(np.concatenate(feature), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        _, column = np.unique(column[shared], return_inverse=True)
        doc = doc[shared]
        order = np.argsort(column, kind="stable")
        doc, column = doc[order], column[order]
        both = np.zeros((len(a), len(b)))
        step = 8192
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            i, j = np.searchsorted(column, [at, at + step])
            part = np.zeros((len(found), step), np.float32)
            part[doc[i:j], column[i:j] - at] = 1
            both += part[a] @ part[b].T
        near = both >= threshold * (weight[a][:, None] + weight[b][None, :] - both) - 1e-9
        x, y = np.nonzero(near & (group[a][:, None] != group[b][None, :]))
        root = {g: g for g in set(group.tolist())}

        def find(g):
            while root[g] != g:
                g = root[g]
            return g

        edges = []
        for i, j in zip(a[x].tolist(), b[y].tolist()):
            p, q = find(group[i]), find(group[j])
            if p != q and overlap(found[i], found[j]) >= threshold:
                root[max(p, q)] = min(p, q)
                edges.append((ids[i], ids[j]))
        return pd.DataFrame(edges, columns=["u", "v"], dtype=np.int64) if edges else none

    return groups.groupBy("band", "key", "low", "high").applyInPandas(compare, "u long, v long")


def text_classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows, the distinct texts (same, class) and the classes (class, class_id, row, doc_id, same).

    Texts are numbered; a number means nothing outside of one call. A class has its smallest doc_id as class_id,
    its smallest row number, and of the texts that have this doc_id the one with the smallest digest.
    """
    rows = signed(docs)
    reps = stored(rows.where("same is not null").groupBy("same").agg(
        F.min("doc_id").alias("first"), F.min("row").alias("row"), F.first("keys").alias("keys"))
        .withColumn("id", F.monotonically_increasing_id()), "texts")
    members = stored(reps.where("keys is not null").select("id", F.posexplode("keys").alias("band", "key")), "members")
    hubs = stored(members.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1"), "hubs")
    inside = stored(members.join(hubs, ["band", "key"]), "inside")
    pairs = stored(inside.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    # grows with the data, so it is never broadcast
    wanted = reps.select("id", "same").join(inside.select("id").distinct(), "id", "left_semi").hint("merge")
    # copies of a text meet before the shuffle
    texts = stored(docs.select(F.sha2(F.col("text"), 256).alias("same"), "text").where("text is not null")
                   .dropDuplicates(["same"]).join(wanted, "same").select("id", "text"), "wanted")
    links = stored(compared(pairs, texts, threshold), "links")
    known = components(links)
    # buckets that the stars left in several classes: every pair across classes, in blocks
    classed = stored(inside.join(known.withColumnRenamed("node", "id"), "id", "left")
                     .withColumn("class", F.coalesce("component", "id")).select("band", "key", "id", "n", "class"), "classed")
    mixed_up = stored(classed.groupBy("band", "key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.max("n").alias("n"))
                      .where("lo < hi").select("band", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    if not mixed_up.isEmpty():
        met = classed.select("band", "key", "id", "class").join(mixed_up, ["band", "key"])
        met = met.withColumn("block", (key_bits(F.col("id"), "block:") % F.col("blocks")).cast("int"))
        met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("band", "key", "id", "class", F.least("block", "with").alias("low"),
                         F.greatest("block", "with").alias("high"), (F.col("block") < F.col("with")).alias("left"),
                         (F.col("block") > F.col("with")).alias("right"))
        more = stored(rest_links(met.join(texts, "id"), threshold), "rest")
        known = components(links.unionAll(more))
    named = stored(reps.select("same", "id", "first", "row").join(known.withColumnRenamed("node", "id"), "id", "left")
                   .select("same", "first", "row", F.coalesce("component", "id").alias("class")), "named")
    smallest = F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("same")))
    classes = stored(named.groupBy("class").agg(smallest.alias("_s"), F.min("row").alias("row")).select(
        "class", F.col("_s.first").alias("class_id"), "row", F.col("_s.same").alias("same")), "named-classes")
    return rows, named.select("same", "class"), classes


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, class_id (smallest doc_id of its class) and kept (the row is that document).

    Of a class whose rows all lack a doc_id one row is kept.
    """
    rows, texts, classes = text_classes(docs, threshold)
    named = stored(texts.join(classes.select("class", "class_id", F.col("row").alias("_row")), "class")
                   .select("same", "class_id", "_row"), "named-texts")
    out = rows.select("doc_id", "same", "row").join(named, "same", "left")
    own = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    unnamed = F.col("same").isNotNull() & F.col("class_id").isNull()
    return out.select("doc_id", own.alias("class_id"),
                      F.when(unnamed, F.col("row") == F.col("_row")).otherwise(own.eqNullSafe(F.col("doc_id"))).alias("kept"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, whatever its doc_id: a row with the smallest doc_id of the class.

    If texts of the class share that doc_id, or all lack one, the text with the smallest digest stays; of its rows
    the one with the smallest hash. Null texts stay, once for each doc_id, and all that lack one.
    """
    rows, _, classes = text_classes(docs, threshold)
    # a digest has 64 characters, so digest, id or both are told apart
    key = lambda same, doc_id: F.concat_ws(":", same, doc_id.cast("string"))
    keys = (classes.select(key(F.col("same"), F.col("class_id")).alias("key")).unionAll(
        rows.where("same is null and doc_id is not null").select(key(F.col("same"), F.col("doc_id")).alias("key")).distinct()))
    # copies meet before the shuffle; the documents travel as one column, so that no name of theirs meets "key"
    kept = (docs.where("text is not null or doc_id is not null")
            .select(key(F.sha2(F.col("text"), 256), F.col("doc_id").cast("long")).alias("key"), whole_row(docs))
            .groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
            .join(keys, "key", "left_semi"))
    return kept.select("row.*").unionAll(docs.where("text is null and doc_id is null"))
