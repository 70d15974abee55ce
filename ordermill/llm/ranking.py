"""Ranked lexical search in integers (BM25-like), with bag deduplication.

Each document is cut once into its number of terms ``n`` and its term-frequency vector over the items'
vocabulary. A score depends on that vector and on ``m``, a whole number made from ``n``, alone. So
documents fall into classes of equal (vector, m): classes meet by hash partitioning and are verified
by comparing the whole vectors. A class is scored once, term at a time, and keeps as many of its
smallest doc_ids as a ranking has places; a group of copies of any size is cut to those before it
moves. Every task hands on its best classes of each item, and the rankings are drawn from those.

Items are taken in blocks of about ``BLOCK_TERMS`` terms (at least one item each), so what goes to the
tasks is bounded by that parameter or by one item, and each block reads the documents once.

Defined cases: a null text has no term, nor has one of separators alone; such documents are neither
counted nor ranked, and such items have no rows. Rows of items that repeat (item_id, text) are one item,
rows that share an item_id but not the text are items of their own. Every document row is ranked,
repeated ones too; null doc_ids rank behind others of equal score. Other columns are ignored. An empty
table on either side gives an empty ranking.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored

#: Places of a ranking; term occurrences of a block of items; items scored side by side and classes of a batch.
PLACES, BLOCK_TERMS, ITEMS_ABREAST, CLASSES_ABREAST = 10, 200_000, 256, 4096
#: Fixed values of the score: 75 of 100 parts of the length count, terms saturate against 8 * m.
SCALE, LENGTH_PARTS, SATURATION, LOG_SCALE = 1_000_000_000, 75, 8, 1000
#: Bytes of the UTF-8 text: A-Z in lower case, every other ASCII byte that is no letter or digit a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, score long, doc_ids array<long>"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def item_blocks(items: DataFrame):
    """Blocks of distinct items as lists of (item_id, terms); items are spread over blocks by hash."""
    rows = stored(items.select("item_id", F.col("text").cast("string").alias("text")).distinct(), "items")
    most = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-most // (2 * BLOCK_TERMS)) or 1            # a term takes a character and a separator at least
    for b in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        found = [(r["item_id"], terms_of(bytes(r["text"]))) for r in
                 mine.select("item_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
                 .orderBy("item_id", "text").toLocalIterator()]
        yield [x for x in found if x[1]]


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, and the vocabulary's terms (places in it, ascending) with their occurrences; documents with a term only."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def run(batches):
        for batch in batches:
            n, terms, tfs, offsets, kept = [], [], [], [0], []
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(words)
                mine = sorted((place[t], found[t]) for t in place.keys() & found.keys())
                kept.append(row)
                n.append(len(words))
                terms += [t for t, _ in mine]
                tfs += [k for _, k in mine]
                offsets.append(len(terms))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()), lists(terms), lists(tfs)],
                ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, VECTORS)


def classes(found: DataFrame, documents: int, occurrences: int) -> DataFrame:
    """(m, terms, tfs, doc_ids): documents with equal vector and m, and the smallest doc_ids of each class in order.

    The ranks are cut inside the map tasks first, so a hot class sends at most PLACES rows from each.
    """
    m = F.lit(100 - LENGTH_PARTS) + F.expr(f"({LENGTH_PARTS}L * n * {documents}L) div {occurrences}L")
    rows = found.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    rows = rows.withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    order = Window.partitionBy("hash", "m", "terms", "tfs").orderBy(F.col("doc_id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PLACES)
    return few.groupBy("hash", "m", "terms", "tfs").agg(
        F.sort_array(F.collect_list(F.struct("place", "doc_id"))).alias("members")).select(
        "m", "terms", "tfs", F.col("members.doc_id").alias("doc_ids"))


def weight(documents: int, df: int) -> int:
    return math.floor(LOG_SCALE * math.log((2 * documents + 2) / (2 * df + 1)))


class Postings:
    """Items by term: for each group of items abreast, its terms and, of each, the items and weight x occurrences there."""

    def __init__(self, items: list[Counter], weights: np.ndarray):
        self.groups = []
        for at in range(0, len(items), ITEMS_ABREAST):
            part = items[at:at + ITEMS_ABREAST]
            term = np.array([t for c in part for t in c], np.int64)
            item = np.repeat(np.arange(len(part)), [len(c) for c in part])
            value = np.array([k for c in part for k in c.values()], np.int64) * weights[term]
            order = np.argsort(term, kind="stable")
            own, first = np.unique(term[order], return_index=True)
            self.groups.append((at, len(part), own, np.append(first, len(term)), item[order], value[order]))


def best_classes(found: DataFrame, postings: Postings) -> DataFrame:
    """(item, score, doc_ids) of each task's best classes: at most PLACES an item, by score and then smallest doc_id."""
    def run(batches):
        best: dict[int, list[tuple[int, float, list]]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, CLASSES_ABREAST):
                _score(batch.slice(at, CLASSES_ABREAST), postings, best)
        rows = [(item, score, ids) for item, kept in best.items() for score, _, ids in kept]
        item, score, ids = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score, pa.int64()),
                                          pa.array(ids, pa.list_(pa.int64()))], ["item", "score", "doc_ids"])

    return found.mapInArrow(run, BEST)


def _score(batch: pa.RecordBatch, postings: Postings, best: dict) -> None:
    n = batch.num_rows
    sizes = np.diff(batch.column(1).offsets.to_numpy())
    terms = batch.column(1).flatten().to_numpy().astype(np.int64)
    tfs = batch.column(2).flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(n), sizes)
    m = batch.column(0).to_numpy()[row]
    impact = (SCALE * tfs) // (1000 * tfs + SATURATION * m)
    order = np.argsort(terms, kind="stable")
    own, first = np.unique(terms[order], return_index=True)
    first = np.append(first, len(terms))
    ids = batch.column(3)
    smallest = ids.flatten().take(ids.offsets.slice(0, n) if not ids.offsets[0].as_py() else pa.array(
        ids.offsets.to_numpy()[:n] - ids.offsets[0].as_py()))
    lead = smallest.cast(pa.float64()).fill_null(math.inf).to_numpy(zero_copy_only=False)   # orders only within a batch's cut
    exact = smallest.to_pylist()
    for at, width, has, begin, item, value in postings.groups:
        total = np.zeros((width, n), np.int64)
        _, ours, theirs = np.intersect1d(own, has, assume_unique=True, return_indices=True)
        for i, j in zip(ours.tolist(), theirs.tolist()):    # a term meets each of its items and classes once
            part, posted = order[first[i]:first[i + 1]], slice(begin[j], begin[j + 1])
            total[item[posted, None], row[part]] += value[posted, None] * impact[part]
        for k in range(width):
            scores = total[k]
            kept = best.setdefault(at + k, [])
            least = max(kept[-1][0] if len(kept) == PLACES else 1, 1)
            near = np.flatnonzero(scores >= least)
            if len(near) > PLACES:
                cut = np.partition(scores[near], len(near) - PLACES)[len(near) - PLACES]
                near = near[scores[near] >= cut]
                if len(near) > PLACES:                      # ties at the cut: by the smallest doc_id
                    near = near[np.lexsort([lead[near], -scores[near]])]
                    edge = near[PLACES - 1]
                    near = near[(scores[near] > scores[edge]) | (lead[near] <= lead[edge])]
            if len(near):
                kept += [(int(scores[i]), math.inf if exact[i] is None else exact[i], ids[int(i)].as_py()) for i in near.tolist()]
                kept.sort(key=lambda x: (-x[0], x[1]))
                del kept[PLACES:]


def rank(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the PLACES best documents of each item with a score above 0."""
    spark, out = docs.sparkSession, None
    for block in item_blocks(items):
        vocabulary = sorted({t for _, terms in block for t in terms})
        place = {t: i for i, t in enumerate(vocabulary)}
        found = stored(vectors(docs, vocabulary), "vectors")
        documents, occurrences = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())   # at most the vocabulary
        weights = np.array([weight(documents, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        postings = Postings([Counter(place[t] for t in terms) for _, terms in block], weights)
        top = best_classes(stored(classes(found, documents, occurrences), "classes"), postings)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = (top.select("item", "score", F.explode("doc_ids").alias("doc_id"))
                  .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PLACES))
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(block)), pa.int32()),
                                                "item_id": pa.array([i for i, _ in block], pa.int64())}))
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
