"""Quality scores by a generalised additive model with pairwise interactions.

Features are shares and logarithms that describe the whole text. Each is cut into bins at quantiles
of the training rows. Boosting goes round the features again and again; each turn fits a shallow tree
to the gradients summed by bin and adds a small part of it to the feature's lookup table. Then the
pairs of features that explain most of what is left get tables of their own in the same way. A score
is the logistic function of a sum of table cells, so scoring is a binning and additions.

Training reads at most ``SAMPLE`` labelled rows, those whose doc_id hashes lowest; their features, not
texts, go to the driver. Rounds end where rows set aside (every ``ASIDE``-th) fare best.

Defined cases: a null or empty text has the features of no words and a score like any other. Label rows
without doc_id or quality don't train; of several labels of a doc_id the lowest counts; any quality
above 0 is 1. Rows that repeat a doc_id are each scored. Without training rows every score is 0.5,
with rows of one class it is their smoothed share. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math
import sys
import types
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that training reads at most, and which of them are set aside.
SAMPLE, ASIDE = 20_000, 6
#: Bins of a feature, of each side of a pair, leaves of a tree, rounds, share of a tree that is added, pairs.
BINS, PAIR_BINS, LEAVES, ROUNDS, RATE, PAIRS = 32, 8, 4, 200, 0.1, 8
#: Smoothing of a leaf, and the weight (sum of p (1 - p)) that each side of a split needs.
SMOOTH, LEAST = 1.0, 0.5
KEEP = 0.7
FEATURES = ["chars", "words", "word_length", "symbols", "marks", "capitals", "digits", "repeats", "distinct", "top_word",
            "exclamations", "bare_symbols", "shouted", "line_words", "distinct_lines", "sentence_words", "packed_size"]
#: Kinds of characters.
SPACE, LETTER, CAPITAL, DIGIT, MARK, SYMBOL = range(6)


def kinds() -> np.ndarray:
    """The kind of each code point; kept for the life of the worker."""
    kept = sys.modules.setdefault("_llm_worker_kept", types.ModuleType("_llm_worker_kept"))
    if not hasattr(kept, "kinds"):
        def kind(c: str) -> int:
            return (SPACE if c.isspace() else CAPITAL if c.isupper() else LETTER if c.isalpha() else DIGIT if c.isdigit()
                    else MARK if c in ".,;:!?'\"()-" else SYMBOL)
        kept.kinds = np.fromiter((kind(chr(i)) for i in range(0x110000)), np.uint8, 0x110000)
    return kept.kinds


def features(text: str | None) -> list[float]:
    """The FEATURES of a whole text, in order."""
    text = text or ""
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    by = np.bincount(kinds()[code], minlength=6)
    solid = max(int(by[LETTER:].sum()), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode("utf-8", "surrogatepass")
    return [
        math.log1p(len(text)), math.log1p(len(words)), solid / n, by[SYMBOL] / solid, by[MARK] / solid,
        by[CAPITAL] / max(by[LETTER] + by[CAPITAL], 1), by[DIGIT] / solid,
        sum(map(str.__eq__, words, words[1:])) / n, len(counts) / n, max(counts.values(), default=0) / n,
        text.count("!") / n, sum(k for w, k in counts.items() if not any(map(str.isalnum, w))) / n,
        sum(k for w, k in counts.items() if len(w) > 1 and w.isupper()) / n,
        math.log1p(len(words) / max(len(lines), 1)), len(set(lines)) / max(len(lines), 1),
        math.log1p(len(words) / (1 + sum(map(text.count, ".!?")))), len(zlib.compress(raw, 1)) / max(len(raw), 1)]


@dataclass
class Model:
    """Bin edges and lookup tables; ``pairs`` holds (feature, feature, table by both coarse bins)."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def sums(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for i, j, table in self.pairs:
            total += table[bins[:, i] * PAIR_BINS // BINS, bins[:, j] * PAIR_BINS // BINS]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.sums(self.bins(x)))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _cuts(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of ordered cells: gain and first cell of the right side; gain 0 if none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= LEAST) & (hr >= LEAST), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), 0.0)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree of at most LEAVES boxes over a one- or two-dimensional table of gradient sums, and its gain."""
    def best(box):
        part = tuple(slice(a, b) for a, b in box)
        found = []
        for axis in range(g.ndim):
            rest = tuple(k for k in range(g.ndim) if k != axis)
            gain, at = _cuts(g[part].sum(rest), h[part].sum(rest))
            found.append((gain, axis, box[axis][0] + at))
        return max(found)

    boxes = [tuple((0, k) for k in g.shape)]
    total, open_ = 0.0, {boxes[0]: best(boxes[0])}
    while len(open_) < LEAVES:
        box, (gain, axis, at) = max(open_.items(), key=lambda x: x[1][0])
        if gain <= 0:
            break
        total += gain
        del open_[box]
        for side in ((box[axis][0], at), (at, box[axis][1])):
            new = box[:axis] + (side,) + box[axis + 1:]
            open_[new] = best(new)
    out = np.zeros(g.shape)
    for box in open_:
        part = tuple(slice(a, b) for a, b in box)
        out[part] = g[part].sum() / (h[part].sum() + SMOOTH)
    return out, total


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Tables from training rows (features, 0 or 1), in the order given."""
    n = len(y)
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) if n else np.zeros(0) for j in range(x.shape[1])]
    share = (y.sum() + 1.0) / (n + 2.0)
    model = Model(edges, math.log(share / (1 - share)), [np.zeros(BINS) for _ in edges], [])
    if not n or y.min() == y.max():
        return model
    bins = model.bins(x)
    train = np.arange(n) % ASIDE != ASIDE - 1 if n >= 10 * ASIDE else np.ones(n, bool)
    cells = [bins[:, j] for j in range(x.shape[1])]
    model.tables = _boost(model, bins, y, train, cells, [(BINS,)] * len(cells))
    coarse = bins * PAIR_BINS // BINS
    both = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i in range(x.shape[1]) for j in range(i)}
    p = logistic(model.sums(bins))
    gains = {ij: tree(*_sums(c[train], (y - p)[train], (p * (1 - p))[train], (PAIR_BINS, PAIR_BINS)))[1] for ij, c in both.items()}
    chosen = sorted((ij for ij in sorted(gains) if gains[ij] > 0), key=lambda ij: -gains[ij])[:PAIRS]
    tables = _boost(model, bins, y, train, [both[ij] for ij in chosen], [(PAIR_BINS, PAIR_BINS)] * len(chosen))
    model.pairs = [(i, j, t) for (i, j), t in zip(chosen, tables)]
    return model


def _sums(cell: np.ndarray, g: np.ndarray, h: np.ndarray, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    size = math.prod(shape)
    return np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)


def _boost(model: Model, bins: np.ndarray, y: np.ndarray, train: np.ndarray, cells: list[np.ndarray], shapes: list[tuple]):
    """Cyclic boosting of one table for each of ``cells``; the tables of the round with the least loss on rows set aside."""
    total = model.sums(bins)
    aside = ~train if (~train).any() else train
    tables = [np.zeros(math.prod(s)) for s in shapes]
    loss = lambda: float(np.logaddexp(0, np.where(y > 0, -total, total))[aside].mean())
    least, kept, since = loss(), [t.copy() for t in tables], 0
    for _ in range(ROUNDS):
        for k, (cell, shape) in enumerate(zip(cells, shapes)):
            p = logistic(total[train])
            step = RATE * tree(*_sums(cell[train], y[train] - p, p * (1 - p), shape))[0].ravel()
            tables[k] += step
            total += step[cell]
        now = loss()
        since = 0 if now < least else since + 1
        if now < least:
            least, kept = now, [t.copy() for t in tables]
        if since >= 20:
            break
    return [t.reshape(s) for t, s in zip(kept, shapes)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def features_of(text: Column) -> Column:
    """The FEATURES of a text column as an array."""
    @F.arrow_udf("array<double>")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([features(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return found(text)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out (at most SAMPLE)."""
    first = lambda df, *more: df.orderBy(F.xxhash64("doc_id"), "doc_id", *more).limit(SAMPLE)
    wanted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
              .where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.min("quality") > 0).alias("_y")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(first(wanted)), "doc_id").select(
        "doc_id", "_y", F.xxhash64("text").alias("_t"), features_of(F.col("text")).alias("_x"))
    got = first(rows, "_t").select("_x", "_y").collect()
    x = np.array([r["_x"] for r in got], np.float64).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["_y"] for r in got], np.float64))


def predict(text: Column, model: Model) -> Column:
    """The score of a text column."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = np.array([features(t) for t in texts.to_pylist()], np.float64).reshape(len(texts), len(FEATURES))
        return pa.array(model.score(found), pa.float64())

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from KEEP up) of every document."""
    model = learn(docs, labels)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        predict(F.col("text").cast("string"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= KEEP).cast("int"))
