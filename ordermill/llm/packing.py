"""Best-fit packing of token pieces into sequences by bin completion with branch and bound.

Pieces of one length are interchangeable, so the search runs on the histogram of lengths, which
has at most ``capacity`` entries however large the corpus is. Around the largest remaining length
it enumerates undominated fillings, takes one as often as the counts allow, and prunes branches
whose waste already rules out a better result than the best-fit incumbent. The chosen fillings are
then laid out over the pieces in Spark: a gapless rank of each piece among those of its length
names its sequence and offset.

Null and empty texts have the end id alone. Repeated rows are packed as often as they occur. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import key_bits, stored, with_rank
from ordermill.llm.tokens import encoder

#: Undominated fillings tried at a node, fillings generated to find them, and nodes of the whole
#: search: after these the incumbent stands (it is always a whole, valid packing).
BRANCHES, GENERATED, NODES = 6, 64, 8_000
RANK_PIECES = 1024
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Lengths:
    """A multiset of lengths with the sorted list of those that remain."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v}
        self.keys = sorted(self.count)

    def take(self, filling: Counter, times: int) -> None:
        for k, m in filling.items():
            self.count[k] -= m * times
            if not self.count[k]:
                del self.count[k]
                self.keys.pop(bisect_right(self.keys, k) - 1)

    def put(self, filling: Counter, times: int) -> None:
        for k, m in filling.items():
            if k not in self.count:
                self.count[k] = 0
                self.keys.insert(bisect_right(self.keys, k), k)
            self.count[k] += m * times

    def fit(self, room: int, below: int) -> int:
        """The largest remaining length of at most ``room`` among the first ``below`` keys; its place, or -1."""
        return min(bisect_right(self.keys, room), below) - 1


def fillings(left: Lengths, room: int) -> Iterator[Counter]:
    """Maximal fillings of ``room``, best fit first: each item is the largest that fits, then smaller ones."""
    def grow(room: int, below: int, used: Counter) -> Iterator[Counter]:
        at = left.fit(room, below)
        while at >= 0 and left.count[left.keys[at]] <= used[left.keys[at]]:
            at -= 1
        if at < 0:
            yield Counter({k: m for k, m in used.items() if m})
            return
        while at >= 0:
            k = left.keys[at]
            most = min(left.count[k] - used[k], room // k)
            if most > 0:
                used[k] += most
                yield from grow(room - most * k, at, used)
                used[k] -= most
            at -= 1

    yield from grow(room, len(left.keys), Counter())


def dominated(filling: Counter, left: Lengths, room: int) -> bool:
    """Whether one remaining item can stand in for some of the filling's items and leave them for later."""
    slack = room - sum(k * m for k, m in filling.items())
    items = sorted(filling.elements())[:6]                # subsets of the smallest items
    for bits in range(1, 1 << len(items)):
        chosen = [x for i, x in enumerate(items) if bits >> i & 1]
        size = sum(chosen)
        at = bisect_right(left.keys, size + slack) - 1
        while at >= 0 and left.keys[at] >= size:
            k = left.keys[at]
            if left.count[k] > filling[k] and (len(chosen) > 1 or k > size):
                return True
            at -= 1
    return False


def choices(left: Lengths, largest: int, capacity: int) -> list[tuple[Counter, int]]:
    """Undominated fillings around one item of the largest length, least waste first, with how often each fits."""
    own = Counter({largest: 1})
    left.take(own, 1)
    room, found, seen = capacity - largest, [], set()
    for i, f in enumerate(fillings(left, room)):
        key = tuple(sorted(f.items()))
        if key not in seen:
            seen.add(key)
            waste = room - sum(k * m for k, m in f.items())
            if not found or not dominated(f, left, room):
                found.append((waste, len(found), f))
        if i >= GENERATED or (found and found[-1][0] == 0 and len(found) >= BRANCHES):
            break
    left.put(own, 1)
    out = []
    for _, _, f in sorted(found, key=lambda x: x[:2])[:BRANCHES]:
        whole = f + own
        out.append((whole, min(left.count[k] // m for k, m in whole.items())))
    return out


def complete(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Fillings with how often each is used: as few bins in total as the search finds."""
    left, total = Lengths(counts), sum(k * v for k, v in counts.items())
    least = -(-total // capacity)
    best: list | None = None
    best_bins = sum(counts.values()) + 1
    path: list[tuple[Counter, int]] = []
    bins = packed = nodes = 0
    stack: list[Iterator] = []

    def enter() -> None:
        stack.append(iter(choices(left, left.keys[-1], capacity)))

    if not left.keys:
        return []
    enter()
    while stack:
        if best is not None and (best_bins <= least or nodes >= NODES):
            break
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                filling, times = path.pop()
                left.put(filling, times)
                bins, packed = bins - times, packed - times * sum(k * m for k, m in filling.items())
            continue
        nodes += 1
        filling, times = step
        size = sum(k * m for k, m in filling.items())
        after = bins + times + -(-(total - packed - times * size) // capacity)
        if best is not None and after >= best_bins:       # this waste can't lead below the incumbent
            continue
        left.take(filling, times)
        path.append(step)
        bins, packed = bins + times, packed + times * size
        if left.keys:
            enter()
        else:
            if bins < best_bins:
                best, best_bins = list(path), bins
            path.pop()
            left.put(filling, times)
            bins, packed = bins - times, packed - times * size
    return best or []


def layout(plan: list[tuple[Counter, int]]) -> list[np.ndarray]:
    """Where ranks of a length lie: arrays of length, first rank, copies per sequence, first sequence, offset."""
    rows, used, base = [], Counter(), 0
    for filling, times in plan:
        offset = 0
        for k in sorted(filling, reverse=True):
            rows.append((k, used[k], filling[k], base, offset))
            used[k] += filling[k] * times
            offset += filling[k] * k
        base += times
    rows.sort()
    return [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5


def pack(pieces: DataFrame, capacity: int, key: list[str]) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces with a ``length`` of 1 to ``capacity``.

    ``key`` columns order pieces of one length. One row per length reaches the driver; what goes
    back is at most one entry per length and filling (distinct lengths of a filling add up to at
    most the capacity, so at most 64 for 2048 tokens).
    """
    pieces = pieces.drop("sequence_id", "offset")
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("piece lengths must be 1 to capacity")
    length, first, copies, base, offset = layout(complete(counts, capacity))
    place = length << np.int64(44) | first

    @F.pandas_udf("sequence_id long, offset long")
    def lay(n: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, rank = n.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(place, n << np.int64(44) | rank, "right") - 1
        nth = rank - first[at]
        return pd.DataFrame({"sequence_id": base[at] + nth // copies[at], "offset": offset[at] + nth % copies[at] * n})

    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in key])
    ranked = with_rank(pieces, ["length"], (key_bits(text) % RANK_PIECES).cast("int"), [F.col(k) for k in key], "_rank")
    return ranked.withColumn("_at", lay("length", "_rank")).select(*pieces.columns, "_at.sequence_id", "_at.offset")


def cut(docs: DataFrame, capacity: int, vocabulary: str | None, end_id: int = 0) -> DataFrame:
    """Token pieces of whole texts: doc_id, piece, start, length, ids_crc32 (no ids leave the task)."""
    def run(batches):
        own = encoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 512):
                rows = []
                for doc_id, found in zip(ids[at:at + 512], own.encode(texts[at:at + 512])):
                    whole = np.append(found, end_id).astype("<u4")
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        part = whole[start:start + capacity]
                        rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` tokens as the search finds; one row per piece."""
    pieces = stored(cut(docs, capacity, vocabulary), "pieces")
    return pack(pieces, capacity, ["doc_id", "piece", "ids_crc32"])
