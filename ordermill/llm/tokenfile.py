"""Token files compressed by Re-Pair: frequent id pairs become nonterminals of a grammar per block.

A block holds the ids of whole documents in key order. The places of every pair inside documents are
listed once; in rounds, the most frequent pairs (down to an eighth of the best) are replaced by new symbols,
where two of them overlap the more frequent one first. Only pairs next to a replacement change, and all
pairs that arise hold a new symbol, so a round costs what it replaces. Rounds go on until no pair
inside documents occurs twice without overlap. A block stores its rules, the expansion length of each
rule and the symbol at which each document ends, so any document decodes alone from its own symbols.

Payload layout, little-endian: 4 bytes ``RPR2``; unsigned 32-bit terminals, rules, documents,
symbols and bytes of a symbol (2, 3 or 4); left and right symbols of the rules; unsigned 32-bit
expansion lengths of the rules; unsigned 32-bit end symbol of each document; the symbols. Symbols are
stored by byte: the lowest bytes of all, then the next ones, so that general compression finds them alike.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.tokens import encoder, ranges

#: Occurrences that a pair needs, ids after which a block ends, bits of a symbol in a pair's key.
LEAST, BLOCK_IDS, SYMBOL_BITS = 2, 1 << 17, 24
#: A round replaces pairs down to this part of the best one's occurrences: fewer rounds than with 2, for payloads 1.2 % longer.
ROUND_PART = 8
MAGIC = b"RPR2"
FILE_SCHEMA = "part int, block int, doc_ids array<long>, n_tokens long, payload binary"
READ_SCHEMA = "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal keys."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))


class Sequence:
    """A block's symbols as a linked list, with the places of every pair that occurs LEAST times."""

    def __init__(self, ids: np.ndarray, last: np.ndarray):
        n = len(ids)
        kind = np.int32 if n < 1 << 29 else np.int64       # small numbers keep a block in the processor's cache
        self.symbol = ids.astype(np.int32)
        # places are whole machine words, as numpy copies every other index; -1: none in this document
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.after[last] = -1
        self.before[np.append(0, np.flatnonzero(last)[:-1] + 1)] = -1
        self.alive = np.ones(n, bool)
        self.pair = np.full(n, -1, kind)                  # number of the pair that begins at each place
        self.mark = np.zeros(n + 1, kind)                 # scratch by place; what it holds for place -1 stays 0
        self.places, self.used = np.empty(3 * n + 1, np.intp), 0
        # of each pair: symbols, occurrences now, and its places when it arose; filled up to the number of pairs
        room = len(self.places) // LEAST
        self.left, self.right, self.count, self.begin, self.size = (np.empty(room, np.int64) for _ in range(5))
        self.pairs, self.live = 0, np.zeros(0, np.int64)
        self.enter(np.flatnonzero(self.after >= 0))

    def enter(self, at: np.ndarray) -> None:
        """Number the pairs that begin at these places and occur LEAST times; none of them is known yet."""
        key = self.symbol.take(at).astype(np.int64)
        key <<= SYMBOL_BITS
        key |= self.symbol.take(self.after.take(at))
        bits = len(self.symbol).bit_length()
        if len(key) and int(key.max()).bit_length() + bits <= 63:      # one sort of numbers that hold key and place
            key <<= bits
            key |= at
            key.sort()
            both, key = key, key >> bits
            again = key[1:] == key[:-1]
            keep = np.append(again, False)
            keep[1:] |= again                              # most pairs that arise late occur once
            both = both.compress(keep)
            key, at = both >> bits, both & ((1 << bits) - 1)
        else:
            order = np.argsort(key)
            key, at = key[order], at[order]
        if not len(key):
            return
        first, times = _runs(key)
        if int(times.min()) < LEAST:
            often = times >= LEAST
            keep = np.repeat(often, times)
            at, key, times = at.compress(keep), key[first.compress(often)], times.compress(often)
        else:
            key = key[first]
        new = slice(self.pairs, self.pairs + len(key))
        numbers = np.arange(new.start, new.stop)
        self.pair[at] = np.repeat(numbers, times)
        self.places[self.used:self.used + len(at)] = at
        self.left[new], self.right[new] = key >> SYMBOL_BITS, key & ((1 << SYMBOL_BITS) - 1)
        self.count[new] = self.size[new] = times
        self.begin[new] = np.cumsum(times) - times + self.used
        self.live = np.concatenate((self.live, numbers))
        self.pairs, self.used = new.stop, self.used + len(at)

    def chosen(self) -> np.ndarray:
        """The most frequent pairs, down to a part of the best, most frequent first."""
        count = self.count[self.live]
        still = count >= LEAST
        if 2 * np.count_nonzero(still) < len(count):       # those that are gone are dropped when they are many
            self.live, count = self.live.compress(still), count.compress(still)
        best = int(count.max(initial=0))
        if best < LEAST:
            return count[:0]
        often = np.flatnonzero(count >= max(LEAST, best // ROUND_PART))
        # one sort of numbers that hold how far a pair is behind the best, and its place in the list
        bits = len(count).bit_length()
        return self.live[np.sort((best - count[often]) << bits | often) & ((1 << bits) - 1)]

    def free_places(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where these pairs can be replaced together, and the pair of each by its position in ``pairs``."""
        size = self.size[pairs]
        at = self.places.take(ranges(self.begin[pairs], size))
        own = np.repeat(np.arange(len(pairs)), size)
        still = self.pair.take(at) == np.repeat(pairs, size)
        at, own = at.compress(still), own.compress(still)
        self.mark[at] = len(pairs) - own
        alike = self.left[pairs] == self.right[pairs]
        if alike.any() and len(twins := np.sort(at.compress(alike[own]))):          # in a run of one symbol, every second place
            runs = np.concatenate(([True], self.after[twins[:-1]] != twins[1:]))
            nth = np.arange(len(twins))
            self.mark[twins[(nth - np.maximum.accumulate(np.where(runs, nth, 0))) % 2 == 1]] = 0
        mine = self.mark.take(at)
        wins = mine > self.mark.take(self.before.take(at))
        wins &= mine > self.mark.take(self.after.take(at))
        self.mark[at] = 0
        at, own = at.compress(wins), own.compress(wins)
        often = np.bincount(own, minlength=len(pairs)) >= LEAST
        if len(pairs) and not often[0]:                    # the best pair loses to none: it only overlaps itself
            self.count[pairs[0]] = 0
        wins = often[own]
        return at.compress(wins), own.compress(wins)

    def replace(self, at: np.ndarray, symbols: np.ndarray, top: int) -> None:
        """Put one symbol (``top`` or more, not in use yet) for the pair at each of these places."""
        gone, prior = self.after[at], self.before[at]
        self.alive[gone] = False
        prior = prior.compress(prior >= 0)
        prior = prior.compress(self.alive[prior])          # else it is the second of a pair beside, and counted there
        hit = np.concatenate((at, gone, prior))
        ended = self.pair[hit]
        ended = ended.compress(ended >= 0)
        if len(ended):
            self.count[:int(ended.max()) + 1] -= np.bincount(ended)
        self.pair[hit] = -1
        self.symbol[at] = symbols
        following = self.after[gone]
        self.after[at] = following
        more = following >= 0
        led = at.compress(more)
        self.before[following.compress(more)] = led
        prior = self.before[at]
        prior = prior.compress(prior >= 0)
        self.enter(np.concatenate((led, prior.compress(self.symbol[prior] < top))))      # a new symbol is among the places anyway


def compress(seq: np.ndarray, last: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their end-of-document marks and the rules (n, 2) of a block's ids."""
    state, rules, top = Sequence(seq, last), [np.zeros(0, np.int64)], terminals
    while len(pairs := state.chosen()):
        at, own = state.free_places(pairs)
        if len(at):
            taken = np.bincount(own) > 0
            rules.append(pairs.compress(taken))
            state.replace(at, (np.cumsum(taken) + (top - 1)).take(own), top)
            top += len(rules[-1])
    used, left = np.concatenate(rules), np.flatnonzero(state.alive)
    return state.symbol.take(left), state.after.take(left) < 0, np.stack([state.left.take(used), state.right.take(used)], 1)


def steps(rules: np.ndarray, terminals: int) -> Iterator[slice]:
    """Rules in runs that refer only to rules of the runs before."""
    latest = np.maximum.accumulate(rules.max(1)) - terminals if len(rules) else rules
    at = 0
    while at < len(rules):
        end = int(np.searchsorted(latest, at))
        yield slice(at, end)
        at = end


def lengths_of(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Expansion length of each rule; a rule refers only to earlier ones."""
    out = np.ones(len(rules) + 1, np.int64)                # the first one stands for every terminal
    side = np.maximum(rules.astype(np.int64) - (terminals - 1), 0)
    for run in steps(rules, terminals):
        out[run.start + 1:run.stop + 1] = out[side[run, 0]] + out[side[run, 1]]
    return out[1:]


def planes(symbols: np.ndarray, width: int) -> bytes:
    """Symbols by byte, the lowest first."""
    return b"".join((symbols >> 8 * k).astype(np.uint8).tobytes() for k in range(width))


def dump(docs: list[np.ndarray], terminals: int) -> bytes:
    """The payload of a block of documents (each with at least one id)."""
    sizes = np.array([len(d) for d in docs])
    last = np.zeros(sizes.sum(), bool)
    last[np.cumsum(sizes) - 1] = True
    seq, last, rules = compress(np.concatenate(docs), last, terminals)
    width = next(w for w in (2, 3, 4) if terminals + len(rules) <= 1 << 8 * w)
    head = struct.pack("<4s5I", MAGIC, terminals, len(rules), len(docs), len(seq), width)
    ends = (np.flatnonzero(last) + 1).astype("<u4")
    return b"".join([head, planes(rules[:, 0], width), planes(rules[:, 1], width), lengths_of(rules, terminals).astype("<u4").tobytes(),
                     ends.tobytes(), planes(seq, width)])


class Block:
    """A payload read back: ``all()`` gives every id, ``doc(i)`` one document's ids from its own symbols."""

    def __init__(self, payload: bytes):
        magic, self.terminals, n_rules, self.docs, n, w = struct.unpack_from("<4s5I", payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = 24

        def read(count: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        def symbols(count: int) -> np.ndarray:
            out = np.zeros(count, np.int64)
            for k in range(w):
                out |= read(count, np.uint8).astype(np.int64) << 8 * k
            return out

        self.rules = np.stack([symbols(n_rules), symbols(n_rules)], 1)
        self.sizes = np.concatenate([np.ones(self.terminals, np.int64), read(n_rules, "<u4").astype(np.int64)])
        self.ends = read(self.docs, "<u4").astype(np.int64)
        self.symbols = symbols(n)
        self._flat: np.ndarray | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All expansions one after another, and where each symbol's begins; built by runs of rules."""
        if self._flat is None:
            begin = np.cumsum(self.sizes) - self.sizes
            flat = np.zeros(self.sizes.sum(), "<u4")
            flat[:self.terminals] = np.arange(self.terminals)
            for run in steps(self.rules, self.terminals):
                sides = self.rules[run].ravel()
                size = self.sizes[sides]
                at = begin[run.start + self.terminals]
                flat[at:at + size.sum()] = flat[ranges(begin[sides], size)]
            self._flat, self._begin = flat, begin
        return self._flat, self._begin

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._expansions()
        return flat[ranges(begin[symbols], self.sizes[symbols])]

    def doc(self, i: int) -> np.ndarray:
        return self._expand(self.symbols[self.ends[i - 1] if i else 0:self.ends[i]])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Every id, and the id at which each document ends."""
        return self._expand(self.symbols), np.cumsum(self.sizes[self.symbols])[self.ends - 1]


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2) -> None:
    """Write the ids of whole texts (null: empty), each with the end id, in ascending doc_id order.

    Ranges of doc_id become numbered parts, blocks are numbered inside their part, and Spark's
    committer publishes them, so a lost task writes its part again. Repeated doc_ids stand next
    to each other; a null doc_id comes first. An empty table writes no block.
    """
    def run(batches):
        own = encoder(vocabulary)
        terminals = own.library.get_vocab_size()
        part, block, keys, held, size = TaskContext.get().partitionId(), 0, [], [], 0
        end = np.array([end_id], own.kind)

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([size], pa.int64()), pa.array([dump(held, terminals)], pa.binary())],
                ["part", "block", "doc_ids", "n_tokens", "payload"])

        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), own.encoded(batch.column(1).to_pylist())):
                keys.append(key)
                held.append(np.concatenate([found, end]))
                size += len(found) + 1
                if size >= BLOCK_IDS:
                    yield flush()
                    block, keys, held, size = block + 1, [], [], 0
        if keys:
            yield flush()

    tie = F.xxhash64("text")
    (docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
     .mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32 of its decoded ids."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, ends = Block(row["payload"]).all()
                ids, ends = ids.astype("<u4"), ends.tolist()
                starts = [0, *ends[:-1]]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                     pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                     pa.array([zlib.crc32(ids[s:e]) for s, e in zip(starts, ends)], pa.int64())],
                    ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = (files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("base")))
    blocks = (files.select("part", "block", F.coalesce(F.sum("n_tokens").over(
        before(Window.partitionBy("part").orderBy("block"))), F.lit(0)).alias("inner"))
        .join(parts, "part").select("part", "block", (F.col("base") + F.col("inner")).alias("base")))
    return (files.mapInArrow(run, READ_SCHEMA).join(blocks, ["part", "block"])
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))
