"""Token ids of whole texts by the tokenizers library, and how a task reaches them.

The vocabulary lower-cases, drops white space and never joins tokens across it or from letters to
marks, so a text's ids are the ids of its pieces in order. Texts are cut into pieces by their bytes, Arrow
numbers them; each different piece is encoded by the library once and remembered (a bounded memo in two
generations), because prose repeats its words.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

#: Characters of texts cut at a time (at least one text); pieces remembered per worker in one of two generations (about 150 bytes each).
CHARACTERS_ABREAST, MEMO_PIECES = 1 << 23, 500_000
#: New words that the library gets at a time: its cutting costs more per word in longer texts.
WORDS_ABREAST = 64
#: Fixed value: a control character that the vocabulary encodes as one id of its own between spaces.
MARK = "\x01"
#: Words of lower-case Latin letters, whose characters are their own composed form.
LOW_WORD = re.compile("[" + "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.islower()) + "]+").fullmatch
#: Byte-level vocabularies spell bytes that are printable in Latin-1 as themselves, the others from 256 on.
BYTE_CHARACTERS = [chr(b) for b in range(256)]
for _n, _b in enumerate([*range(33), *range(127, 161), 173]):
    BYTE_CHARACTERS[_b] = chr(256 + _n)
#: The same as code units; a space stays between words.
SPELLING = np.array([ord(c) for c in BYTE_CHARACTERS], "<u2")
SPELLING[32] = 32
#: Between a letter and a mark of ASCII (apostrophes begin endings): there the vocabulary cuts anyway, and a mark after another stays with it.
BEHIND = re.compile(r"(?<=[^\W\d_])(?=[!-&(-/:-@\[-`{-~])")
#: The same by bytes: white ones, letters of ASCII, marks that are cut from them, bytes of wider characters, all others.
WHITE, LETTER, CUT, WIDE, OTHER = range(5)
KINDS = bytes(WIDE if n > 127 else WHITE if n in (10, 32) else LETTER if chr(n).isalpha() else
              CUT if 32 < n < 127 and n != 39 and not chr(n).isdigit() else OTHER for n in range(256))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Memo:
    """Numbers of words, and their ids one word after another."""

    def __init__(self, kind: np.dtype):
        self.numbers: dict[str, int] = {}
        self.ids, self.begins = np.zeros(1024, kind), np.zeros(1024, np.int64)
        self.count = self.used = 0

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        count, used = self.count + len(words), self.used + len(ids)
        if used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(used, self.ids.dtype)))
        if count >= len(self.begins):
            self.begins = np.concatenate((self.begins, np.zeros(count, np.int64)))
        self.ids[self.used:used] = ids
        self.begins[self.count + 1:count + 1] = self.used + np.cumsum(sizes)
        self.numbers.update(zip(words, range(self.count, count), strict=True))
        self.count, self.used = count, used

    def find(self, words: list[str]) -> np.ndarray:
        """Their numbers, -1 for words that are not here."""
        return np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))

    def spans(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = self.begins[numbers]
        return begins, self.begins[numbers + 1] - begins

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words one after another, and how many each has."""
        begins, sizes = self.spans(numbers)
        return self.ids[ranges(begins, sizes)], sizes


def wide_letters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters of two bytes or more that end at these places are letters."""
    if not len(at):
        return np.zeros(0, bool)
    code, back = data[at].astype(np.int32) & 63, 1
    more = np.arange(len(at))                              # those whose first byte is further before
    while len(more):
        byte = data[at[more] - back].astype(np.int32)
        first = byte >= 192
        code[more] += np.where(first, byte & (63 >> back), byte & 63) << 6 * back
        more, back = more[~first], back + 1
    codes = np.unique(code)
    letter = [unicodedata.ucd_3_2_0.category(chr(c)).startswith("L") for c in codes.tolist()]      # the oldest list: all vocabularies know its letters
    return np.array(letter)[np.searchsorted(codes, code)]


def pieces(texts: list[str], plain: list[bool]) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts without line ends, cut at spaces and in plain ones from letters to marks; the pieces before each text and in all."""
    whole = "\n".join(texts).encode()
    data, kind = np.frombuffer(whole, np.uint8), np.frombuffer(whole.translate(KINDS), np.uint8)
    ink = kind != WHITE
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    cut = kind[1:] == CUT
    letter = cut & (kind[:-1] == LETTER)
    wide = np.flatnonzero(cut & (kind[:-1] == WIDE))
    letter[wide] = wide_letters(data, wide)
    lines = np.flatnonzero(data == 10)
    if not all(plain):
        letter &= np.repeat(plain, np.diff(lines, prepend=-1, append=len(data)))[1:len(data)]
    begins[1:] |= letter
    ends = ink                                             # from here on: where a piece has its last byte
    ends[:-1] &= begins[1:] | ~ink[1:]
    begins, body = np.flatnonzero(begins), whole.translate(None, b" \n")
    offsets = np.zeros(len(begins) + 1, np.int32 if len(body) < 1 << 31 else np.int64)
    np.cumsum(np.flatnonzero(ends) + 1 - begins, out=offsets[1:])
    found = pa.StringArray if offsets.dtype == np.int32 else pa.LargeStringArray
    found = found.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(body))
    return found, np.concatenate(([0], np.searchsorted(begins, lines), [len(begins)]))


class Encoder:
    """``encode(texts)`` gives one little-endian array of ids per text; null is the empty text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.bare = Tokenizer(self.library.model)          # for words that are cut, in lower case and spelled already
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.memo, self.last = Memo(self.kind), Memo(self.kind)
        self.mark = self._ids([MARK])[0]
        self.added = sorted({t.content.lower() for t in self.library.get_added_tokens_decoder().values()})
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _low(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the vocabulary's cutting and lower case would leave as they are, and how many each has."""
        text = " ".join(words)
        if not text.isascii():
            text = SPELLING[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(words):
            return ids, np.diff(ends, prepend=0)
        found = [[t.id for t in self.library.model.tokenize(p)] for p in text.split(" ")]      # a vocabulary that does not mark the ends of words
        return np.fromiter(chain.from_iterable(found), self.kind), np.fromiter(map(len, found), np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces many at a time: words by their end-of-word ids, others between marks."""
        low = list(filter(LOW_WORD, pieces))
        if low:
            found = [self._low(low[at:at + WORDS_ABREAST]) for at in range(0, len(low), WORDS_ABREAST)]
            self.memo.add(low, *map(np.concatenate, zip(*found)))
        rest = [p for p in pieces if not LOW_WORD(p)] if len(low) < len(pieces) else []
        words = [p for p in rest if p.isalpha()]
        others = [p for p in rest if not p.isalpha()]
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            ids = np.array(self._ids([" ".join(part)])[0], self.kind)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part):
                self.memo.add(part, ids, np.diff(ends, prepend=0))
            else:                                          # lower case made something else of a letter
                others += part
        plain = [p for p in others if MARK not in p] if len(self.mark) == 1 else []
        alone = [p for p in others if MARK in p] if len(self.mark) == 1 else others
        for at in range(0, len(plain), 4096):
            part = plain[at:at + 4096]
            ids = np.array(self._ids([f" {MARK} ".join(part)])[0], self.kind)
            marks = ids == self.mark[0]
            self.memo.add(part, ids[~marks], np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1)
        for p, ids in zip(alone, self._ids(alone) if alone else []):
            self.memo.add([p], np.array(ids, self.kind), np.array([len(ids)]))

    def _plain(self, low: str, text: str) -> bool:
        """Whether ``text`` may be lower-cased, and cut between letters and marks, without a change of its ids."""
        # only where a letter stays one letter, so that no accent of its own joins the marks
        if len(low) != len(text) or "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
            return False
        # added tokens are found in the text as it is: other cases of one are plain text
        return not any(t in low for t in self.added)

    def _spaced(self, text: str | None) -> tuple[str, bool]:
        """A text with the same ids whose pieces stand between spaces, and whether it could be put in lower case."""
        text = (text or "").replace("\n", " ")
        low = text.lower()
        return (low, True) if self._plain(low, text) else (text, False)

    def _parts(self, piece: str) -> list[str]:
        """A piece cut where its marks follow letters."""
        parts = BEHIND.sub(" ", piece).split(" ")
        return parts if len(parts) == 1 or self._plain(piece.lower(), piece) else [piece]

    def _encoded(self, missing: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the memo lacks, and how many each has; it holds them, or the parts of those not cut yet, from now on."""
        cut = [] if plain else [[p] if p.isalpha() else self._parts(p) for p in missing]
        parts = list(chain.from_iterable(cut)) if cut else missing
        wanted = list(dict.fromkeys(parts)) if cut else missing
        fresh = [p for p in wanted if p not in self.memo.numbers] if cut else wanted
        if self.memo.count + len(fresh) > MEMO_PIECES:
            self.memo, self.last, fresh = Memo(self.kind), self.memo, wanted
        if self.last.count:
            numbers = self.last.find(fresh)
            known = numbers >= 0
            self.memo.add([p for p, k in zip(fresh, known.tolist()) if k], *self.last.of(numbers[known]))
            fresh = [p for p, k in zip(fresh, known.tolist()) if not k]
        self._learn(fresh)
        ids, sizes = self.memo.of(self.memo.find(parts))
        if cut:
            counts = np.fromiter(map(len, cut), np.int64, len(cut))
            sizes = np.add.reduceat(sizes, np.cumsum(counts) - counts)
        return ids, sizes

    def _batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        part, plain = zip(*map(self._spaced, texts))
        found, bounds = pieces(part, plain)
        numbered = found.dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        memo, held = self.memo, self.memo.ids[:self.memo.used]
        numbers = memo.find(words)
        starts, sizes = memo.spans(numbers)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            more, sizes[missing] = self._encoded(list(map(words.__getitem__, missing.tolist())), all(plain))
            starts[missing] = len(held) + np.cumsum(sizes[missing]) - sizes[missing]
            held = np.concatenate((held, more))
        which = numbered.indices.to_numpy()
        sizes = sizes[which]
        whole = held[ranges(starts[which], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[bounds].tolist()
        return (whole[a:b] for a, b in zip(ends[:-1], ends[1:]))

    def encoded(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, some texts at a time."""
        at = held = 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= CHARACTERS_ABREAST or i == len(texts) - 1:
                yield from self._batch(texts[at:i + 1])
                at, held = i + 1, 0

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return list(self.encoded(texts))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the runs, one after another."""
    ends = np.cumsum(sizes)
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file (default: where this worker has it); kept for the worker's life."""
    path = path or default_vocabulary()
    kept = sys.modules.setdefault("_llm_worker_kept", types.ModuleType("_llm_worker_kept"))
    found = kept.__dict__.setdefault("encoders", {})
    if path not in found:
        found[path] = Encoder(path)
    return found[path]
