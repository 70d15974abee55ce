"""Language identification by rank-order profiles (Cavnar and Trenkle).

A text's letters are lower-cased, every other character is a word break, and its most frequent
n-grams of one to three characters (words padded by a break) are ranked. A language's profile is
the ranked n-grams of all its training texts. The distance sums how far each n-gram of the text is
out of its place; an n-gram that the profile lacks counts as ``PROFILE`` places.

A text that is null or has no letter is ``und`` with score 0. Rows without a language don't train.
Equal counts rank by the n-gram's code, equal distances go to the first language in text order. An
empty table gives an empty result; without training rows every text is ``und``. Any number of
languages is learned; profiles go to the tasks in blocks of about ``LANGUAGES``.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored, whole_row

#: N-grams of a profile.
PROFILE = 300
#: Texts counted at a time.
TEXTS_ABREAST = 256
#: Languages of a block of profiles.
LANGUAGES = 1000
#: A text is like no learned language if its score is below MARGIN of the score that all but one in RARE training rows reach.
RARE, MARGIN, STEPS = 100, 0.65, 1000


def letters() -> np.ndarray:
    """Whether each code point is a letter; kept for the life of the worker."""
    kept = sys.modules.setdefault("_llm_worker_kept", types.ModuleType("_llm_worker_kept"))
    if not hasattr(kept, "letters"):
        kept.letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return kept.letters


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes (21 bits a character) and counts of a text's n-grams, in code order; empty without letters."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[code]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.concatenate(([32], np.where(is_letter, code, 32), [32])).astype(np.int64)
    code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
    inner = code != 32
    two = code[:-1] << 21 | code[1:]
    three = (two[:-1] << 21 | code[2:])[inner[1:-1]]       # no n-gram spans a break
    return np.unique(np.concatenate((code[inner], two, three)), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent codes, most frequent first."""
    if len(codes) > PROFILE:
        often = counts >= np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        codes, counts = codes[often], counts[often]
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


def learn(docs: DataFrame, lang: str = "lang") -> list[dict[str, list[int]]]:
    """Blocks of ranked n-gram codes by language, from every row with a language; PROFILE codes a language at most."""
    def count(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            for at in range(0, len(texts), TEXTS_ABREAST):     # few texts' n-grams at a time
                by: dict[str, list] = {}
                for name, text in zip(langs[at:at + TEXTS_ABREAST], texts[at:at + TEXTS_ABREAST]):
                    by.setdefault(name, [known[name]] if name in known else []).append(grams(text))
                for name, found in by.items():
                    code, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                    known[name] = code, np.bincount(place, np.concatenate([k for _, k in found]), len(code)).astype(np.int64)
            for name, (code, n) in known.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array(code), pa.array(n)],
                                                 ["lang", "code", "n"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), "text")
    total = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = total.withColumn("place", F.row_number().over(place)).where(F.col("place") <= PROFILE)
    top = stored(top.select("lang", "place", "code"), "profiles")
    blocks = -(-top.select("lang").distinct().count() // LANGUAGES)
    out = []
    for k in range(blocks):
        found: dict[str, list[int]] = {}
        for r in top.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k).orderBy("lang", "place").toLocalIterator():
            found.setdefault(r["lang"], []).append(r["code"])
        out.append(found)
    return out


def nearest(text: Column, profiles: dict[str, list[int]]) -> Column:
    """A struct of the distance (0 to 1) to the nearest of these profiles and its language; nulls without letters."""
    names = sorted(profiles)
    tables = []
    for name in names:
        codes = np.array(profiles[name], np.int64)
        order = np.argsort(codes)
        tables.append((codes[order], order))

    @F.arrow_udf("struct<away:double,lang:string>")
    def guess(texts: pa.Array) -> pa.Array:
        langs, distances = [], []
        for text in texts.to_pylist():
            own = ranked(*grams(text))
            best, least = None, None
            for name, (codes, place) in zip(names, tables):
                if len(own) and len(codes):
                    at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                    off = np.where(codes[at] == own, np.minimum(np.abs(place[at] - np.arange(len(own))), PROFILE), PROFILE)
                    away = float(off.sum() / (PROFILE * len(own)))
                    if least is None or away < least:
                        best, least = name, away
            langs.append(best)
            distances.append(least)
        return pa.StructArray.from_arrays([pa.array(distances, pa.float64()), pa.array(langs, pa.string())], ["away", "lang"])

    return guess(text)


def predict(text: Column, profiles: list[dict[str, list[int]]]) -> Column:
    """A struct of lang_pred and score (1: every n-gram in its place, 0: none known) for a text column."""
    best = F.array_min(F.filter(F.array(*[nearest(text, p) for p in profiles]), lambda x: x["lang"].isNotNull())) if profiles \
        else F.lit(None).cast("struct<away:double,lang:string>")
    return F.struct(F.coalesce(best["lang"], F.lit("und")).alias("lang_pred"),
                    F.when(best["lang"].isNull(), 0.0).otherwise(1.0 - best["away"]).alias("score"))


def least_score(scored: DataFrame) -> float:
    """The score below which a text is like no learned language, from the training rows (lang, found) that are taken for their own."""
    own = scored.where(F.col("found.lang_pred") == F.col("lang")).select(F.floor(F.col("found.score") * STEPS).cast("int").alias("step"))
    counts = sorted(tuple(r) for r in own.groupBy("step").count().collect())           # STEPS + 1 rows at most
    rows, below = sum(n for _, n in counts), 0
    for step, n in counts:
        below += n
        if below * RARE > rows:
            return MARGIN * step / STEPS
    return 0.0


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    profiles = learn(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), profiles).alias("_p"))
    return found.select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are in a learned language: not ``und`` and not below ``least_score``."""
    training = ~held_out(F.col("doc_id"))
    profiles = learn(docs.where(training))
    # every text is scored once; the documents travel as one column, so that no name of theirs meets "found"
    scored = stored(docs.select(predict(F.col("text"), profiles).alias("found"), training.alias("training"),
                                F.col("lang").cast("string").alias("lang"), whole_row(docs)), "scored")
    least = least_score(scored.where("training"))
    return scored.where((F.col("found.lang_pred") != "und") & (F.col("found.score") >= least)).select("row.*")
