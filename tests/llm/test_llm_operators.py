"""Operators against brute-force versions and on the awkward inputs their docstrings name."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ordermill.llm import bagminhash, langid, mixing, packing, preference, sharding, tokenfile, vectors, warc, winnowing
from ordermill.llm.common import components, neighbours
from ordermill.llm.tokens import Encoder, default_vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_vocabulary())


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def docs(spark, texts, start=0):
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, DOCS)


# -- helpers ------------------------------------------------------------------------

def test_neighbours_wrap_around(spark):
    ids = [5, 1, 9, 100, 42]
    got = {r["k"]: (r["lower"], r["higher"]) for r in
           neighbours(spark.createDataFrame([(i,) for i in ids], "k long"), "k").collect()}
    order = sorted(ids)
    assert got == {k: (order[i - 1], order[(i + 1) % len(order)]) for i, k in enumerate(order)}
    one = neighbours(spark.createDataFrame([(7,)], "k long"), "k").first()
    assert (one["lower"], one["higher"]) == (7, 7)
    assert neighbours(spark.createDataFrame([], "k long"), "k").count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 130)}}


# -- sharding -------------------------------------------------------------------------

def jump_reference(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop_and_moves_little():
    keys = np.random.default_rng(1).integers(0, 1 << 60, 5000)
    for shards in (1, 2, 16, 17, 100):
        assert sharding.jump(keys, shards).tolist() == [jump_reference(int(k), shards) for k in keys]
    before, after = sharding.jump(keys, 16), sharding.jump(keys, 17)
    assert set(after[before != after]) == {16} and 0.03 < (before != after).mean() < 0.09


def test_shards_of_awkward_documents(spark):
    df = docs(spark, ["a", None, "", "é", "a", "x" * 5000]).unionAll(docs(spark, ["a", "a"], 0)).withColumn("slot", F.lit(9))
    df = df.unionAll(spark.createDataFrame([(None, "n", None, None, None, 9)], df.schema))
    rows = sharding.document_shards(df, 16).collect()
    assert len(rows) == 9
    assert sorted((r["doc_id"], r["size"]) for r in rows if r["doc_id"] in (1, 2, 3)) == [(1, 1), (1, 2), (2, 1), (3, 3)]
    assert all(r["text_crc32"] == zlib.crc32("é".encode()) for r in rows if r["doc_id"] == 3)
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r["shard"], r["slot"])), lambda r: r["shard"]):
        own = [r["slot"] for r in own]
        assert own == list(range(len(own)))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    assert sharding.document_shards(df.limit(0), 16).count() == 0
    with pytest.raises(ValueError):
        sharding.jump_shard(F.col("doc_id"), 0)


# -- BagMinHash -------------------------------------------------------------------------

def bag(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def likeness(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def brute_classes(rows):
    """Classes of (id, text) rows by exact likeness, over all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [(i, t, bag(t)) for i, t in rows if t is not None]
    for (i, t, a), (j, u, b) in itertools.combinations(bags, 2):
        if t == u or likeness(a, b) >= 0.8:
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in rows}


def test_signatures_estimate_weighted_likeness_without_bias():
    draw = random.Random(3)
    for _ in range(3):
        a = {i: draw.choice([1, 1, 2, 3, 5, 8]) for i in range(30)}
        b = {i: c if draw.random() < .8 else draw.choice([1, 2, 4, 7]) for i, c in a.items()} | {99: 3}
        want = likeness(collections.Counter(a), collections.Counter(b))
        hits = []
        for trial in range(40):
            sides = [(bagminhash.mixed(np.array([k * 1000003 + trial * 7919 for k in d], np.uint64)), np.array(list(d.values())))
                     for d in (a, b)]
            one, two = bagminhash.signatures(sides)
            hits.append((one == two).mean())
        assert abs(np.mean(hits) - want) < 0.025


def test_signatures_do_not_depend_on_the_batch():
    texts = ["a b c d e f g", "one two", "x " * 500, "", None, "p q r s t u v w"]
    found = [bagminhash.shingles(t) for t in texts]
    alone = np.concatenate([bagminhash.signatures([f]) for f in found])
    assert (alone == bagminhash.signatures(found)).all()
    assert bagminhash.signatures([]).shape == (0, bagminhash.REGISTERS)


def test_shingles_and_overlap_are_exact(small):
    texts = [r["text"] for r in small.limit(60).collect()]
    for t in texts:
        assert sorted(bag(t).values()) == sorted(bagminhash.shingles(t)[1].tolist())
    for a, b in zip(texts, texts[1:]):
        assert bagminhash.overlap(bagminhash.shingles(a), bagminhash.shingles(b)) == pytest.approx(likeness(bag(a), bag(b)))


def test_classes_equal_brute_force(spark):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    base = [draw.sample(words, 120) for _ in range(6)]
    texts = []
    for b in base:                                     # families whose members differ by a few words
        for _ in range(12):
            t = list(b)
            for _ in range(draw.randint(0, 5)):
                t[draw.randrange(len(t))] = draw.choice(words)
            texts.append(" ".join(t))
    texts += [texts[0], texts[0], "short text", "short text", "Short  TEXT", "", "", None, None, "!!!", "x " * 3000]
    draw.shuffle(texts)
    df = docs(spark, texts).withColumn("class_id", F.lit("clash"))
    rows = bagminhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == brute_classes(list(enumerate(texts)))
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)
    kept = bagminhash.deduplicated(df).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["class_id"] for r in rows})
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0
    again = df.unionAll(df).unionAll(spark.createDataFrame([(None, texts[0], None, None, None, "c")], df.schema))
    twice = bagminhash.near_duplicates(again).collect()
    assert {(r["doc_id"], r["class_id"]) for r in twice if r["doc_id"] is not None} == {(r["doc_id"], r["class_id"]) for r in rows}
    assert bagminhash.deduplicated(again).count() == len(kept)


def test_rows_without_or_with_repeated_ids_keep_their_texts(spark):
    words = [f"u{i}" for i in range(400)]
    long = [" ".join(words[at:at + 100]) for at in (0, 100, 200, 300)]
    near = [t + " tail" for t in long]                     # 96 of 97 runs are shared
    rows = [(None, "only here"), (None, long[0]), (None, near[0]), (None, long[0]),    # a class without any id
            (7, long[1]), (7, long[2]), (7, "seven"), (7, "seven"),                    # one id, three texts
            (None, near[2]), (9, long[3]), (8, near[3]), (None, long[3]), (5, None), (5, None), (None, None), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)
    got = collections.Counter((r["doc_id"], r["text"]) for r in bagminhash.deduplicated(df).collect())
    unnamed = [k for k in got if k in ((None, long[0]), (None, near[0]))]
    assert len(unnamed) == 1
    assert got == collections.Counter({(None, "only here"): 1, unnamed[0]: 1, (7, long[1]): 1, (7, long[2]): 1, (7, "seven"): 1,
                                       (8, near[3]): 1, (5, None): 1, (None, None): 2})
    found = collections.Counter(tuple(r) for r in bagminhash.near_duplicates(df).collect())
    assert found == collections.Counter({(None, None, True): 4, (None, None, False): 2, (7, 7, True): 4, (None, 7, False): 1,
                                         (9, 8, False): 1, (8, 8, True): 1, (None, 8, False): 1, (5, 5, True): 2})


def test_complete_comparison_of_a_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    draw = random.Random(5)
    words = [f"v{i}" for i in range(2000)]
    texts = []
    for _ in range(3):
        chain = draw.sample(words, 60)
        for _ in range(9):                             # each member is like the one before, not like the first
            chain = chain[3:] + draw.sample(words, 3)
            texts.append(" ".join(chain))
    df = docs(spark, texts).selectExpr("doc_id as id", "doc_id as class", "text")
    group = df.selectExpr("0 as band", "0L as key", "id", "class", "text", "cast(id % 4 as int) as block")
    met = group.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "band", "key", "id", "class", "text", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        (F.col("block") < F.col("with")).alias("left"), (F.col("block") > F.col("with")).alias("right"))
    links = bagminhash.rest_links(met, 0.8)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    want = brute_classes(list(enumerate(texts)))
    assert {i: got.get(i, i) for i in want} == want


# -- embeddings ---------------------------------------------------------------------------

def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)               # hot buckets go in many blocks
    draw = np.random.default_rng(2)
    base = draw.standard_normal((12, 16))
    rows = [base[i % 12] + draw.standard_normal(16) * (0.05 if i % 3 else 0.12) for i in range(120)]
    rows += [rows[0], rows[0], rows[0] * 7]
    rows = [r.astype(np.float32).astype(float).tolist() for r in rows]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [], [None] + [1.0] * 15, [1.0, 2.0], [-0.0, 0.0]]
    data = [(i, v, "x") for i, v in enumerate(rows + odd)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n_links string")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    v = np.array(rows)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(len(rows))] == near.sum(1).tolist()
    reach = np.linalg.matrix_power((near | np.eye(len(v), dtype=bool)).astype(float), 40) > 0
    assert [got[i]["component_id"] for i in range(len(rows))] == reach.argmax(1).tolist()
    for i in range(len(rows), len(data)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    twice = vectors.near_duplicates(df.where("vec_id = 5").unionAll(df.where("vec_id = 5"))).collect()
    assert [(r["n_links"], r["component_id"]) for r in twice] == [(1, 5), (1, 5)]


def test_vectors_without_an_id_link_like_others(spark):
    big = (1 << 53) + 1
    a, b, c, d = ([1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0])
    near = lambda v: [x + 0.01 for x in v]
    rows = [(None, a), (big, near(a)), (big + 2, a),       # named by the one row that has the smaller id
            (None, b), (None, b), (None, near(b)),         # no id at all
            (None, c), (big + 4, d), (None, None), (None, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = collections.Counter(tuple(r) for r in vectors.near_duplicates(df).collect())
    kept = sum(n for r, n in got.items() if r[:3] == (None, 2, None) and r[3])
    assert kept == 1
    assert got == collections.Counter({(None, 2, big, False): 1, (big, 2, big, True): 1, (big + 2, 2, big, False): 1,
                                       (None, 2, None, True): 1, (None, 2, None, False): 2, (None, 0, None, True): 3,
                                       (big + 4, 0, big + 4, True): 1})


# -- winnowing ----------------------------------------------------------------------------

def plain_marks(text):
    """(hash, position) of each mark, window by window."""
    k, w = winnowing.GRAM, winnowing.WINDOW
    units = "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")
    if not units:
        return []
    runs = [units[i:i + k] for i in range(len(units) - k + 1)] if len(units) >= k else [units]
    grams = [xxhash.xxh64_intdigest(run.encode(), 42) & (1 << 31) - 1 for run in runs]
    found = []
    for i in range(max(1, len(grams) - w + 1)):
        at = min(range(i, min(i + w, len(grams))), key=lambda j: (grams[j], -j))
        if (grams[at], at) not in found:
            found.append((grams[at], at))
    return found


def plain_digests(spark, texts):
    """The digest of the plain marks of each text."""
    rows = [(i, [h * (1 << 31) + (1 << 31) - 1 - at for h, at in plain_marks(t)]) for i, t in enumerate(texts)]
    found = spark.createDataFrame(rows, "i int, m array<bigint>").select("i", winnowing.digest(F.col("m")).alias("d"))
    return [r["d"] for r in found.orderBy("i").collect()]


def plain_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def marks_of(df):
    return winnowing.with_marks(df.withColumn("units", winnowing.units(F.col("text"))), m="units")


def test_marks_equal_the_plain_algorithm(spark):
    draw = random.Random(4)
    texts = ["", "a", "a b c d", "a b c d e", " ".join("ab"[draw.random() < .5] for _ in range(90)), "same " * 60,
             " ".join(f"w{draw.randrange(30)}" for _ in range(300)), "漢字かな混じり文 and words\n\tmore", None, "😀a😀b" * 9, "\x0b\f\u00a0x\r y"]
    got = marks_of(docs(spark, texts)).select("text", winnowing.positions(F.col("m")).alias("m")).collect()
    for r in got:
        assert [tuple(x) for x in r["m"]] == plain_marks(r["text"])
    passage = [f"shared{i}" for i in range(winnowing.GRAM + winnowing.WINDOW - 1)]
    pair = [" ".join([f"l{i}" for i in range(50)] + passage), " ".join([f"r{i}" for i in range(77)] + passage + ["end"] * 30)]
    a, b = marks_of(docs(spark, pair)).select(winnowing.hashes(F.col("m"))).collect()
    assert set(a[0]) & set(b[0])


def test_edited_marks_and_likeness_equal_plain_ones_of_the_whole_edited_text(spark):
    draw = random.Random(11)
    texts = ["".join(draw.choice(abc) for _ in range(n)) for abc in ("ab", "abcdefgh \n", "a ", "é漢😀 x")
             for n in (0, 1, 2, 3, 5, 7, 8, 9, 11, 12, 13, 16, 20, 21, 22, 23, 24, 25, 30, 45, 200)]
    draw.shuffle(texts)
    got = {r["doc_id"]: r for r in winnowing.edited_fingerprints(docs(spark, texts)).collect()}
    edits = [t[:len(t) - len(t) // 3] + texts[i - 1][:len(t) // 3] for i, t in enumerate(texts)]
    own_digests, edited_digests = plain_digests(spark, texts), plain_digests(spark, edits)
    for i, t in enumerate(texts):
        own, edited, other = plain_marks(t), plain_marks(edits[i]), plain_marks(texts[i - 1])
        assert got[i]["fingerprint"] == own_digests[i] and got[i]["edited_fingerprint"] == edited_digests[i], (i, t)
        assert abs(got[i]["near_edited"] - plain_likeness(own, edited)) < 1e-12
        assert abs(got[i]["near_next"] - plain_likeness(own, other)) < 1e-12


def test_edited_fingerprints(spark):
    texts = ["one two three four five six seven eight nine ten " * 4, None, "", "é漢😀 tail of a text", "a", "zz top " * 20]
    df = docs(spark, texts).withColumn("marks", F.lit(0))
    got = {r["doc_id"]: r for r in winnowing.edited_fingerprints(df).collect()}
    for i, t in enumerate(texts):
        t, other = t or "", texts[i - 1] or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + other[:cut]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == t:
            assert got[i]["fingerprint"] == got[i]["edited_fingerprint"] and got[i]["near_edited"] == 1
    one = winnowing.edited_fingerprints(df.where("doc_id = 0")).first()      # its own neighbour
    assert one["near_next"] == 1.0
    again = df.unionAll(df).unionAll(spark.createDataFrame([(None, "null id", None, None, None, 0)], df.schema))
    rows = winnowing.edited_fingerprints(again).collect()
    assert len(rows) == 13 and {r["doc_id"] for r in rows} == {None, *range(6)}
    assert winnowing.edited_fingerprints(df.limit(0)).count() == 0


def test_short_and_unspaced_texts_leave_common_marks(spark):
    draw = random.Random(8)
    letters = lambda n, first, many: "".join(chr(first + draw.randrange(many)) for _ in range(n))
    texts = ["red apples grow slowly", "internationalisation", "one two three four five six seven eight",
             " ".join(letters(5, 97, 26) for _ in range(12)), letters(60, 97, 26), letters(60, 0xE01, 46),     # Thai
             letters(60, 0x1780, 36), letters(60, 0x4E00, 900), letters(60, 48, 10), "bcdfg" * 3 + letters(30, 98, 2)]
    got = {r["doc_id"]: r["near_edited"] for r in winnowing.edited_fingerprints(docs(spark, texts)).collect()}
    assert all(0 < got[i] < 1 for i in range(len(texts)))
    for first, many in ((97, 26), (0xE01, 46), (0x1780, 36), (0x4E00, 900)):     # a passage inside one unspaced run
        passage = letters(winnowing.GRAM + winnowing.WINDOW - 1, first, many)
        pair = [letters(33, first, many) + passage + letters(9, first, many), letters(14, first, many) + passage]
        a, b = marks_of(docs(spark, pair)).select(winnowing.hashes(F.col("m"))).collect()
        assert set(a[0]) & set(b[0])


# -- preference pairs -----------------------------------------------------------------------

TURNS = "pair_id long, turn long, role string, text string"


def render(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}\n<|end|>\n" for r, t in turns)


def test_pairs_equal_the_plain_algorithm(spark):
    draw = random.Random(9)
    sides = {"c": [], "r": []}
    want = {}
    for pair in range(40):
        shared = [(draw.choice(["user", "assistant", "system", None]), draw.choice(["x", "", None, "é<|end|>", "long " * 50]))
                  for _ in range(draw.randrange(4))]
        tails = [[(draw.choice(["user", "assistant"]), f"{name}{i}") for i in range(draw.randrange(4))] for name in "cr"]
        if pair == 3:
            tails = [[], []]
        for name, tail in zip("cr", tails):
            sides[name] += [(pair, i, r, t) for i, (r, t) in enumerate(shared + tail)]
        a, b = ([(r or "", t or "") for r, t in shared + tail] for tail in tails)
        if not a and not b:
            continue
        n = next((i for i, (x, y) in enumerate(itertools.zip_longest(a, b)) if x != y), len(a))
        want[pair] = (n, render(a[:n]), render(a[n:]), render(b[n:]))
    got = preference.format_pairs(spark.createDataFrame(sides["c"], TURNS).withColumn("prompt", F.lit(1)),
                                  spark.createDataFrame(sides["r"], TURNS)).collect()
    assert {r["pair_id"]: (r["common_turns"], r["prompt"], r["chosen"], r["rejected"]) for r in got} == want
    for r in got:
        for side in ("chosen", "rejected"):
            trained = [r[side][s["start"]:s["start"] + s["length"]] for s in r[f"{side}_mask"]]
            said = [p.split("|>\n", 1)[1] for p in r[side].split("<|assistant")[1:]]
            assert len(trained) == len(said) and all(s.startswith(t) and t.endswith("<|end|>\n") for s, t in zip(said, trained))
    empty = spark.createDataFrame([], TURNS)
    assert preference.format_pairs(empty, empty).count() == 0
    alone = preference.format_pairs(spark.createDataFrame([(1, 0, "user", "q"), (1, 0, "user", "q")], TURNS), empty).first()
    assert (alone["common_turns"], alone["rejected"], alone["chosen"]) == (0, "", render([("user", "q")] * 2))


# -- token files ------------------------------------------------------------------------------

def test_encoder_equals_the_library(encoder, small):
    draw = random.Random(1)
    parts = ["a", "B", "é", "é", "́", "Σ", " ", "\n", "\t", "\x01", "\x1c", "\x85", "\xa0", "漢", "'s", "'", "12", "!",
             "<|endoftext|>", "<|start", "😀", "‍", "İ", "가", "ᄀ", "ᅡ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(4000)]
    texts += [r["text"] for r in small.collect()] + [""]
    want = [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert encoder.encode([None])[0].tolist() == []


def test_other_cases_of_added_tokens_are_plain_text(encoder):
    texts = ["<|ENDOFTEXT|>", "<|EndOfText|>", "a<|ENDOFTEXT|>b, <|endoftext|>. C", "<|startOFtext|> x", "<|ENDOFTEXT|>\n<|endoftext|>"]
    texts += [c for t in encoder.library.get_added_tokens_decoder().values() for c in (t.content, t.content.upper(), t.content.title())]
    want = [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert len(want[0]) > 1


def test_blocks_round_trip_and_decode_alone():
    draw = np.random.default_rng(6)
    blocks = [[np.array([2])], [draw.integers(0, 6, n) for n in (1, 400, 3, 2000)], [np.full(999, 7), np.full(2, 7)],
              [draw.integers(0, 49408, 50) for _ in range(30)], [np.tile([1, 2, 3, 4, 5], 300), np.array([1])]]
    for docs_ in blocks:
        payload = tokenfile.dump(docs_, 49408)
        block = tokenfile.Block(payload)
        whole, ends = block.all()
        assert whole.tolist() == np.concatenate(docs_).tolist()
        assert ends.tolist() == np.cumsum([len(d) for d in docs_]).tolist()
        for i, d in enumerate(docs_):
            assert tokenfile.Block(payload).doc(i).tolist() == d.tolist()
    assert len(tokenfile.dump([np.tile([1, 2, 3, 4, 5], 3000)], 49408)) < 10000
    wide = [draw.integers(65000, 70000, 300), np.tile([69999, 65001], 100)]
    assert tokenfile.Block(tokenfile.dump(wide, 70000)).all()[0].tolist() == np.concatenate(wide).tolist()
    with pytest.raises(ValueError):
        tokenfile.Block(b"nope" + payload[4:])


def apart(symbols):
    """How often each adjacent pair stands in a list without overlapping itself."""
    found, since = collections.Counter(), {}
    for i, p in enumerate(zip(symbols, symbols[1:])):
        if since.get(p, -2) < i - 1:
            found[p] += 1
            since[p] = i
    return found


def test_the_grammar_ends_when_no_pair_inside_documents_occurs_twice():
    draw = np.random.default_rng(4)
    copies = [np.append(draw.integers(0, 50, 200), 2)] * 60
    for docs_ in (copies, [draw.integers(0, 9, n) for n in (500, 1, 40, 800)], [np.full(777, 7), np.array([7, 7, 1, 7, 7])]):
        last = np.zeros(sum(map(len, docs_)), bool)
        last[np.cumsum([len(d) for d in docs_]) - 1] = True
        symbols, ends, rules = tokenfile.compress(np.concatenate(docs_), last, 60)
        cuts = np.flatnonzero(ends) + 1
        left = collections.Counter()
        for part in np.split(symbols, cuts[:-1]):
            left.update(apart(part.tolist()))
        assert len(cuts) == len(docs_) and max(left.values(), default=1) == 1
        used = collections.Counter(rules.ravel().tolist()) + collections.Counter(symbols.tolist())
        assert all(used[60 + i] >= 1 for i in range(len(rules)))
        if docs_ is copies:
            assert len(symbols) == len(copies)             # one symbol a copy


def test_token_files_of_awkward_documents(spark, encoder, tmp_path):
    texts = ["b a", None, "", "x " * 4000, "same", "same"]
    df = docs(spark, texts).unionAll(docs(spark, ["again"], 4)).withColumn("part", F.lit("clash"))
    df = df.unionAll(spark.createDataFrame([(None, "no id", None, None, None, "c")], df.schema)).repartition(3)
    tokenfile.write(df, str(tmp_path / "f"))
    rows = sorted(tokenfile.read(spark, str(tmp_path / "f")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 4, 4, 5]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["doc_id"] in (0, 1, 2, 3, 5):
            ids = np.append(encoder.encode([texts[r["doc_id"]]])[0], 2).astype("<u4")
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids))
    tokenfile.write(df.limit(0), str(tmp_path / "e"))
    assert tokenfile.read(spark, str(tmp_path / "e")).count() == 0


# -- WARC -------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_archives_with_records_inside_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = ["<p>é</p>", None, "", "plain", "plain", "WARC/1.1\r\n", inner, "x" + inner * 5 + "tail", "WARC/1.1\r\n\r\n\r\n" + "y" * 900,
            inner + "WARC/1.1\r\nContent-Length: 9999\r\n\r\n", "\r\n\r\nWARC/1.1", "line\n" * 300]
    rows = [(i, None if i == 2 else f"http://x/{i}\r\nWARC/1.1", h) for i, h in enumerate(html)]
    df = spark.createDataFrame(rows, PAGES).withColumn("type", F.lit("clash"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "300b"):                      # whole files, and splits smaller than a record
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            path = str(tmp_path / size)
            warc.write(df.coalesce(1), path)
            got = {r["page_id"]: r for r in warc.page_records(warc.read(spark, path)).collect()}
            assert sorted(got) == list(range(len(html)))
            import base64
            import hashlib
            for i, h in enumerate(html):
                data = (h or "").encode()
                first = min(j for j, o in enumerate(html) if (o or "") == (h or ""))
                assert got[i]["payload_bytes"] == len(data)
                assert got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
                assert got[i]["record_type"] == ("response" if i == first else "revisit")
                assert got[i]["refers_to"] == (None if i == first else first)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    warc.write(df, str(tmp_path / "short"), min_bytes=6)
    kinds = {r["page_id"]: r["record_type"] for r in warc.page_records(warc.read(spark, str(tmp_path / "short"))).collect()}
    assert set(kinds.values()) == {"response"}
    warc.write(df.limit(0), str(tmp_path / "none"))
    assert warc.page_records(warc.read(spark, str(tmp_path / "none"))).count() == 0
    null = spark.createDataFrame([(None, "u", "only"), (4, "u", "dup"), (4, "u", "dup")], PAGES)
    warc.write(null, str(tmp_path / "null"))
    got = warc.page_records(warc.read(spark, str(tmp_path / "null"))).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in got) == [(0, "response"), (4, "response"), (4, "response")]


# -- language identification --------------------------------------------------------------------

def test_held_out_accuracy_and_rules(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_profiles_equal_plain_counts():
    text = "Aa b!\tÑandú aa AA 漢字 x1y"
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    want = collections.Counter()
    for w in words:
        padded = f" {w} "
        want.update(w)
        want.update(padded[i:i + 2] for i in range(len(padded) - 1))
        want.update(padded[i:i + 3] for i in range(len(padded) - 2))
    codes, counts = langid.grams(text)
    got = {"".join(chr(int(c) >> s & 0x1FFFFF) for s in (42, 21, 0) if int(c) >> s): int(n) for c, n in zip(codes, counts)}
    assert got == want


def test_awkward_texts_and_tables(spark):
    train = docs(spark, ["the cat and the dog"] * 6 + [None, "", "123 !!", "zzz"]).withColumn("lang_pred", F.lit("clash"))
    train = train.withColumn("lang", F.when(F.col("doc_id") == 9, None).otherwise(F.col("lang")))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(train).collect()}
    assert got[6] == got[7] == got[8] == ("und", 0.0)
    assert got[0] == ("en", 1.0) and got[9][0] == "en"
    assert langid.identify(train.limit(0)).count() == 0
    none = langid.identify(train.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert {r["doc_id"] for r in langid.accepted(train).collect()} == set(range(6))


# -- mixing -----------------------------------------------------------------------------------

def poisson_count(u, rate):
    k, p, total = 0, math.exp(-rate), 0.0
    while True:
        total += p
        if total > u:
            return k
        k += 1
        p *= rate / k


def bits(text):
    import hashlib
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) / float(1 << 60)


def test_mix_equals_plain_inversion(spark):
    rows = [(i, f"t{i}", "en", s, 2) for i, s in enumerate(["a"] * 300 + ["b"] * 30 + [None] * 20 + ["c"])]
    df = spark.createDataFrame(rows, DOCS).withColumn("copy", F.lit("clash"))
    for weights, total in ((None, None), ({"a": 1.0, None: 1.0, "zz": 5.0}, 1000.0)):
        got = collections.Counter(r["doc_id"] for r in mixing.mix(df, weights, total).collect())
        n = collections.Counter(r[3] for r in rows)
        w = {s: k ** mixing.SMOOTHING for s, k in n.items()} if weights is None else {s: weights.get(s, 0.0) for s in n}
        want = {}
        for i, _, _, s, _ in rows:
            rate = w[s] / sum(w.values()) * (total or len(rows)) / n[s]
            c = poisson_count(bits(f"{mixing.SEED}:{i}"), rate) if rate else 0
            if c:
                want[i] = c
        assert got == want
    out = mixing.mix(df, {"b": 1.0}, 30 * 40.0)
    assert 1000 < out.count() < 1400 and {r["source"] for r in out.collect()} == {"b"}
    order = [r["doc_id"] for r in out.collect()]
    assert order != sorted(order)
    assert mixing.mix(df.limit(0)).count() == 0
    twice = mixing.mix(df.unionAll(df), {"a": 1.0}, 300.0).groupBy("doc_id", "copy").count().collect()
    assert {r["count"] for r in twice} == {2}


# -- packing ------------------------------------------------------------------------------------

def fewest(items, capacity):
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(items):
            best = len(loads)
            return
        for j in {loads.index(x) for x in set(loads)}:
            if loads[j] + items[i] <= capacity:
                place(i + 1, loads[:j] + [loads[j] + items[i]] + loads[j + 1:])
        place(i + 1, loads + [items[i]])

    place(0, [])
    return best


def test_bin_completion_finds_the_optimum_of_small_cases():
    draw = random.Random(2)
    for _ in range(150):
        capacity = draw.randint(5, 30)
        counts = collections.Counter(draw.randint(1, capacity) for _ in range(draw.randint(1, 10)))
        plan = packing.complete(counts, capacity)
        used = collections.Counter()
        for filling, times in plan:
            assert sum(k * m for k, m in filling.items()) <= capacity
            for k, m in filling.items():
                used[k] += m * times
        assert used == counts
        assert sum(t for _, t in plan) == fewest(list(counts.elements()), capacity)
    assert packing.complete({}, 10) == []


def check_packed(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_documents_are_packed_whole(spark, encoder):
    texts = [None, "", "word " * 5000, "a b c", "a b c", "x"] + ["some text here " * n for n in range(40)]
    df = docs(spark, texts).withColumn("length", F.lit("clash"))
    df = df.unionAll(df.where("doc_id = 3")).unionAll(spark.createDataFrame([(None, "t", None, None, None, "c")], df.schema))
    rows = packing.pack_documents(df, 64).collect()
    sequences = check_packed(rows, 64)
    assert sequences <= -(-sum(r["length"] for r in rows) // 64) + 1
    for i, t in enumerate(texts):
        whole = np.append(encoder.encode([t])[0], 0).astype("<u4")
        want = [(k, s, len(whole[s:s + 64]), zlib.crc32(whole[s:s + 64])) for k, s in enumerate(range(0, len(whole), 64))]
        got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i)
        assert got == sorted(want * (2 if i == 3 else 1))
    assert packing.pack_documents(df.limit(0), 64).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 65)], "doc_id long, length long"), 64, ["doc_id"])


# -- names of the input that the operators use themselves; many languages ------------------------------

def test_clashing_columns_stay(spark, small):
    names = ["_source", "_cdf", "_u", "_copies", "_place", "_p", "_key", "_row", "row", "found", "key", "of", "cdf", "u", "copies",
             "place", "a.b", "same", "n", "w"]
    df = small.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    for out in (mixing.mix(df), langid.accepted(df), bagminhash.deduplicated(df)):
        got = out.select(df.columns if "a.b" not in df.columns else [F.col(f"`{c}`") for c in df.columns]).collect()
        assert got and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in names)
        assert out.columns[:len(df.columns)] == df.columns


def test_more_languages_than_a_block(spark, small, monkeypatch):
    want = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(small).collect()}
    monkeypatch.setattr(langid, "LANGUAGES", 1)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(small).collect()}
    assert got == want


def test_texts_in_an_unlearned_language_are_rejected_and_short_clean_ones_stay(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*small_columns)
    foreign = ["Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw sa oni obdarzeni rozumem i sumieniem",
               "Kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu jarki ja omatunto",
               "zxqv wkjq xzzy qqwv kxjz vvkq zzxj wqkz jxqv kkzw xvqj zwkx"]
    more = spark.createDataFrame([(10 ** 6 + i, t, None, "s", len(t)) for i, t in enumerate(foreign)], DOCS)
    kept = {r["doc_id"] for r in langid.accepted(rows.unionAll(more)).select("doc_id").collect()}
    assert not kept & {10 ** 6 + i for i in range(len(foreign))}
    assert len(kept) >= 0.995 * rows.count()


small_columns = ["doc_id", "text", "lang", "source", "n_chars"]
