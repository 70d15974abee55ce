"""Quality scores, ranked search and the conversation tree against brute-force versions and awkward inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import quality, ranking, trie

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# -- conversation tree ----------------------------------------------------------------

def plain_nodes(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + v[h:]
    members, children, out = collections.defaultdict(list), collections.defaultdict(set), []
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].add(k)

    def visit(k):
        leaves = 0 if children[k] else 1
        saved = (len(members[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        for child in children[k]:
            more = visit(child)
            leaves, saved = leaves + more[0], saved + more[1]
        ends = ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        visit(())
    return sorted(out, key=str)


def nodes(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    df = df.withColumns({"t": F.lit(1), "place": F.lit("x"), "words": F.lit(None).cast("int")})       # clashing names
    return sorted([tuple(r) for r in trie.conversation_nodes(df).select(NODE).collect()], key=str)


@pytest.mark.parametrize("cells", [1 << 21, 40, 3])
def test_tree_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(trie, "BLOCK_CELLS", cells)
    rng, rows = random.Random(5), []
    for c in range(90):
        for t in range(rng.choice([1, 1, 2, 3, 4, 8])):
            rows.append((c, None if rng.random() < 0.03 else t, rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "b b", "", None, "c c  d", " x\x0b y"])))
    rows += [(1000 + i, t, "user", "hot turn words") for i in range(80) for t in range(3)]      # a group of copies
    rows += [(None, 0, "user", "x"), (5000, 0, "user", "long " * 20_000)] + [(1000, 0, "user", "hot turn words")] * 2
    rows += [(7000, t, "user", str(t)) for t in range(300)]                                     # one long conversation
    assert nodes(spark, rows) == plain_nodes(rows)


def test_tree_of_no_rows_and_of_turnless_conversations(spark):
    assert nodes(spark, []) == []
    rows = [(c, 0, "user", "only") for c in range(1, 20)]      # heads are missing: most lose their only turn
    assert nodes(spark, rows) == plain_nodes(rows)
    assert any(n[1] == 0 and n[7] != trie.NOTHING for n in nodes(spark, rows))


# -- ranked search --------------------------------------------------------------------

def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items):
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, t, collections.Counter(t)) for i, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t, _ in found)
    df, out = collections.Counter(x for _, _, c in found for x in c), []
    for item, text in set(items):
        asked = collections.Counter(plain_terms(text))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        scores = []
        for i, t, c in found:
            m = 100 - 75 + (75 * len(t) * n_docs) // n_terms
            score = sum(k * weight[x] * ((10 ** 9 * c[x]) // (1000 * c[x] + 8 * m)) for x, k in asked.items() if x in c)
            if score > 0:
                scores.append((-score, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumns(
        {"n": F.lit(0), "m": F.lit("x"), "hash": F.lit(1), "place": F.lit(2), "terms": F.lit("y")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(3))
    return sorted([tuple(r) for r in ranking.rank(a, b).select("item_id", "rank", "doc_id", "score").collect()], key=str)


@pytest.mark.parametrize("abreast", [None, 2])
def test_ranking_equals_brute_force(spark, monkeypatch, abreast):
    if abreast:                                              # many blocks of items, groups and batches
        for name, value in (("BLOCK_TERMS", 3), ("ITEMS_ABREAST", abreast), ("CLASSES_ABREAST", 16)):
            monkeypatch.setattr(ranking, name, value)
    rng = random.Random(3)
    words = ["the", "The", "a1", "É", "é", "x-y", "zz", "日本", "b", "c", "d", "e"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 8, 30])))) for i in range(300)]
    docs += [(1000 + i, "the é zz") for i in range(80)] + [(9, "zz " * 50_000)]
    docs += [(None, "the b"), (None, None), (5, ""), (6, "..."), (7, "the b"), (7, "the b"), (2 ** 60 + 1, "É"), (2 ** 60, "É")]
    items = [(1, "the the É"), (1, "the the É"), (2, "zz,b"), (3, None), (4, ""), (None, "a1"),
             (5, "日本 x y missing"), (6, "É"), (6, "zz")]
    assert ranked(spark, docs, items) == plain_ranking(docs, items)


def test_ranking_of_no_rows(spark):
    assert ranked(spark, [], [(1, "a")]) == ranked(spark, [(1, "a")], []) == ranked(spark, [(1, "-")], [(1, "a")]) == []


# -- quality --------------------------------------------------------------------------

def plain_sum(model, x):
    """A model's sum for one row, cell by cell."""
    at = [sum(e <= v for e in edges.tolist()) for edges, v in zip(model.edges, x)]
    total = model.base + sum(t[k] for t, k in zip(model.tables, at))
    coarse = [k * quality.PAIR_BINS // quality.BINS for k in at]
    return total + sum(t[coarse[i]][coarse[j]] for i, j, t in model.pairs)


def test_scores_equal_the_tables_cell_by_cell_and_tell_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    model = quality.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(got) == sorted(texts)
    for i, r in got.items():
        want = 1 / (1 + math.exp(-plain_sum(model, quality.features(texts[i]))))
        assert abs(r["score"] - want) < 1e-12 and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "score": F.lit(2.0), "_x": F.lit(1), "_y": F.lit(1), "_t": F.lit(0)})
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(quality.quality_scores(docs, labels)) == rows(quality.quality_scores(other, turned.withColumn("_y", F.lit(7))))


def test_quality_of_awkward_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x " * 100_000), (3, "x"), (3, "x"), (4, "日本!")], schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 1), (3, 1), (3, 0), (4, 2)], "doc_id long, quality int")
    got = quality.quality_scores(docs, odd).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality_scores(docs.limit(0), odd).count() == 0


def test_an_interaction_needs_its_pair_table():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (1, 0) in [(i, j) for i, j, _ in model.pairs]
    z = rng.random((2000, len(quality.FEATURES)))
    assert (((model.score(z) > 0.5) == ((z[:, 0] > 0.5) ^ (z[:, 1] > 0.5))).mean()) > 0.95
