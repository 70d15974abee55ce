"""Texts are marked once, in runs of adjacent documents."""
import random

from pyspark.sql import functions as F

from ordermill.llm import common, winnowing

from .test_llm_operators import docs, plain_digests, plain_likeness, plain_marks


def test_adjacent_keys_form_runs_within_their_room(spark):
    rows = [(3 * i, 10 if i % 7 else 95) for i in range(60)]
    got = sorted(common.neighbours(spark.createDataFrame(rows, "k long, size long").repartition(3), "k", "size", 40).collect())
    assert [r["begins"] for r in got] == [i == 0 or got[i - 1]["run"] != r["run"] for i, r in enumerate(got)]
    assert all(r["begins"] or r["at"] == got[i - 1]["at"] + 1 for i, r in enumerate(got))
    runs = {}
    for r in got:
        runs.setdefault(r["run"], []).append(r["size"])
    assert 5 < len(runs) < 60 and all(sum(sizes[1:]) <= 40 for sizes in runs.values())


def test_fingerprints_across_runs_and_each_text_marked_once(spark, monkeypatch):
    monkeypatch.setattr(common.neighbours, "__defaults__", (None, 300))
    draw = random.Random(2)
    texts = ["".join(draw.choice("abcd é") for _ in range(draw.randrange(400 if i % 5 else 9))) for i in range(40)]
    marked = []
    grams = winnowing._grams
    monkeypatch.setattr(winnowing, "_grams", lambda name: marked.append(name) or grams(name))
    found = winnowing.edited_fingerprints(docs(spark, texts))
    assert sorted(marked) == ["_end", "_seam", "a", "a"]    # the second for rows without a doc_id
    got = {r["doc_id"]: r for r in found.collect()}
    edits = [t[:len(t) - len(t) // 3] + texts[i - 1][:len(t) // 3] for i, t in enumerate(texts)]
    own, edited = plain_digests(spark, texts), plain_digests(spark, edits)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (own[i], edited[i])
        assert abs(got[i]["near_next"] - plain_likeness(plain_marks(t), plain_marks(texts[i - 1]))) < 1e-12
    twice = docs(spark, texts).unionAll(docs(spark, texts)).unionAll(docs(spark, texts).withColumn("doc_id", F.lit(None).cast("long")))
    rows = winnowing.edited_fingerprints(twice).collect()
    assert len(rows) == 120 and all(r["near_next"] == got[r["doc_id"]]["near_next"] for r in rows if r["doc_id"] is not None)
