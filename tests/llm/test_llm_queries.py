"""Registered queries against their SQL, the pipeline against a brute-force version, and the package's borders."""

from __future__ import annotations

import collections
import os
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from ordermill.llm import langid, mixing
from ordermill.llm.queries import ORACLE, QUERIES
from ordermill.llm.tokens import Encoder, default_vocabulary
from tests.llm.test_llm_operators import bits, brute_classes, check_packed, poisson_count

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    lines = lambda rows, cols: sorted("|".join(norm(r[cols.index(c)]) for c in sorted(cols)) for r in rows)
    assert lines([tuple(r) for r in df.collect()], df.columns) == lines(rel.fetchall(), rel.columns)


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


def plain_profile(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    found = collections.Counter()
    for w in words:
        p = f" {w} "
        found.update(w)
        found.update(p[i:i + 2] for i in range(len(p) - 1))
        found.update(p[i:i + 3] for i in range(len(p) - 2))
    return found


def plain_rank(found):
    key = lambda g: [0] * (3 - len(g)) + [ord(c) for c in g]
    return sorted(found, key=lambda g: (-found[g], key(g)))[:langid.PROFILE]


def trains(r):
    return zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"] is not None


def plain_languages(rows):
    """(language, score) by doc_id, counted and ranked one n-gram at a time."""
    learned = collections.defaultdict(collections.Counter)
    for r in rows:
        if trains(r):
            learned[r["lang"]].update(plain_profile(r["text"]))
    place = {lang: {g: i for i, g in enumerate(plain_rank(learned[lang]))} for lang in sorted(learned)}

    def judge(text):
        own = plain_rank(plain_profile(text))
        if not own:
            return "und", 0.0
        away = {lang: sum(min(abs(p[g] - i), langid.PROFILE) if g in p else langid.PROFILE for i, g in enumerate(own)) for lang, p in place.items()}
        lang = min(away, key=lambda x: (away[x], x))
        return lang, 1 - away[lang] / (langid.PROFILE * len(own))

    return {r["doc_id"]: judge(r["text"]) for r in rows}


def test_languages_and_scores_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_languages(docs.collect())
    got = {r["doc_id"]: r for r in QUERIES["op8_rank_order_langid"](spark, SF).collect()}
    assert sorted(got) == sorted(want)
    for i, (lang, score) in want.items():
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-12
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def plain_accepted(rows):
    judged = plain_languages(rows)
    own = sorted(int(judged[r["doc_id"]][1] * langid.STEPS) for r in rows if trains(r) and judged[r["doc_id"]][0] == r["lang"])
    least = next(s for k, s in enumerate(own) if sum(x <= s for x in own) * langid.RARE > len(own)) * langid.MARGIN / langid.STEPS
    return [r for r in rows if judged[r["doc_id"]][0] != "und" and judged[r["doc_id"]][1] >= least]


def test_pipeline_equals_brute_force(spark):
    rows = plain_accepted(spark.read.parquet(f"{SF}/documents.parquet").collect())
    classes = brute_classes([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if classes[r["doc_id"]] == r["doc_id"]]
    n = collections.Counter(r["source"] for r in rows)
    weight = {s: k ** mixing.SMOOTHING for s, k in n.items()}
    encoder, want = Encoder(default_vocabulary()), []
    for r in rows:
        rate = weight[r["source"]] / sum(weight.values()) * len(rows) / n[r["source"]]
        whole = np.append(encoder.library.encode(r["text"] or "", add_special_tokens=False).ids, 0).astype("<u4")
        for _ in range(poisson_count(bits(f"{mixing.SEED}:{r['doc_id']}"), rate)):
            want += [(r["doc_id"], k, s, len(whole[s:s + 2048]), zlib.crc32(whole[s:s + 2048]))
                     for k, s in enumerate(range(0, len(whole), 2048))]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert check_packed(got, 2048) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mixing", "packing"]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.limit(0), SF)
        assert out.count() == 0 and (i == 3 or out.columns == docs.columns)


def test_nothing_else_imports_the_package():
    code = ("import sys, __spark_entry__ as e; sys.modules['ordermill.llm'] = None; "
            "import ordermill.plans.registry, ordermill.plans.runs, ordermill.streaming.jobs; print(len(e.queries()))")
    assert int(subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()[-1]) > 60
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.split('.')[:2] == ['ordermill', 'llm'] or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "print(any(n.startswith('op') and n[2].isdigit() for n in e.queries()), len(e.queries()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert out[-2] == "False" and int(out[-1]) > 50
