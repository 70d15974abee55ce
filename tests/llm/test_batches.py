"""How much text goes to a Python worker at a time."""
import pyarrow as pa
from pyspark.sql import functions as F

from ordermill.llm import langid
from ordermill.llm.common import BATCHES, stored


def test_long_texts_go_to_workers_in_small_batches(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["bytes", "n"])

    texts = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("words "), 20_000).alias("text"))      # 24 MB in one task
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    rows = stored(texts.mapInArrow(run, "bytes long, n long"), "test").collect()
    assert sum(r["n"] for r in rows) == 200
    assert max(r["bytes"] for r in rows) < 6_000_000
    assert {k: spark.conf.get(k, None) for k in BATCHES} == before


def test_accepted_documents_are_scored_once_and_read_from_storage(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "the dog of the cat", "en"), (4, None, "en"), (None, "the dog", None)]
    out = langid.accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert out.columns == ["doc_id", "text", "lang"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Scan parquet" in plan
    got = {r["doc_id"] for r in out.collect()}
    assert {1, 3} <= got and 4 not in got
