"""Corpus pipeline: language identification, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's documents. All but the last return the columns of ``documents``; rows
that mixing repeats are packed as often as they occur.

Defined cases: texts that are null or have no letter go with the first stage. Rows without a doc_id, and
rows that share one, are kept like others (the second stage knows texts by their digest); a null source is a source.
Further columns of the documents stay through the first three stages, whatever their names. Without
labelled languages, and for an empty table, every stage returns no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import bagminhash, langid, mixing, packing
from ordermill.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the labelled rows; others go."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return bagminhash.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target weights."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("mixing", mixed), ("packing", packed)]
#: Tokenisation and rank-order profiles have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "llm", f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
