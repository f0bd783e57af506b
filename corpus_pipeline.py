"""Corpus pipeline over ``documents``: quality rules, near-duplicates, repeated passages, source mix, piece ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of ``docs``. Rules of the single stages are in the docstrings of their operators. An empty table passes through.

* ``quality_rules`` drops documents that fail the base rules or score below the threshold against trusted documents.
* ``simhash_near_dedup`` keeps, of each group of near-duplicates, the document with the smallest id.
* ``substring_dedup`` cuts passages that repeat one of a document with a smaller id; documents left without words go.
* ``source_mixing`` takes documents by the target weights of their sources, some twice, and leaves others out.
* ``sentencepiece`` returns each row's piece ids instead of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelscore.llm import mixing, passages, pieces, quality, simhash
from panelscore.llm.common import session, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = session(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs, quality.trusted_ids(labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return passages.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session(spark)
    return pieces.encoded(docs.select("doc_id", "lang", "source", "text")).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: SQL can't express fingerprints, compact windows and piece merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
