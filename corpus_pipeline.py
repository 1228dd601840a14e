"""Corpus pipeline: toxicity, language, near duplicates, benchmark
decontamination, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one
before it kept; its result is written as Parquet and read again. All but the
last return the columns of ``documents``.

- toxicity: documents that score 0.5 or more go; the model learns from the
  labelled documents outside its held-out fifth.
- language: documents without a letter, or with hardly any n-gram of a learned
  language, go.
- near duplicates: of each class of documents linked by a Jaccard similarity
  of 0.8 of their five-word shingles, the one with the least id stays.
- decontamination: documents that hold a benchmark item go.
- BPE: ids of every text, and the bytes they decode to, as digests.

Null and empty texts are not toxic and have no language, so they go in the
second stage. Repeated rows are one document for the third stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybatch.llm import decontaminate, jaccard, language, queries, toxicity
from waybatch.llm.common import table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(spark, docs, queries.read(spark, sf_dir, "labels"))
    return toxicity.not_toxic(spark, docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.in_known_language(spark, docs, language.train(spark, docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(spark, docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(spark, docs, queries.read(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.bpe_digests(spark, docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", bpe_stage),
]

#: Learned models, links and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
