"""Corpus preparation: toxicity, near duplicates, benchmark passages, personal data, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns a DataFrame, written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import bpe, decontaminate, pii, simhash, toxicity
from tallyspark.llm.common import read, stored


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is too high go; the model is fitted on the labelled documents."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"), read(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    return pii.mask(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left."""
    return bpe.report(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("pii", personal_data),
    ("bpe", tokens),
]

ORACLE_SQL = None  # the fitted model, XXH64 fingerprints and byte-pair merges have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
