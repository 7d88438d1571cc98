"""The corpus pipeline: documents that are fit for training, packed into sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the next one's documents; the last
returns the packed pieces. Every stage works on all rows its predecessor kept, and its result
is written under the shared folder and read again. No stage is expressible in SQL, so
``ORACLE_SQL`` is None and the tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, packing, secret_scan, simhash, toxicity
from tidemark.llm.storage import importable, staged, table

PACKING_TOKENIZER = "word_bpe_49k.json"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; labels are learned from outside the held-out rows."""
    importable(spark)
    return toxicity.without_toxic(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash class: the one with the least id."""
    importable(spark)
    return simhash.one_of_each_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    importable(spark)
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; keeps every document."""
    return secret_scan.redact_secrets(docs, secret_scan.train_markov(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences: a row for each piece."""
    importable(spark)
    return packing.pack_documents(docs, public_tokenizers.path(PACKING_TOKENIZER))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
