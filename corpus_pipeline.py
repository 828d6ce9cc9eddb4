"""The corpus pipeline: quality rules, exact and near deduplication, mixing, packing.

Each stage takes the documents its predecessor kept and returns documents with the same
columns; the last returns the packed pieces.  Stages are written as Parquet and read
again, so a lost executor repeats a part of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventflow.llm.common import read_table, stored
from eventflow.llm.exact_dedup import drop_exact_duplicates
from eventflow.llm.minhash import drop_near_duplicates
from eventflow.llm.mixing import mix_sources
from eventflow.llm.packing import pack_documents
from eventflow.llm.quality import fit_quality, keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, learnt from the labels table."""
    return keep_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the least id."""
    return drop_exact_duplicates(docs, stable=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8): the least id."""
    return drop_near_duplicates(docs, stable=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target weights."""
    return mix_sources(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, in the order of the mixed documents."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # trees, shingle sets and tokens are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
