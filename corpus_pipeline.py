"""The corpus pipeline: documents that a classifier keeps, without copies, mixed and packed.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. In every stage null texts are empty ones, rows are told apart by a
key of their own, so that doc_ids may be null or repeated, other columns may have any names, and an
empty table gives an empty one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm import exact_dedup, mixing, near_copies, packing, quality
from brookmart.llm.common import materialise, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither toxic nor of low quality, each judged by its own text."""
    return quality.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts exactly one row, that with the smallest doc_id; a null doc_id is the largest."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, that with the smallest doc_id; rows without a doc_id stay."""
    return near_copies.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their targets; documents may come twice or in part."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack(docs, packing.contract_bpe, keep_ids=False).select(*packing.COLUMNS)


STAGES = [("quality", classify), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix), ("packing", pack)]

#: The classifier, the fingerprints and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
