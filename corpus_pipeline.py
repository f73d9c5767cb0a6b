"""A training corpus from ``documents``: good documents in a known language, one of each group of near
copies, sources mixed to their weights, packed into sequences.

Every stage works on all rows that its predecessor kept, written as Parquet between stages. All but
the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import documents, materialize, table
from tessera.llm.language import keep_known
from tessera.llm.mixing import mixed_documents
from tessera.llm.near_dedup import keep_one
from tessera.llm.packing import pack, pieces, tokenizer_path
from tessera.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that score at least 0.7 stay; learned from ``labels``."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents whose language is not told (no letters) go."""
    return keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near copies the smallest doc_id stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the mix of sources takes it (0 to 2 times)."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of sequences of at most 2048 ids."""
    return pack(pieces(docs, tokenizer_path()))


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: The stages learn models and compare hashed sets; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
