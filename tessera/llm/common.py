"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir, table

__all__ = ["column", "columns", "documents", "empty_text", "few", "materialize", "rows_per_split", "table"]

#: ``[^\x20\x09-\x0D]+``: a word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the session's shared checkpoint folder and read it back.

    It cuts the lineage with files that every executor sees, so later stages survive lost
    executors; each call takes a folder of its own, so no earlier lazy frame loses its files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns, cast: later steps can add names freely without clashes with
    what else the table holds. A missing column reads as null."""
    return df.select(*[(column(df, c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])


def column(df: DataFrame, name: str):
    return df[f"`{name}`"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def empty_text(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def rows_per_split(spark: SparkSession, rows: int, per: int, least: int = 1) -> int:
    """How many splits hold ``rows`` rows at ``per`` rows each: parallelism follows the data."""
    return max(least, -(-rows // per))


#: Rows of a few numbers that one task handles.
FEW_ROWS = 400_000


def few(df: DataFrame, rows: int, per: int = FEW_ROWS) -> DataFrame:
    """``df`` in tasks of ``per`` of its ``rows`` rows: what a shuffle left in many small parts is not handled by as many tasks.
    More rows make more tasks."""
    return df.coalesce(max(1, -(-rows // per)))


LONG, INT, DOUBLE, STRING, BINARY = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BinaryType()
