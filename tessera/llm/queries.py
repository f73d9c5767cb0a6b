"""The queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, table
from tessera.llm.line_rules import RULES_SQL
from tessera.llm.mixing import MIX_SQL

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_workers(fn):
    """``fn``, with this package's place on the path of the Python workers, as the driver has it."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)
        return fn(spark, sf_dir)

    return run


def query(fn):
    QUERIES[fn.__name__] = with_workers(fn)
    return QUERIES[fn.__name__]


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes; equal texts share a shard."""
    from tessera.llm.sharding import shard
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: how many words of each the mix of sources takes."""
    from tessera.llm.mixing import mix, taken
    return taken(*mix(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op1_mixing"] = MIX_SQL


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 ids."""
    from tessera.llm.packing import pack, pieces, tokenizer_path
    return pack(pieces(documents(spark, sf_dir), tokenizer_path()))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    from tessera.llm.language import identify
    return identify(documents(spark, sf_dir))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents."""
    from tessera.llm.quality import score
    return score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from tessera.llm.near_dedup import near_duplicates
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are."""
    from tessera.llm.fingerprints import fingerprints
    return fingerprints(documents(spark, sf_dir))


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found, by inner product, of every vector whose id 20 divides."""
    from tessera.llm.neighbours import search
    return search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    from tessera.llm.extraction import extract
    return extract(table(spark, sf_dir, "pages"))


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of the raw transcripts of all conversations, roles recovered, rendered canonically."""
    from tessera.llm.chat import recover
    return recover(table(spark, sf_dir, "conversations"))


def _periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's planted runs: of each tenth document, by crc32 of its id, the words from one on repeat."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


@query
def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of all documents, runs planted in a tenth of them."""
    from tessera.llm.periodicity import periodic_runs, strongest
    found = periodic_runs(documents(spark, sf_dir), _periodic).withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules and the frequency of lines over all documents."""
    from tessera.llm.line_rules import judged
    return judged(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


ORACLES["op12_line_rules"] = RULES_SQL


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of all conversations, their rows damaged by a fixed rule."""
    from tessera.llm.repair import damaged, digests, repaired
    return digests(repaired(damaged(table(spark, sf_dir, "conversations"))))
