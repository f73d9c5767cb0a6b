"""Operator 9 - document quality by histogram gradient-boosted trees over statistics of whole texts.

One pass computes the statistics of every document (written once, a few numbers a row); a bounded
sample of labelled rows fits the trees on the driver; the flattened trees score all rows in tasks.

Defined results: null and empty texts have all-zero statistics and the score of those; a null doc_id
is scored and never learned from; without labels every score is that of the prior; repeated rows score
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.boosting import Trees, fit
from tessera.llm.common import columns, materialize

#: The most labelled rows that a fit collects (the bound of the sample), and the deciding score.
SAMPLE, THRESHOLD = 20_000, 0.7

#: Byte classes whose share of the text is a feature.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?",
            b"|", b"%#*$&^~", b"@", b"<>{}[]()", b"=+_\\/", b"'\"`", b"-", b":;", bytes(range(9)) + bytes(range(14, 32)), bytes(range(128, 256))]
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES):
    _TABLE[list(_bytes), _k] = 1.0
WIDTH = len(_CLASSES) + 17


def statistics(text: str) -> list[float]:
    """Shares of byte classes; lengths; repetition of words and lines; shapes of words and lines."""
    raw = text.encode("utf-8", "replace")
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    if not words:
        return [0.0] * WIDTH
    share = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE / len(raw)
    n, counts = len(words), Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    line_counts, line_words = Counter(lines), [x.count(" ") + 1 for x in lines]
    again = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in ".!?" for w in words)
    return [*share, np.log1p(n), np.log1p(len(raw)), np.log1p(len(lines)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
            (lengths == 1).sum() / n, (lengths > 12).sum() / n, len(counts) / n, max(counts.values()) / n, again / n,
            len(line_counts) / len(lines), max(line_counts.values()) / len(lines), np.log1p(max(line_words)), n / len(lines),
            ends / n, sum(x[-1] in ".!?:;\"'" for x in lines) / len(lines)]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = [np.asarray(statistics(t or ""), dtype=np.float32) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "stats": stats})

    return columns(docs, doc_id="long", text="string").mapInPandas(run, "doc_id long, stats array<float>")


def remainder() -> Column:
    """What splits learned from held-out documents; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % 4


def sample_rows(rows: DataFrame, most: int) -> pd.DataFrame:
    """At most ``most`` of ``rows`` (doc_id, ...), spread by a hash of the id, on the driver."""
    n = rows.count()
    spread = F.xxhash64("doc_id", F.lit(9))
    if n > most:  # a little more than needed passes, so that few rows are sorted
        rows = rows.filter(F.pmod(spread, F.lit(1 << 20)) < min(1.0, 1.2 * most / n + 64 / n) * (1 << 20))
    return rows.orderBy(spread, "doc_id").limit(most).toPandas()


def fit_quality(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from at most ``sample`` labelled rows that are not held out."""
    marked = columns(labels, doc_id="long", quality="int").filter("quality in (0, 1)").filter(remainder() != 2)
    rows = sample_rows(stats.join(marked, "doc_id").select("doc_id", "quality", "stats"), sample)
    x = np.array(rows["stats"].tolist(), dtype=np.float32).reshape(len(rows), WIDTH)
    return fit(x, rows["quality"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    stats = materialize(measured(docs), "quality-stats")
    trees = fit_quality(stats, labels, sample)
    return scored(stats.withColumn("held_out", F.coalesce(remainder() == 2, F.lit(False))), trees, threshold).select(
        "doc_id", "held_out", "score", "predicted")


def scored(rows: DataFrame, trees: Trees, threshold: float) -> DataFrame:
    """``rows`` (doc_id, stats, held_out) with score and predicted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["stats"].tolist(), dtype=np.float32).reshape(len(batch), WIDTH)
            p = trees.probability(x)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": p, "predicted": (p >= threshold).astype(np.int32)})

    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``. Only the sampled labels meet
    their documents before the fit, and whole texts are not shuffled."""
    marked = columns(labels, doc_id="long", quality="int").filter("quality in (0, 1)").filter(remainder() != 2)
    chosen = docs.sparkSession.createDataFrame(sample_rows(marked, sample), "doc_id long, quality int")
    # At most ``sample`` rows of two numbers.
    texts = columns(docs, doc_id="long", text="string").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    trees = fit_quality(measured(texts), chosen, sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        for batch in batches:
            x = np.array([statistics(t or "") for t in batch.column("text").to_pylist()], dtype=np.float32).reshape(batch.num_rows, WIDTH)
            yield batch.filter(pa.array(trees.probability(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
