"""Operator 12 - quality rules: words and lines of each document, and lines that many documents of a host share.

Each non-blank line is normalised (A-Z in lower case, digit runs as 0, blanks as one space) and hashed to 128 bits. Counted are the documents of
a host (``source``) that hold a line, texts that are alike counting once. A line goes from a host's documents if more
than ``LINE_DOCS`` and more than ``LINE_PERCENT`` % of the host's distinct texts hold it. A document is depleted, and rejected, if fewer
than ``LEFT_PERCENT`` % of its words or fewer than ``LEFT_WORDS`` words remain. Documents that fail the rules on themselves are rejected
whatever their lines.

Counting is a partial aggregation in every task, by (host, line, text) and then by (host, line); a common line is a
few rows of partial counts. Lines above the limits are at most 100 / LINE_PERCENT times the mean number of lines of a
host's texts; they are broadcast while measured small and otherwise joined on (host, line, salt), so no line meets in one task.

Defined results: null, empty and blank texts have no words and fail the base rules; a null host is a host of its own;
each repeated row is judged alike and counts once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, materialize
from tessera.llm.words import joined, parts, word_hashes

#: Limits of a line: distinct texts of its host that hold it, at the same time in number and in per cent.
LINE_DOCS, LINE_PERCENT = 20, 5
#: What must remain of a document: per cent of its words, and words.
LEFT_PERCENT, LEFT_WORDS = 50, 10
#: Base rules: fewest words, and most per cent of words in repeated windows of WINDOW words.
LEAST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
#: Lines above the limits up to which they are broadcast (40 bytes each), and salts beyond.
BROADCAST_LINES, SALTS = 200_000, 32

_DIGITS = re.compile(rb"[0-9]+")
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANKS = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Bytes that begin a code point of a word.
_OPENS = ((np.arange(256) & 0xC0) != 0x80) & ~_BLANKS

MEASURED = ("doc_id long, host string, text_key binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "lines array<struct<line:binary,words:long>>")
_LINE = pa.struct([("line", pa.binary()), ("words", pa.int64())])


def line_key(words: list[bytes]) -> bytes:
    """128 bits of a line's normalised words."""
    return xxhash.xxh3_128_digest(_DIGITS.sub(b"0", b" ".join(words).lower()))


def repeat_words(ids: np.ndarray, begins: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each document of a part, how many of its words lie in a window of ``window`` words that occurs in it twice or more."""
    n = len(ids)
    if n < window:
        return np.zeros(len(begins) - 1, dtype=np.int64)
    w = word_hashes(ids, begins)
    h = w[:n - window + 1]
    for k in range(1, window):
        h = joined(h, w[k:n - window + 1 + k])
    until = np.repeat(begins[1:], np.diff(begins))
    at = np.flatnonzero(np.arange(len(h)) + window <= until[:len(h)])
    order = np.argsort(h[at], kind="stable")
    hs = h[at][order]
    same = hs[1:] == hs[:-1]
    twice = np.zeros(len(hs), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(n + 1, dtype=np.int64)
    at = at[order[twice]]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[begins[1:]] - covered[begins[:-1]]


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each row of ``docs`` (doc_id, text, source), a key of its text, and its distinct lines with their words."""

    def own(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[bytes]]]:
        for doc_id, host, text in zip(batch.column("doc_id").to_pylist(), batch.column("host").to_pylist(), batch.column("text")):
            text = text.as_py() or b""
            words, full, lines = [], [], Counter()
            for line in text.split(b"\n"):
                in_line = line.split()
                if in_line:
                    words += in_line
                    full.append(line)
                    lines[line_key(in_line)] += len(in_line)
            count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            yield (doc_id, host, xxhash.xxh3_128_digest(text), int(count[_OPENS].sum()), int(count[_SYMBOLS].sum()),
                   len(full) - len(set(full)), [{"line": k, "words": v} for k, v in lines.items()]), words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, ids, begins in parts(own(batch)):
                doc_id, host, key, chars, symbols, dup, lines = zip(*(k for k, _ in held))
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_id, pa.int64()), pa.array(host, pa.string()), pa.array(key, pa.binary()), pa.array(np.diff(begins)),
                    pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()), pa.array(dup, pa.int64()), pa.array(repeat_words(ids, begins)),
                    pa.array(lines, pa.list_(_LINE))],
                    ["doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    rows = columns(docs, doc_id="long", source="string", text="string").select("doc_id", F.col("source").alias("host"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, MEASURED)


def common_lines(rows: DataFrame, line_docs: int = LINE_DOCS, line_percent: int = LINE_PERCENT) -> DataFrame:
    """(host, line) of the lines above the limits; a null host reads as a host. ``rows`` as ``measured`` gives them."""
    texts = rows.filter("n_words > 0").select("host", F.col("host").isNull().alias("no_host"), "text_key", "lines").withColumn("host", F.coalesce("host", F.lit("")))
    held = texts.select("host", "no_host", "text_key", F.explode("lines.line").alias("line")).distinct()
    held = held.groupBy("host", "no_host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > line_docs)
    sizes = texts.select("host", "no_host", "text_key").distinct().groupBy("host", "no_host").agg(F.count("*").alias("texts"))
    return held.join(sizes, ["host", "no_host"]).filter(F.col("n") * 100 > F.col("texts") * line_percent).select("host", "no_host", "line")


def judged(docs: DataFrame, line_docs: int = LINE_DOCS, line_percent: int = LINE_PERCENT, left_percent: int = LEFT_PERCENT,
           left_words: int = LEFT_WORDS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """Every row of ``docs`` with its counts, ``removed_words`` (in lines above the limits), ``base_failed`` and ``kept``."""
    rows = materialize(measured(docs).withColumn("row", F.monotonically_increasing_id()), "line-rows")
    common = materialize(common_lines(rows, line_docs, line_percent), "line-common")
    n = common.count()
    lines = rows.select("row", F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"), F.explode("lines").alias("own"))
    lines = lines.select("row", "host", "no_host", "own.line", "own.words")
    on = ["host", "no_host", "line"]
    if n <= broadcast_lines:
        met = lines.join(F.broadcast(common), on)
    else:
        salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = lines.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, [*on, "salt"])
    removed = met.groupBy("row").agg(F.sum("words").alias("removed"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    counts = rows.drop("lines", "text_key").join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed", F.lit(0))).drop("removed", "row")
    return counts.withColumn("base_failed", base).withColumn(
        "kept", ~base & (100 * left >= left_percent * F.col("n_words")) & (left >= left_words))


#: The same in DuckDB: normalised lines stand for their hashes.
RULES_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
t AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT row, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
             regexp_replace(translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS norm
      FROM t),
full_lines AS (SELECT * FROM l WHERE words > 0),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY row),
held AS (SELECT d.host, d.no_host, f.norm, count(DISTINCT d.text) AS n FROM full_lines f JOIN d USING (row) GROUP BY ALL),
sizes AS (SELECT host, no_host, count(DISTINCT text) AS texts FROM d WHERE regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY ALL),
common AS (SELECT host, no_host, norm FROM held JOIN sizes USING (host, no_host) WHERE n > {LINE_DOCS} AND n * 100 > texts * {LINE_PERCENT}),
removed AS (SELECT f.row, sum(f.words) AS words FROM full_lines f JOIN d USING (row) JOIN common c ON c.host = d.host AND c.no_host = d.no_host AND c.norm = f.norm GROUP BY f.row),
w AS (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT row, i, CASE WHEN lead(i, {WINDOW - 1}) OVER (PARTITION BY row ORDER BY i) IS NOT NULL THEN
             word || ' ' || lead(word, 1) OVER (PARTITION BY row ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY row ORDER BY i) || ' ' ||
             lead(word, 3) OVER (PARTITION BY row ORDER BY i) || ' ' || lead(word, 4) OVER (PARTITION BY row ORDER BY i) END AS gram FROM p),
k AS (SELECT row, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY row, gram) > 1 AS twice FROM g),
c AS (SELECT row, max(CAST(twice AS INT)) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS covered FROM k),
r AS (SELECT row, sum(covered) AS n_repeat_words FROM c GROUP BY row),
s AS (SELECT d.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(removed.words, 0) AS BIGINT) AS removed_words
      FROM d JOIN w USING (row) LEFT JOIN dup USING (row) LEFT JOIN r USING (row) LEFT JOIN removed USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words) AND 100 * (n_words - removed_words) >= {LEFT_PERCENT} * n_words
       AND n_words - removed_words >= {LEFT_WORDS} AS kept, removed_words
FROM s
"""
