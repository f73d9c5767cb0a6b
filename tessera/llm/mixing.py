"""Operator 1 - mixing sources to target weights (DataFrame operations only).

Each source is a stream of its words: its documents in a shuffled order (a hash of id and text), cut
into blocks of equally many words. A low-discrepancy schedule decides which source fills each slot of
the mix: slot i has the golden-ratio point frac(i * phi), the point falls into one source's interval of
the cumulative weights, and the slot's rank among the slots of its source names the block (epochs
repeat the stream). The last slot of a source ends at its target, so a source gives exactly its target,
rounded to a word. Slots beyond what a source needs go to the sources that are still short.

Defined results: a null text has size 0; a null source is a source of its own, after the others;
documents of size 0 and sources without words get 0; identical rows follow one another; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, columns, empty_text, materialize, rows_per_split

#: Words in a block; rows whose running sum one window takes; slots ranked in one window.
BLOCK_WORDS, SPLIT_ROWS, SLOT_CHUNK = 2048, 20_000, 1 << 16
#: Cells of [0, 1) by which points meet the sources' intervals in an equi-join.
CELLS = 4096
GOLDEN = 0.6180339887498949
_CHUNK_STEP = (SLOT_CHUNK * 0.6180339887498948482) % 1.0


def document_key() -> Column:
    """The shuffled order of documents: a hash of id and whole text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(empty_text())))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) of every document."""
    return columns(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        document_key().alias("key"))


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``sizes`` (source, source_size) -> with rank ``sr``, weight ``w`` and ``target``.

    The targets share ``share`` times all words by weight; none exceeds ``most`` times its source.
    With sources in ascending order of cap by weight, the common level is fixed by the first source
    that stays under its cap when all before it are at theirs."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("sr", F.row_number().over(by_source) - 1)
    t = t.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("sr") % len(weights) + 1).cast("int")).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", "sr")
    everything = Window.partitionBy()
    t = t.withColumn("level", (share * F.sum("source_size").over(everything) - (F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")))
                     / F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
    # The levels of sources under their cap start with the first of them, in ascending order of ratio.
    under = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sr", "level"))
    t = t.withColumn("level", F.min(under).over(everything)["level"])
    return t.select("source", "source_size", "sr", "w", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def schedule(need: DataFrame, slots: int) -> DataFrame:
    """``need`` (sr, need: blocks the mix takes of the source) -> (slot, sr, rank), ranks 0 to need-1."""
    spark = need.sparkSession
    upto = F.sum("need").over(Window.orderBy("sr"))
    parts = need.filter("need > 0").select("sr", "need", ((upto - F.col("need")) / slots).alias("lo"), (upto / slots).alias("hi"), (upto == slots).alias("last"))
    cells = parts.select("sr", "lo", F.when(F.col("last"), 2.0).otherwise(F.col("hi")).alias("hi"), F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / SLOT_CHUNK).alias("chunk"), (F.col("id") % SLOT_CHUNK).alias("at"))
    point = (F.col("chunk") * F.lit(_CHUNK_STEP)) % 1.0 + (F.col("at") * F.lit(GOLDEN)) % 1.0
    points = points.withColumn("u", point % 1.0).withColumn("cell", F.floor(F.col("u") * CELLS))
    drawn = points.join(cells, "cell").filter("u >= lo and u < hi").select("slot", "chunk", "sr")
    counts = drawn.groupBy("sr", "chunk").count()
    counts = materialize(counts.withColumn("before", F.sum("count").over(Window.partitionBy("sr").orderBy("chunk")) - F.col("count")), "mix-counts")
    rank = F.row_number().over(Window.partitionBy("sr", "chunk").orderBy("slot")) - 1 + F.col("before")
    ranked = drawn.join(counts.drop("count"), ["sr", "chunk"]).withColumn("rank", rank).select("slot", "sr", "rank")
    ranked = ranked.join(need, "sr").filter("rank < need").select("slot", "sr", "rank")
    drawn_of = counts.groupBy("sr").agg(F.sum("count").alias("drawn"))
    short = (need.join(drawn_of, "sr", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
             .filter("drawn < need").select("sr", F.explode(F.expr("sequence(drawn, need - 1)")).alias("rank")))
    tail = short.select((F.row_number().over(Window.orderBy("rank", "sr")) - 1 + slots).alias("slot"), "sr", "rank")
    return ranked.unionByName(tail)


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2,
        block: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, key, sr, size, source_size, target) and the pieces of the mix (slot, sr,
    epoch, row, doc_id, start, length): in slot order, then by (epoch, start in the stream), they are it."""
    rows = materialize(sized(docs).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    sources = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
                          .withColumn("words", F.floor(F.col("target") + 0.5)), "mix-sources")
    splits = rows_per_split(rows.sparkSession, rows.count(), SPLIT_ROWS)
    rows = rows.withColumn("split", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * splits / (1 << 32)))
    # Null-safe, so that the null source meets its own row.
    rows = rows.join(sources.select(F.col("source").alias("_s"), "sr", "source_size", "target", "words"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    before = rows.groupBy("sr", "split").agg(F.sum("size").alias("words_here"))
    before = before.select("sr", "split", (F.sum("words_here").over(Window.partitionBy("sr").orderBy("split")) - F.col("words_here")).alias("before"))
    running = F.sum("size").over(Window.partitionBy("sr", "split").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, 0))
    placed = materialize(rows.join(before, ["sr", "split"]).withColumn("begin", F.col("before") + running - F.col("size")).drop("split", "before"), "mix-placed")

    plan = sources.select(
        "sr", "source_size", F.expr("case when source_size > 0 then words div source_size else 0 end").alias("epochs"),
        F.expr("case when source_size > 0 then words % source_size else 0 end").alias("rest"),
        F.ceil(F.col("source_size") / block).alias("blocks"))
    plan = plan.withColumn("need", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block))
    slots = plan.agg(F.sum("need")).first()[0] or 0
    wanted = schedule(plan.select("sr", "need"), slots) if slots else rows.sparkSession.createDataFrame([], "slot long, sr int, rank long")
    wanted = wanted.join(plan, "sr").select(
        "sr", "slot", F.expr("rank div blocks").alias("epoch"), F.expr("rank % blocks").alias("block"),
        F.expr("case when rank div blocks = epochs then rest else source_size end").alias("until"))
    cut = placed.filter("size > 0").select(
        "row", "doc_id", "sr", "size", "begin", F.explode(F.expr(f"sequence(begin div {block}, (begin + size - 1) div {block})")).alias("block"))
    pieces = cut.join(wanted, ["sr", "block"]).select(
        "slot", "sr", "epoch", "row", "doc_id", "begin", F.greatest("begin", F.col("block") * block).alias("lo"),
        F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block, "until").alias("hi"))
    pieces = pieces.filter("hi > lo").select("slot", "sr", "epoch", "row", "doc_id", (F.col("lo") - F.col("begin")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"))
    return placed.select("row", "doc_id", "key", "sr", "size", "source_size", "target"), pieces


def taken(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """``rows`` of mix() with ``taken``: the words that the mix takes of each, repeats counted."""
    words = pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    return rows.join(words, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it (its words taken by its size,
    rounded). Rows that are alike share what the mix takes of them."""
    rows, pieces = mix(docs, **settings)
    often = taken(rows, pieces).groupBy("key").agg(F.floor(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1)) + 0.5).alias("_often"))
    often = often.filter("_often > 0").withColumnRenamed("key", "_key")
    keyed = docs.withColumn("_key", document_key_of(docs))
    return keyed.join(often, "_key").withColumn("_n", F.explode(F.expr("sequence(1L, _often)"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def document_key_of(docs: DataFrame) -> Column:
    """document_key() on the columns as the table has them."""
    return F.md5(F.concat(F.coalesce(docs["doc_id"].cast("long").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(docs["text"], F.lit("")))))


#: DuckDB: in shuffled order, a source gives its first words; it needs no schedule to say which.
MIX_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sr FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(sr % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
r AS (SELECT *, cap / w AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT - ((sum(cap) OVER up)::BIGINT - cap)) / (sum(w) OVER down)::BIGINT AS level FROM r
      WINDOW up AS (ORDER BY ratio, sr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             down AS (ORDER BY ratio, sr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, (ratio, sr)) FROM l WHERE level <= ratio) * w) AS target FROM l),
p AS (SELECT d.*, source_size, target, floor(target + 0.5)::BIGINT AS words,
             (sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS begin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size + greatest(0, least(size, words % source_size - begin)) END::BIGINT AS taken
FROM p
"""
