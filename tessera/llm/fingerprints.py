"""Operator 4 - document fingerprints by invertible Bloom lookup sketches (DataFrame operations only).

A text is a set of paragraph digests: 64-bit hashes of its sentences and lines; long ones are parted where
the hash of a word (or of a letter, in scripts without blanks) says so, so that a change stays local. A sketch has three
tables of cells; a digest goes to one cell of each, where counts add up and digests and their check
hashes are xor-ed. The sketches of two versions are subtracted cell by cell, so what they share
vanishes, and peeling recovers the differing digests: a cell that holds exactly one digest gives it up,
and it is taken out of its two other cells, table after table. What does not peel is tried again in
larger sketches with other hash functions. Likeness is shared digests / all digests.

Cells are rows of (document, table, cell) and every step is an aggregation of long integers within the
partition that already holds the document, so sketches of any size cost neither a shuffle nor a large row.

Defined results: a null text is an empty one; two texts without paragraphs are alike (1.0); rows
with the same doc_id follow one another by a hash of their texts; null doc_ids come last; a
single row is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, empty_text, materialize

#: Cells in each of the three tables of a stored fingerprint; of a first comparison, at least and for
#: each digest; passes over the three tables while peeling.
PRINT_CELLS, LEAST_CELLS, LOAD, PASSES = 8, 32, 0.75, 5
#: Bytes of text in one range of ids, the least number of ranges, and the quantiles that place them.
RANGE_BYTES, LEAST_RANGES, QUANTILES = 2 << 20, 64, 64
PARAGRAPHS = r"\n+|(?<=[.!?])[ \t]+|(?<=[。．｡！？])(?![。．｡！？])[ \t\u3000]*"
#: Paragraphs of more characters than LONG are parted: after one in EVERY words, and at MOST characters. Words end
#: before what follows blanks and marks; in scripts that are written without blanks each letter is one.
LONG, EVERY, MOST = 256, 12, 128
_MARKS = r"\s,;:/|&=(){}\[\]<>、，；："
WORD_ENDS = rf"(?<=[{_MARKS}])(?=[^{_MARKS}])|(?<=[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\p{{IsThai}}\p{{IsLao}}\p{{IsKhmer}}\p{{IsMyanmar}}])"


def paragraph_digests(text: Column) -> Column:
    """The distinct digests of a text's sentences and lines, and of the parts of long ones."""
    parts = F.flatten(F.transform(F.split(text, PARAGRAPHS), lambda p: F.when(F.length(p) > LONG, _parts(p)).otherwise(F.array(p))))
    parts = F.filter(parts, lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _parts(paragraph: Column) -> Column:
    """A paragraph, which has no line end, cut at places that its own words fix."""
    ended = F.transform(F.split(paragraph, WORD_ENDS), lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(EVERY)) == 0, F.concat(w, F.lit("\n"))).otherwise(w))
    return F.regexp_extract_all(F.array_join(ended, ""), F.lit(rf"[^\n]{{1,{MOST}}}"), F.lit(0))


def _cell(digest: str, table: int, attempt: int) -> str:
    return f"cast(pmod(xxhash64({digest}, {3 * attempt + table}), cells) as int)"


def _check(digest: str) -> str:
    return f"xxhash64({digest}, 77L)"


def cells_of(rows: DataFrame, keys: list[str], attempt: int) -> DataFrame:
    """Sketch cells (keys, t, c, n, k, x) of ``rows`` (keys with cells, n: +1 or -1, k: digest). A sketch
    is subtracted by counts of opposite sign, as xor undoes itself. Rows with cells = 0 pass as t = 9."""
    places = ", ".join(f"named_struct('t', {t}, 'c', {_cell('k', t, attempt)})" for t in range(3))
    placed = rows.withColumn("at", F.explode(F.expr(f"if(cells = 0, array(named_struct('t', 9, 'c', 0)), array({places}))")))
    return _added(placed.select(*keys, "at.t", "at.c", "n", "k", F.expr(_check("k")).alias("x")), keys)


def _added(cells: DataFrame, keys: list[str]) -> DataFrame:
    sums = F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x")
    return cells.groupBy(*keys, "t", "c").agg(*sums).filter("t >= 3 or n != 0 or k != 0 or x != 0")


def peel(sketch: DataFrame, keys: list[str], attempt: int, passes: int, only: str = "true") -> DataFrame:
    """Peels each keyed sketch that ``only`` selects. Rows of t = 3 count the recovered digests (c = 0:
    of the first version alone, 1: of the second); rows of t < 3 are cells that did not peel."""
    for step in range(3 * passes):
        t = step % 3  # a digest is in one cell of a table, so no two cells give it up at once
        single = f"{only} and t = {t} and n in (1, -1) and x = {_check('k')} and c = {_cell('k', t, attempt)}"
        itself = "named_struct('t', t, 'c', c, 'n', n, 'k', k, 'x', x)"
        taken = ", ".join(f"named_struct('t', {o}, 'c', {_cell('k', o, attempt)}, 'n', -n, 'k', k, 'x', x)" for o in range(3) if o != t)
        found = "named_struct('t', 3, 'c', if(n = 1, 0, 1), 'n', 1L, 'k', 0L, 'x', 0L)"
        sketch = sketch.withColumn("s", F.explode(F.expr(f"if({single}, array({taken}, {found}), array({itself}))")))
        sketch = _added(sketch.select(*keys, "s.*"), keys)
    return sketch


def _ranges(docs: DataFrame) -> tuple[Column, int]:
    """The range of ids that a row (doc_id, h) is in, in descending order of id, and their number.

    Ranges split the spans between quantiles evenly; null ids, which come last, go by their hash."""
    spark = docs.sparkSession
    at = [i / QUANTILES for i in range(1, QUANTILES)]
    lo, hi, cuts, size = docs.agg(F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", at, 4000), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()
    each = max(LEAST_RANGES, -(-(size or 0) // RANGE_BYTES))
    each = -(-each // QUANTILES)
    if lo is None:
        edges = []
    else:
        edges = sorted({lo, *cuts, hi + 1}, reverse=True)
    # (first, last, number) of each span, highest ids first.
    spans = [(b, a - 1) for a, b in zip(edges, edges[1:])]
    nulls = len(spans) * each

    def pick(spans_: list[tuple[int, int]], first: int) -> Column:
        if len(spans_) > 1:
            half = len(spans_) // 2
            return F.when(F.col("doc_id") >= spans_[half - 1][0], pick(spans_[:half], first)).otherwise(pick(spans_[half:], first + half))
        low, high = spans_[0]
        within = F.expr(f"cast(floor(({high}D - doc_id) * {each} / {float(high - low + 1)}D) as int)")
        return F.greatest(F.lit(0), F.least(within, F.lit(each - 1))) + first * each

    null = F.expr(f"cast(floor((h / 18446744073709551616D + 0.5D) * {each}) as int)")
    null = F.least(null, F.lit(each - 1)) + nulls
    if not spans:
        return null, each
    return F.when(F.col("doc_id").isNull(), null).otherwise(pick(spans, 0)), nulls + each


def versions(docs: DataFrame) -> DataFrame:
    """(bucket, rn, doc_id, text, next_text) of every row, by bucket: each row with the text of the next
    row in descending order of id, the last with that of the first.

    The texts move once, to ranges of ids; a range also gets a copy of the first row of the next one."""
    rows = columns(docs, doc_id="long", text="string").select("doc_id", empty_text().alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    bucket, n = _ranges(rows)
    rows = rows.withColumn("bucket", bucket)
    # Each range's first row, as the follower of the range before it (of the last one, for the first).
    order = F.struct(F.col("doc_id").isNull().alias("z"), (-F.col("doc_id").cast("decimal(20,0)")).alias("d"), F.col("h").alias("h"))
    firsts = rows.groupBy("bucket").agg(F.min(order).alias("o"))
    ring = F.lag("bucket").over(Window.orderBy("bucket"))
    last = F.max("bucket").over(Window.partitionBy())
    firsts = materialize(firsts.select(F.coalesce(ring, last).alias("into"), (-F.col("o.d")).cast("long").alias("_id"), F.col("o.h").alias("_h")), "print-firsts")
    copies = rows.join(F.broadcast(firsts) if n <= 20_000 else firsts, rows["doc_id"].eqNullSafe(firsts["_id"]) & (rows["h"] == firsts["_h"]))
    copies = copies.select("doc_id", "text", "h", F.col("into").alias("bucket"), F.lit(True).alias("copy"))
    both = rows.select("doc_id", "text", "h", "bucket", F.lit(False).alias("copy")).unionByName(copies)
    w = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), "h")
    both = both.repartition(max(n // 2, 1), "bucket")
    both = both.select("bucket", F.row_number().over(w).alias("rn"), "doc_id", "text", F.lead("text").over(w).alias("next_text"), "copy")
    return both.filter(~F.col("copy")).drop("copy")


def _near(na: Column, nb: Column, only_a: Column) -> Column:
    shared = na - only_a
    return F.when(na + nb == 0, 1.0).otherwise(shared / (na + nb - shared))


def _size(a: str, b: str, load: float) -> str:
    """Cells of a table for two sets that may differ in all their digests."""
    return f"cast(greatest({LEAST_CELLS}, ceil({load}D * (size({a}) + size({b})))) as int)"


def compare(pairs: DataFrame, keys: list[str], load: float = LOAD, passes: int = PASSES, attempts: int = 8, first: int = 0) -> DataFrame:
    """``pairs`` (keys, a, b: arrays of distinct digests) -> (keys, near). Sketches that do not peel are
    made again four times as large with other hash functions."""
    done, pairs = [], pairs.select(*keys, "a", "b")
    for attempt in range(first, first + attempts):
        sized = pairs.withColumn("cells", F.expr(_size("a", "b", load * 4 ** attempt)))
        side = F.explode(F.array(F.struct(F.lit(1).cast("long").alias("n"), F.col("a").alias("ks")), F.struct(F.lit(-1).cast("long").alias("n"), F.col("b").alias("ks"))))
        rows = sized.select(*keys, "cells", side.alias("s")).select(*keys, "cells", "s.n", F.explode("s.ks").alias("k"))
        own = [*keys, "cells"]
        left = peel(cells_of(rows, own, attempt), own, attempt, passes).groupBy(*keys).agg(
            F.count_if(F.col("t") < 3).alias("open"), F.sum(F.expr("if(t = 3 and c = 0, n, 0L)")).alias("only_a"))
        tried = materialize(pairs.join(left, keys, "left").select(*keys, "a", "b", F.coalesce("open", F.lit(0)).alias("open"),
                            _near(F.size("a"), F.size("b"), F.coalesce("only_a", F.lit(0))).alias("near")), "print-tried")
        done.append(tried.filter("open = 0").select(*keys, "near"))
        pairs = tried.filter("open > 0").select(*keys, "a", "b")
        if pairs.isEmpty():
            return reduce(DataFrame.unionByName, done)
    raise ValueError(f"sketches did not peel in {attempts} attempts")


def fingerprints(docs: DataFrame, load: float = LOAD, passes: int = PASSES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    both = versions(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("third", F.expr("cast(n_chars div 3 as int)"))
    both = both.withColumn("edited", F.expr("concat(left(text, cast(n_chars as int) - third), left(next_text, third))"))
    both = both.select("bucket", "rn", "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"), paragraph_digests(F.col("text")).alias("a"),
                       paragraph_digests(F.col("edited")).alias("e"), paragraph_digests(F.col("next_text")).alias("x"))
    # What is known of a document travels as one row (what = -1) among the digests of its two comparisons
    # (0: edited, 1: next) and two prints (2, 3). All rows keep to the document's bucket, so that the
    # aggregations need no further exchange.
    head = F.struct("doc_id", "n_chars", "sha", "a", "e", "x")

    def part(what: int, cells: str, n: int, digests: str) -> Column:
        return F.struct(F.lit(what).alias("what"), F.expr(cells).alias("cells"), F.lit(n).cast("long").alias("n"), F.expr(digests).alias("ks"))

    parts = F.array(part(-1, "0", 0, "array(0L)"), part(0, _size("a", "e", load), 1, "a"), part(0, _size("a", "e", load), -1, "e"),
                    part(1, _size("a", "x", load), 1, "a"), part(1, _size("a", "x", load), -1, "x"),
                    part(2, str(PRINT_CELLS), 1, "a"), part(3, str(PRINT_CELLS), 1, "e"))
    rows = both.select("bucket", "rn", head.alias("all"), F.explode(parts).alias("p"))
    rows = rows.select("bucket", "rn", "p.what", "p.cells", F.when(F.col("p.what") < 0, F.col("all")).alias("head"), "p.n", F.explode("p.ks").alias("k"))
    keys = ["bucket", "rn", "what", "cells", "head"]
    cells = peel(cells_of(rows, keys, 0), keys, 0, passes, only="what in (0, 1)")
    cell = F.concat_ws(".", (F.col("t") * PRINT_CELLS + F.col("c")).cast("string"), F.col("n").cast("string"), F.lower(F.hex("k")), F.lower(F.hex(F.expr("x & 4294967295"))))

    def print_of(what: int) -> Column:
        return F.concat_ws("-", F.lit(f"{PRINT_CELLS}"), F.sort_array(F.collect_list(F.when(F.col("what") == what, cell))))

    def opened(what: int) -> Column:
        return F.count_if((F.col("what") == what) & (F.col("t") < 3))

    def only(what: int) -> Column:
        return F.sum(F.expr(f"if(what = {what} and t = 3 and c = 0, n, 0L)"))

    done = cells.groupBy("bucket", "rn").agg(F.max("head").alias("h"), print_of(2).alias("fingerprint"), print_of(3).alias("edited_fingerprint"),
                                             opened(0).alias("open_e"), opened(1).alias("open_x"), only(0).alias("only_e"), only(1).alias("only_x"))
    open_ = (F.col("open_e") > 0) | (F.col("open_x") > 0)
    done = done.select(
        "bucket", "rn", "h.doc_id", "h.n_chars", F.col("h.sha").alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        F.when(F.col("open_e") == 0, _near(F.size("h.a"), F.size("h.e"), F.col("only_e"))).alias("near_edited"),
        F.when(F.col("open_x") == 0, _near(F.size("h.a"), F.size("h.x"), F.col("only_x"))).alias("near_next"),
        F.when(open_, F.col("h.a")).alias("a"), F.when(F.col("open_e") > 0, F.col("h.e")).alias("e"), F.when(F.col("open_x") > 0, F.col("h.x")).alias("x"))
    done = materialize(done, "print-first")
    again = done.filter("near_edited is null or near_next is null")
    result = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    if again.isEmpty():
        return done.select(*result)
    pairs = again.filter("near_edited is null").select("bucket", "rn", F.lit(0).alias("what"), "a", F.col("e").alias("b")).unionByName(
        again.filter("near_next is null").select("bucket", "rn", F.lit(1).alias("what"), "a", F.col("x").alias("b")))
    near = compare(pairs, ["bucket", "rn", "what"], load, passes, first=1)
    near = near.groupBy("bucket", "rn").agg(F.max(F.expr("if(what = 0, near, null)")).alias("ne"), F.max(F.expr("if(what = 1, near, null)")).alias("nx"))
    again = again.join(near, ["bucket", "rn"]).withColumn("near_edited", F.coalesce("near_edited", "ne")).withColumn("near_next", F.coalesce("near_next", "nx"))
    return done.filter("near_edited is not null and near_next is not null").select(*result).unionByName(again.select(*result))
