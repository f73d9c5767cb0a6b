"""Span, annotation and sequence-structure operators.

Documents follow the M1 model: one row per document with ``tokens``,
``entities`` (array<struct<type,start,end>>, end exclusive) and ``relations``
(array<struct<type,head,tail>>, head/tail = positions in ``entities``).
``keys`` names the document key columns.

Work that is linear in one document (offsets, argument lookup by position) is
done with array functions inside the document row, without a shuffle. What
grows faster (candidate spans, pairs, occurrences of phrases) are rows: places
meet by equi-joins, and pairs are made block by block, so a long document
spreads over tasks and no row grows with the square of its length. Work that
relates rows of different tables (gold vs predicted, mentions vs tokens)
partitions by document.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import phrase, strip
from tessera.session import cut_lineage, ship


def _k(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def explode_rows(df: DataFrame, cols: list, arr: str, pos: str, val: str) -> DataFrame:
    """posexplode that never lets the optimizer push ``size(arr) > 0`` below
    the projection computing ``arr`` (that inferred filter would inline the
    array expression, and re-evaluate it inside lambdas): explode_outer, then
    drop the null rows of empty arrays."""
    e = df.select(*cols, F.posexplode_outer(arr).alias(pos, val))
    return e.filter(F.col(pos).isNotNull())


def dealt(docs: DataFrame, keys, *cols: str, parts: int | None = None) -> DataFrame:
    """Whole document rows with ``cols`` only, dealt by document: rows made of them that are then grouped or ordered by document (and
    more) stay where they are, so that one compact row a document moves and not one row a token, mention or relation."""
    keys = _k(keys)
    return docs.select(*keys, *cols).repartition(*([parts] if parts else []), *keys)


#: Tokens that one task takes where rows are made of them and ordered.
TASK_TOKENS = 500_000


def deal_parts(docs: DataFrame) -> int:
    """Into how many parts ``docs`` are dealt whose tokens become rows."""
    spark = docs.sparkSession
    tokens = docs.agg(F.sum(F.size("tokens").cast("long"))).first()[0] or 0   # one number
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-tokens // TASK_TOKENS))


def _no_null(cols) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def met(left: DataFrame, right: DataFrame, keys, on: list[str], outer: bool = False, listed: bool = False) -> DataFrame:
    """The equi-join of ``left`` and ``right`` on (keys, on), left's rows without a match too if ``outer``: left's columns and right's
    others (``listed``: as one array ``_rs`` of structs). Both are one table where a window over (keys, on) gives each row of left the rows of right, so that nothing moves
    if both were dealt alike by the document (a join would deal them by all its columns). The matches of one
    row are listed, so right is the side that repeats less."""
    keys = _k(keys)
    at = [*keys, *on]
    more = [c for c in right.columns if c not in at]
    l = left.select(*at, F.struct(F.lit(True).alias("_is"), *[c for c in left.columns if c not in at]).alias("_l"))  # noqa: E741
    r = right.filter(_no_null(at)).select(*at, F.struct(F.lit(True).alias("_is"), *more).alias("_r"))
    if not outer:
        l = l.filter(_no_null(at))  # noqa: E741
    both = l.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)).unionByName(r.withColumn("_l", F.lit(None).cast(l.schema["_l"].dataType)))
    both = both.withColumn("_rs", F.collect_list("_r").over(Window.partitionBy(*at))).filter(F.col("_l").isNotNull())
    if not outer:
        both = both.filter(F.size("_rs") > 0)
    if listed:
        return both.select(*[F.col(c) if c in at else F.col("_l")[c].alias(c) for c in left.columns], "_rs")
    both = both.select(*at, "_l", F.explode_outer("_rs").alias("_r"))
    return both.select(*[F.col(c) if c in at else F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_r")[c].alias(c) for c in more])


def met_listed(docs: DataFrame, left: str, right: str, on: tuple[str, str], take: dict[str, str], outer: bool = False) -> DataFrame:
    """``met`` inside the row: the elements of the list ``left`` meet those of the list ``right`` (both of structs) where left's int field
    on[0] equals right's on[1]; left's elements gain the fields ``take`` (name: field of right's)."""
    from tessera.functions.arrays import joined
    l_kind, r_kind = (docs.schema[c].dataType.elementType for c in (left, right))
    kind = T.StructType([*l_kind, *[T.StructField(n, r_kind[c].dataType) for n, c in take.items()]])
    return docs.withColumn(left, joined(left, right, on, take, kind.simpleString(), outer))


#: Keys that come again up to which they are broadcast.
BROADCAST_KEYS = 500_000


def gathered(docs: DataFrame, keys, *cols: str) -> DataFrame:
    """One row a key, nulls aside: (keys, cols), each of ``cols`` as the array of its values in all rows with the key, in any order. A row whose
    key comes once stays where it is: which keys come again is asked of the keys alone, and only the rows of those are dealt."""
    keys = _k(keys)
    d = docs.filter(_no_null(keys)).select(*keys, F.struct(*cols).alias("_row"))
    again = docs.filter(_no_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    n = again.count()   # one number
    one = d
    if n:
        again = F.broadcast(again) if n <= BROADCAST_KEYS else again
        one = d.join(again, keys, "left_anti")
    g = one.select(*keys, F.array("_row").alias("_rows"))
    if n:
        g = g.unionByName(d.join(again, keys, "left_semi").groupBy(*keys).agg(F.collect_list("_row").alias("_rows")))
    return g.select(*keys, *[F.col("_rows")[c].alias(c) for c in cols])


# ---- C29: explode documents into rows and back ------------------------------------

def to_mentions(docs: DataFrame, keys, with_tokens: bool = False, listed: bool = False) -> DataFrame:
    """The entities of documents as rows (keys, ent_idx, type, start, end), or as the list ``mentions`` of their document (``listed``)."""
    keys = _k(keys)
    extra = ["tokens"] if with_tokens else []
    if listed:
        own = F.transform("entities", lambda e, i: F.struct(i.cast("int").alias("ent_idx"), e["type"].alias("type"), e["start"].alias("start"), e["end"].alias("end")))
        return docs.select(*keys, *extra, own.alias("mentions"))
    e = explode_rows(docs, [*keys, *extra], "entities", "ent_idx", "e")
    return e.select(*keys, *extra, F.col("ent_idx").cast("int").alias("ent_idx"),
                    "e.type", "e.start", "e.end")


def to_relations(docs: DataFrame, keys) -> DataFrame:
    keys = _k(keys)
    r = explode_rows(docs, keys, "relations", "rel_idx", "r")
    return r.select(*keys, F.col("rel_idx").cast("int").alias("rel_idx"), "r.type", "r.head", "r.tail")


def relations_with_spans(docs: DataFrame, keys, more: list[str] = ()) -> DataFrame:
    """Relations with both argument spans, looked up by position inside the
    document row (no join), and the columns ``more`` of their document."""
    keys = _k(keys)
    r = explode_rows(docs, [*keys, "entities", *more], "relations", "rel_idx", "r")
    h = F.element_at("entities", F.col("r.head") + 1)
    t = F.element_at("entities", F.col("r.tail") + 1)
    return r.select(*keys, *more, F.col("rel_idx").cast("int").alias("rel_idx"),
                    F.col("r.type").alias("type"), F.col("r.head").alias("head"),
                    F.col("r.tail").alias("tail"),
                    h["start"].alias("hs"), h["end"].alias("he"), h["type"].alias("ht"),
                    t["start"].alias("ts_"), t["end"].alias("te"), t["type"].alias("tt"))


def to_docs(mentions: DataFrame, relations: DataFrame | None, keys, docs: DataFrame) -> DataFrame:
    """Rebuild documents from mention / relation rows (ordered by index):
    every row of ``docs`` (keys and other columns, one row a document), with
    empty lists where it has no mentions or relations."""
    keys = _k(keys)
    none = F.array().cast("array<struct<type:string,start:int,end:int>>")
    ents = mentions.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "ent_idx", "type", "start", "end"))).alias("_e"))
    ents = ents.select(*keys, F.transform("_e", lambda x: F.struct(
        x["type"].alias("type"), x["start"].alias("start"), x["end"].alias("end"))).alias("entities"))
    ents = docs.join(ents, keys, "left").withColumn("entities", F.coalesce(F.col("entities"), none))
    if relations is None:
        return ents
    rels = relations.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "rel_idx", "type", "head", "tail"))).alias("_r"))
    rels = rels.select(*keys, F.transform("_r", lambda x: F.struct(
        x["type"].alias("type"), x["head"].alias("head"), x["tail"].alias("tail"))).alias("relations"))
    empty = F.array().cast("array<struct<type:string,head:int,tail:int>>")
    return ents.join(rels, keys, "left").withColumn(
        "relations", F.coalesce(F.col("relations"), empty))


# ---- C1 / C2: tokens with char offsets, char span -> token span ---------------------

#: Bytes of text whose tokens a task finds at once (a longer text is taken alone).
TEXT_BYTES = 4 << 20


def tokenize(df: DataFrame, keys, text_col: str = "text",
             detach_final_dot: bool = False, listed: bool = False) -> DataFrame:
    """Whitespace tokens with char offsets, one row per token:
    (keys, tok_idx, token, char_start, char_end), or one row per key with all of them as the list
    ``tokens`` (``listed``). Whole texts are dealt by their key; tokens are found where they are, over the bytes
    of many texts at once, so no row a token is moved, ordered or kept. The texts of a key that comes again
    are one stream, ordered by tok_idx.
    ``detach_final_dot``: a final '.' is cut before tokenizing and re-added
    as the last token at the end offset of the previous one."""
    keys = _k(keys)
    t = df.select(*keys, F.col(text_col).alias("_text")).repartition(*keys)
    t = t.groupBy(*keys).agg(F.collect_list("_text").alias("_texts"))
    size = TEXT_BYTES

    def run(batches):
        return _token_batches(batches, detach_final_dot, size)

    t = ship(t).mapInArrow(run, T.StructType([*[t.schema[k] for k in keys], T.StructField(
        "tokens", T.ArrayType(T.StructType.fromDDL("tok_idx int, token string, char_start int, char_end int")))]))
    return t if listed else t.select(*keys, F.explode("tokens").alias("_t")).select(*keys, "_t.*")


def _token_batches(batches, dot: bool, size: int):
    """Arrow batches of (keys, texts array<string>) -> (keys, tokens), in runs of rows of at most ``size`` bytes; a row without tokens goes."""
    import numpy as np
    import pyarrow.compute as pc
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        held = np.concatenate(([0], np.cumsum(pc.binary_length(texts.flatten()).to_numpy(zero_copy_only=False))))
        ends = held[np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False))]
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            found = _token_lists(texts.slice(at, upto - at), dot)
            out = pa.RecordBatch.from_arrays([*[c.slice(at, upto - at) for c in batch.columns[:-1]], found], [*batch.schema.names[:-1], "tokens"])
            yield out.filter(pc.greater(pc.list_value_length(found), 0))
            at = upto


def _token_lists(texts, dot: bool):
    """The tokens of each list of texts, all at once over their bytes. White space is that of the pattern \\s; lengths count code points."""
    import numpy as np
    held = np.diff(texts.offsets.to_numpy())
    row_of = np.repeat(np.arange(len(texts)), held)
    flat = texts.flatten().cast(pa.large_string())
    at = np.frombuffer(flat.buffers()[1] or b"\0" * 8, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    white = ((data >= 9) & (data <= 13)) | (data == 32)
    dotted = np.zeros(len(flat), bool)
    if dot:
        full = np.flatnonzero(np.diff(at))
        dotted[full] = data[at[full + 1] - 1] == ord(".")
        white[at[1:][dotted] - 1] = True   # the final dot is no part of a token
    edge = np.zeros(len(data) + 1, bool)   # where a text begins or ends
    edge[at] = True
    begins, stops = ~white, ~white
    begins[1:] &= white[:-1] | edge[1:-1]
    stops[:-1] &= white[1:] | edge[1:-1]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    n = len(begin)
    word_at = np.concatenate(([0], np.cumsum(stop - begin))).astype(np.int32)
    tokens = pa.StringArray.from_buffers(n, pa.py_buffer(word_at), pa.py_buffer(data[~white]))
    of = np.searchsorted(at, begin, "right") - 1
    tok_idx = np.arange(n) - np.searchsorted(begin, at[:-1])[of] if n else np.zeros(0, np.int64)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    start, end = (chars[x] - chars[at[of]] for x in (begin, stop))
    row, order = row_of[of], np.arange(n)
    if n and held.max() > 1:   # each token with the white space before it, in one stream a row
        piece, wide = end - np.where(tok_idx > 0, np.concatenate(([0], end[:-1])), 0), end - start
        order = np.lexsort((tok_idx, row))
        row, of, tok_idx, wide, so_far = row[order], of[order], tok_idx[order], wide[order], np.cumsum(piece[order])
        end = so_far - (so_far - piece[order])[np.searchsorted(row, row)]
        start = end - wide
    row_at = np.searchsorted(row, np.arange(len(texts) + 1))
    if dot:
        last, far = np.full(len(texts), -1), np.zeros(len(texts), np.int64)
        own = dotted[of]
        np.maximum.at(last, row[own], tok_idx[own])
        np.maximum.at(far, row[own], end[own])
        add = np.flatnonzero(last >= 0)
        tokens, put = pa.concat_arrays([tokens, pa.array(["."])]), row_at[add + 1]
        order, tok_idx, start, end = (np.insert(x, put, v) for x, v in ((order, n), (tok_idx, last[add] + 1), (start, far[add]), (end, far[add] + 1)))
        row_at = row_at + np.concatenate(([0], np.cumsum(last >= 0)))
    ints = lambda x: pa.array(x.astype(np.int32))
    return pa.ListArray.from_arrays(ints(row_at), pa.StructArray.from_arrays([ints(tok_idx), tokens.take(pa.array(order)), ints(start), ints(end)],
                                                                            ["tok_idx", "token", "char_start", "char_end"]))


def with_offsets(docs: DataFrame) -> DataFrame:
    """Adds ``starts`` and ``ends`` where ``docs`` has none: char offsets of ``tokens`` in the
    canonical text (tokens joined by one space), running sums inside the row."""
    if {"starts", "ends"} <= set(docs.columns):
        return docs
    from tessera.functions.arrays import prefix_sums
    d = docs.withColumn("_e", prefix_sums(F.transform("tokens", lambda t: F.length(t) + 1)))
    at = F.transform(F.arrays_zip(F.col("tokens").alias("t"), F.col("_e").alias("e")), lambda x: F.struct(
        (x["e"] - F.length(x["t"]) - 1).cast("int").alias("start"), (x["e"] - 1).cast("int").alias("end")))
    d = d.withColumn("_z", at)
    return d.withColumn("starts", F.col("_z")["start"]).withColumn("ends", F.col("_z")["end"]).drop("_e", "_z")


def align_spans(mentions: DataFrame, tokens: DataFrame, keys, mention: str, cs: str = "char_start", ce: str = "char_end") -> DataFrame:
    """Token span of a char span: (keys, mention, tok_start, tok_end). Start token:
    idx <= cs < idx+len; end token: idx < ce <= idx+len. A boundary that falls in a gap
    gives null and the mention is kept. ``mentions`` (keys, mention, cs, ce) and ``tokens``
    (keys, tok_idx, char_start, char_end) meet in one order of their places: a boundary
    looks at the last token that begins before it (a start also at it), so each is
    sorted once and no mention is compared with all tokens."""
    keys = _k(keys)
    # at one place an end comes before the token that begins there, and a start after it
    t = tokens.select(*keys, F.col("char_start").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(mentions.schema[mention].dataType).alias(mention),
                      F.struct("tok_idx", "char_end").alias("_tok"))
    none = F.lit(None).cast(t.schema["_tok"].dataType)
    m = mentions.select(*keys, mention, F.explode(F.array(F.struct(F.col(cs).alias("at"), F.lit(2).alias("kind")),
                                                          F.struct(F.col(ce).alias("at"), F.lit(0).alias("kind")))).alias("_b"))
    m = m.select(*keys, F.col("_b.at").alias("_at"), F.col("_b.kind").alias("_kind"), mention, none.alias("_tok"))
    w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    j = t.unionByName(m).withColumn("_tok", F.last("_tok", ignorenulls=True).over(w)).filter("_kind <> 1")
    start = F.when((F.col("_kind") == 2) & (F.col("_at") < F.col("_tok.char_end")), F.col("_tok.tok_idx"))
    end = F.when((F.col("_kind") == 0) & (F.col("_at") <= F.col("_tok.char_end")), F.col("_tok.tok_idx") + 1)
    return j.groupBy(*keys, mention).agg(F.max(start).cast("int").alias("tok_start"), F.max(end).cast("int").alias("tok_end"))


# ---- C3: relation arguments by entity id ------------------------------------------

def resolve_args(entities: DataFrame, relations: DataFrame, keys,
                 ent_id: str = "id", head_id: str = "head_id", tail_id: str = "tail_id") -> DataFrame:
    """Entity id -> position in the document's entity list; duplicate ids:
    the last position wins. Unresolvable ids come back null (see
    ``validate_docs`` for the report)."""
    keys = _k(keys)
    pos = entities.groupBy(*keys, ent_id).agg(F.max("ent_idx").alias("_pos"))
    h = pos.select(*keys, F.col(ent_id).alias(head_id), F.col("_pos").alias("head"))
    t = pos.select(*keys, F.col(ent_id).alias(tail_id), F.col("_pos").alias("tail"))
    return relations.join(h, [*keys, head_id], "left").join(t, [*keys, tail_id], "left")


# ---- C4: doc-level spans -> sentence-level ------------------------------------------

def explode_sentences(docs: DataFrame, key: str = "doc_key") -> DataFrame:
    """C4: documents with ``sentences`` (array<array<string>>), ``ner``
    (array<array<struct<s,e,type>>>, doc-level, inclusive end) and
    ``relations`` (array<array<struct<hs,he,ts,te,type>>>) -> one row per
    sentence with sentence-level entities (end exclusive) and relations by
    entity position (duplicate spans: the last entity wins), found for all
    sentences of a batch at once; id = key_sentenceindex. The token offset of a
    sentence is the running size of the earlier sentences, computed inside the row."""
    from tessera.functions.arrays import positions, prefix_sums
    d = docs.select(key, "sentences", "ner", "relations", prefix_sums(F.transform("sentences", lambda s: F.size(s))).alias("_ends"))
    z = d.select(key, F.posexplode(F.arrays_zip("sentences", "ner", "relations", "_ends")).alias("s_idx", "z"))
    off = F.col("z._ends") - F.size("z.sentences")
    z = z.select(key, "s_idx", F.col("z.sentences").alias("tokens"), F.col("z.ner").alias("_ner"),
                 F.col("z.relations").alias("_rel"), off.alias("_off"))
    ents = F.transform("_ner", lambda e: F.struct(
        e["type"].alias("type"), (e["s"] - F.col("_off")).cast("int").alias("start"),
        (e["e"] - F.col("_off") + 1).cast("int").alias("end")))
    span = lambda s, e: F.when(s.isNotNull() & e.isNotNull(), F.struct(s.cast("long").alias("s"), e.cast("long").alias("e")))
    at = F.transform("_ner", lambda x: span(x["s"], x["e"]))
    find = lambda s, e: positions(at, F.transform("_rel", lambda r: span(r[s], r[e])), last=True)
    z = z.withColumns({"_head": find("hs", "he"), "_tail": find("ts", "te")})
    rels = F.transform("_rel", lambda r, i: F.struct(r["type"].alias("type"), F.get("_head", i).alias("head"), F.get("_tail", i).alias("tail")))
    return z.select(F.concat(F.col(key).cast("string"), F.lit("_"), F.col("s_idx").cast("string"))
                    .alias("orig_id"), "tokens", ents.alias("entities"), rels.alias("relations"))


# ---- C5: stable sentence ids ---------------------------------------------------------

def assign_sentence_ids(lines: DataFrame, doc: str = "doc_id", order: str = "line_no",
                        text: str = "sentence") -> DataFrame:
    """Number distinct (doc, trimmed sentence) by first appearance within
    the document; every line gets the id of its sentence."""
    k = strip(text)
    first = lines.groupBy(doc, k.alias("_k")).agg(F.min(order).alias("_first"))
    w = Window.partitionBy(doc).orderBy("_first")
    ids = first.withColumn("sent_id", (F.row_number().over(w) - 1).cast("int"))
    return lines.withColumn("_k", k).join(ids.select(doc, "_k", "sent_id"), [doc, "_k"]).drop("_k")


# ---- C6: phrase occurrences ---------------------------------------------------------

def phrase_windows(docs: DataFrame, sizes: DataFrame, keys, chars: bool = True) -> DataFrame:
    """Every window of a document's ``tokens`` that is as long as one of its ``sizes`` (keys, sizes
    array<int>): (keys, size, start, phrase[, char_start, char_end if ``chars``]). The phrase is the tokens joined by
    one space; tokens hold no white space, so equal phrases of one size are equal token lists."""
    keys = _k(keys)
    held = ["tokens", "starts", "ends"] if chars else ["tokens"]
    d = met((with_offsets(docs) if chars else docs).select(*keys, *held), sizes, keys, [])
    w = d.select(*keys, *held, F.explode("sizes").alias("size")).filter(F.size("tokens") >= F.col("size"))
    w = w.select(*keys, *held, "size", F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("size"))).alias("start"))
    places = [F.element_at("starts", F.col("start") + 1).alias("char_start"), F.element_at("ends", F.col("start") + F.col("size")).alias("char_end")]
    return w.select(*keys, "size", "start", phrase("tokens", F.col("start"), F.col("start") + F.col("size")).alias("phrase"), *(places if chars else []))


def find_phrases(docs: DataFrame, phrases: DataFrame, keys) -> DataFrame:
    """All places where each of ``phrases`` (keys, size, phrase, ...) occurs in the tokens of its
    document, one row each with the place as ``occ``: windows and phrases meet where their document was dealt."""
    keys = _k(keys)
    sizes = phrases.groupBy(*keys).agg(F.collect_set("size").alias("sizes"))
    w = phrase_windows(docs, sizes, keys, chars=False).select(*keys, "size", "phrase", F.col("start").alias("occ"))
    return met(w, phrases, keys, ["size", "phrase"]).select(*phrases.columns, "occ")


# ---- C7: n-th occurrence pair with a given gap ---------------------------------------

def match_pairs(lines: DataFrame, docs: DataFrame | None, keys, order: str = "line_no") -> DataFrame:
    """For each annotation line (keys, order, head_toks, tail_toks, signed char gap)
    take the n-th (head, tail) occurrence pair of its document whose gap
    ``tail.start - head.end`` equals the annotated one, n = rank of the line
    among lines with the same (doc, head tokens, tail tokens, gap). Pairs are
    ordered head-major as in a nested scan. Lines with more repeats than pairs
    come back with null spans (reported, not asserted).

    A head and a gap fix where the tail begins, so pairs come from an equi-join of
    occurrences on (phrase, place): as many as heads, never heads x tails.

    Without ``docs``, ``lines`` is whole documents (keys, tokens, starts, ends, and the list ``lines`` of the others): the same in
    the document's row, where nothing moves but documents whose key comes again: (keys, order, the four places)."""
    keys = _k(keys)
    if docs is None:
        return _match_in_documents(lines, keys, order)
    grp = [*keys, "_h", "_hk", "_t", "_tk", "gap"]
    ln = lines.select("*", F.array_join("head_toks", " ").alias("_h"), F.size("head_toks").alias("_hk"),
                      F.array_join("tail_toks", " ").alias("_t"), F.size("tail_toks").alias("_tk"))
    ln = ln.withColumn("_n", F.row_number().over(Window.partitionBy(*grp).orderBy(order)))
    asked = ln.filter("_n = 1").select(*grp)
    sizes = asked.select(*keys, F.explode(F.array("_hk", "_tk")).alias("s")).groupBy(*keys).agg(F.collect_set("s").alias("sizes"))
    occ = phrase_windows(docs, sizes, keys)
    # an occurrence is itself, as a tail, and the head of a pair for each gap and tail asked of it; heads meet tails at the tail's place
    occ = occ.select(*keys, F.col("size").alias("_hk"), F.col("phrase").alias("_h"), F.col("start").alias("_hs"), "char_start", "char_end")
    occ = met(occ, asked.select(*keys, "_hk", "_h", F.struct("_t", "_tk", "gap").alias("_a")), keys, ["_hk", "_h"], outer=True, listed=True)
    kind = "struct<_head:boolean,_t:string,_tk:int,gap:" + lines.schema["gap"].dataType.simpleString() + ",_at:long>"
    tail = F.struct(F.lit(False), F.col("_h"), F.col("_hk"), F.lit(None), F.col("char_start")).cast(kind)
    head = F.transform("_rs", lambda r: F.struct(F.lit(True), r["_a"]["_t"], r["_a"]["_tk"], r["_a"]["gap"], F.col("char_end") + r["_a"]["gap"]).cast(kind))
    occ = occ.select(*keys, "_hk", "_h", "_hs", F.explode(F.concat(F.array(tail), head)).alias("_z")).select(*keys, "_hk", "_h", "_hs", "_z.*")
    place = Window.partitionBy(*keys, "_tk", "_t", "_at")
    found = occ.withColumn("_tails", F.collect_list(F.when(~F.col("_head"), F.col("_hs"))).over(place))
    found = found.filter(F.col("_head") & F.col("_at").isNotNull()).select(*grp, "_hs", F.explode("_tails").alias("_ts"))
    found = found.withColumn("_n", F.row_number().over(Window.partitionBy(*grp).orderBy("_hs", "_ts")))
    out = met(ln, found.select(*grp, "_n", "_hs", "_ts"), keys, [*grp[len(keys):], "_n"], outer=True)
    return out.select(*lines.columns, F.col("_hs").alias("head_start"), (F.col("_hs") + F.col("_hk")).alias("head_end"),
                      F.col("_ts").alias("tail_start"), (F.col("_ts") + F.col("_tk")).alias("tail_end"))


#: Tokens among which a task looks for pairs at once (a longer document is taken alone), and heads that it follows at once.
MATCHED_AT_ONCE, FOLLOWED_AT_ONCE = 200_000, 2_000_000
MATCHED = ["head_start", "head_end", "tail_start", "tail_end"]


def _match_in_documents(docs: DataFrame, keys: list[str], order: str) -> DataFrame:
    at = docs.schema["lines"].dataType.elementType[order]
    kind = T.StructType([at, *[T.StructField(c, T.IntegerType()) for c in MATCHED]])
    g = gathered(docs, keys, "lines", "tokens", "starts", "ends").withColumn("lines", F.transform(F.flatten("lines"), lambda z: F.struct(
        z[order].alias(order), z["head_toks"].alias("head_toks"), z["tail_toks"].alias("tail_toks"), z["gap"].cast("long").alias("gap"))))
    size, most = MATCHED_AT_ONCE, FOLLOWED_AT_ONCE

    def run(batches):
        return _match_batches(batches, size, most)

    found = ship(g).mapInArrow(run, T.StructType([*[g.schema[k] for k in keys], T.StructField("found", T.ArrayType(kind))]))
    found = found.select(*keys, F.explode("found").alias("z")).select(*keys, "z.*")
    lost = docs.filter(~_no_null(keys)).select(*keys, F.explode("lines").alias("z"))   # lines of no document
    return found.unionByName(lost.select(*keys, F.col("z")[order].alias(order), *[F.lit(None).cast("int").alias(c) for c in MATCHED]))


def _match_batches(batches, size: int, most: int):
    """Arrow batches of (keys, lines, tokens, starts, ends), the last three as lists of lists -> (keys, found), in runs of rows of at most ``size`` tokens."""
    import numpy as np
    for batch in batches:
        tokens = batch.column(batch.num_columns - 3)
        held = np.concatenate(([0], np.cumsum(np.diff(tokens.flatten().offsets.to_numpy()))))
        ends = held[np.cumsum(np.diff(tokens.offsets.to_numpy()))]
        at = 0
        while at < len(tokens):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            own = [c.slice(at, upto - at) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*own[:-4], _matched(*own[-4:], most)], [*batch.schema.names[:-4], "found"])
            at = upto


def _matched(lines, tokens, starts, ends, most: int):
    """The lines of each document with the places of their pairs, all at once: phrases are numbered by document, occurrences are
    sorted by (phrase, place), and heads and gaps are looked up among them."""
    import numpy as np
    import pyarrow.compute as pc
    lens = lambda x: np.diff(x.offsets.to_numpy())
    ints = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64)
    inner = tokens.flatten()
    n, row = lens(inner), np.repeat(np.arange(len(tokens)), lens(tokens))
    row, upto = np.repeat(row, n), np.repeat(np.cumsum(n), n)   # document of a token, where its list ends
    pos = np.arange(len(row)) - (upto - np.repeat(n, n))
    begin, end = (ints(x.flatten().flatten()) for x in (starts, ends))
    order, heads, tails, gap = lines.flatten().flatten()
    line_row = np.repeat(np.arange(len(lines)), lens(lines))
    code = pa.concat_arrays([inner.flatten(), heads.flatten(), tails.flatten()]).dictionary_encode().indices
    code = pc.fill_null(code, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    v = int(code.max(initial=0)) + 1
    doc_code, head_code, tail_code = np.split(code, [len(row), len(row) + len(heads.flatten())])
    asked = [(c, np.cumsum(lens(x)) - lens(x), np.where(np.asarray(x.is_valid()), lens(x), 0)) for x, c in ((heads, head_code), (tails, tail_code))]
    phrase = [np.full(len(line_row), -1), np.full(len(line_row), -1)]
    occ, many = [], 0
    for k in np.unique(np.concatenate([a[2] for a in asked])):   # sizes: few
        if k < 1:
            continue
        who = [np.flatnonzero(a[2] == k) for a in asked]
        at = np.flatnonzero(np.arange(len(row)) + k <= upto)
        mine, theirs = row[at], np.concatenate([line_row[w] for w in who])
        for j in range(k):   # windows that begin as a phrase asked in their document does
            theirs = theirs * v + np.concatenate([a[0][a[1][w] + j] for a, w in zip(asked, who)])
            mine = mine * v + doc_code[at + j]
            have, theirs = np.unique(theirs, return_inverse=True)
            mine_at = np.minimum(np.searchsorted(have, mine), len(have) - 1)
            hit = have[mine_at] == mine
            at, mine = at[hit], mine_at[hit]
        phrase[0][who[0]], phrase[1][who[1]] = theirs[:len(who[0])] + many, theirs[len(who[0]):] + many
        occ.append((mine + many, pos[at], begin[at], end[at + k - 1]))
        many += len(have)
    o_phrase, o_pos, o_begin, o_end = (np.concatenate(x) for x in zip(*occ)) if occ else [np.zeros(0, np.int64)] * 4
    out = np.full((2, len(line_row)), -1)
    line = np.flatnonzero((phrase[0] >= 0) & (phrase[1] >= 0) & np.asarray(gap.is_valid()))
    if len(line) and len(o_phrase):
        h, t, g = phrase[0][line], phrase[1][line], ints(gap.fill_null(0))[line]
        group = np.unique(h * many + t, return_inverse=True)[1]
        group = np.unique(group * (int(g.max() - g.min()) + 1) + g - g.min(), return_inverse=True)[1]
        sort = np.lexsort((ints(order)[line], group))
        line, h, t, g, group = line[sort], h[sort], t[sort], g[sort], group[sort]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        nth = np.arange(len(line)) - first[group]
        by_pos = np.lexsort((o_pos, o_phrase))
        p_phrase, p_pos, p_end = o_phrase[by_pos], o_pos[by_pos], o_end[by_pos]
        wide = int(o_begin.max()) + 1
        by_place = np.lexsort((o_pos, o_begin, o_phrase))
        place, place_pos = (o_phrase * wide + o_begin)[by_place], o_pos[by_place]
        a, b = (np.searchsorted(p_phrase, h[first], side) for side in ("left", "right"))
        so_far, at = np.cumsum(b - a), 0
        while at < len(first):   # groups, as many as have ``most`` heads
            upto = max(at + 1, int(np.searchsorted(so_far, (so_far[at - 1] if at else 0) + most, "right")))
            each = (b - a)[at:upto]
            of = np.repeat(np.arange(at, upto), each)
            occ_at = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each) + a[of]
            to = p_end[occ_at] + g[first][of]
            want = t[first][of] * wide + to
            x, y = (np.searchsorted(place, want, side) for side in ("left", "right"))
            k = np.where((to >= 0) & (to < wide), y - x, 0)
            head, tail_of = np.repeat(p_pos[occ_at], k), np.repeat(of, k)
            tail = place_pos[np.arange(len(head)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(x, k)]
            sort = np.lexsort((tail, head, tail_of))
            head, tail = head[sort], tail[sort]
            i = np.arange(first[at], first[upto] if upto < len(first) else len(line))
            pair = np.searchsorted(tail_of, group[i]) + nth[i]
            there = pair < np.searchsorted(tail_of, group[i], "right")
            out[0][line[i[there]]], out[1][line[i[there]]] = head[pair[there]], tail[pair[there]]
            at = upto
    places = [pa.array((x + add).astype(np.int32), mask=x < 0) for x, a in zip(out, asked) for add in (0, a[2])]
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lens(lines)))).astype(np.int32)),
                                    pa.StructArray.from_arrays([order, *places], [lines.type.value_type[0].name, *MATCHED]))


# ---- C8: per-document annotation lists by first appearance ---------------------------

def collect_annotations(rows: DataFrame, keys, value_cols: list[str], order: str) -> DataFrame:
    """Dedup (keys, values) keeping first appearance; index = rank of the
    first appearance inside the document."""
    keys = _k(keys)
    first = rows.groupBy(*keys, *value_cols).agg(F.min(order).alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_first")
    return first.withColumn("idx", (F.row_number().over(w) - 1).cast("int")).drop("_first")


# ---- C9: token index -> entity number -------------------------------------------------

def conll_relations(entity_rows: DataFrame, rel_rows: DataFrame, keys,
                    tok: str = "token_idx") -> DataFrame:
    """Relation rows reference entities by token index; entity number =
    order of the entity rows in the document."""
    keys = _k(keys)
    w = Window.partitionBy(*keys).orderBy(tok)
    num = entity_rows.select(*keys, tok).withColumn("_no", (F.row_number().over(w) - 1).cast("int"))
    h = num.select(*keys, F.col(tok).alias("head_tok"), F.col("_no").alias("head"))
    t = num.select(*keys, F.col(tok).alias("tail_tok"), F.col("_no").alias("tail"))
    return rel_rows.join(h, [*keys, "head_tok"], "left").join(t, [*keys, "tail_tok"], "left")


# ---- C10 / C11: sub-word encoding and its inverse -------------------------------------

#: Marks of an encoding, how a piece inside a word begins, and how long a word may be (fixed values).
UNKNOWN_PIECE, FIRST_PIECE, LAST_PIECE = "[UNK]", "[CLS]", "[SEP]"
INSIDE, WORD_CHARS = "##", 100
#: Pieces (a few tens of bytes each) up to which a vocabulary is broadcast.
BROADCAST_PIECES = 500_000


def split_words(words: DataFrame, vocab: DataFrame, word: str = "token") -> DataFrame:
    """The pieces of each distinct word: (word, pieces array<string>, ids array<int>), by longest match first: from
    the front the longest piece of ``vocab`` (piece, idx) that the rest of the word begins with (inside the word:
    marked by INSIDE), and so on; a word that cannot be split so, or that is too long, is one unknown piece.

    All pieces that a word could hold are looked up by an equi-join, and a fold over what was found, by
    place and then longest first, follows them. Only distinct words take part."""
    inside = F.col("piece").startswith(INSIDE)
    rows, front, back = vocab.agg(F.count(F.lit(1)), F.max(F.length("piece")), F.max(F.when(inside, F.length("piece") - len(INSIDE)))).first()   # three numbers
    w = words.select(F.col(word).alias("_w")).distinct()
    n = F.length("_w")
    places = F.when((n > 0) & (n <= WORD_CHARS), F.sequence(F.lit(0), n - 1))
    at = w.select("_w", n.alias("_n"), F.explode_outer(places).alias("_p"))
    most = F.when(F.col("_p") == 0, F.lit(front or 1)).otherwise(F.lit(back or 1))
    sub = at.select("_w", "_n", "_p", F.explode_outer(F.sequence(F.lit(1), F.least(most, F.col("_n") - F.col("_p")))).alias("_k"))
    sub = sub.withColumn("piece", F.concat(F.when(F.col("_p") > 0, F.lit(INSIDE)).otherwise(F.lit("")), F.substring(F.col("_w"), F.col("_p") + 1, F.col("_k"))))
    pieces = F.broadcast(vocab) if rows <= BROADCAST_PIECES else vocab
    hit = F.when(F.col("idx").isNotNull(), F.struct("_p", (-F.col("_k")).alias("_m"), "piece", "idx"))
    found = sub.join(pieces, "piece", "left").groupBy("_w", "_n").agg(F.sort_array(F.collect_list(hit)).alias("s"))

    def follow(acc, z):
        here = z["_p"] == acc["at"]
        return F.struct(F.when(here, acc["at"] - z["_m"]).otherwise(acc["at"]).alias("at"),
                        F.when(here, F.concat(acc["pieces"], F.array(z["piece"]))).otherwise(acc["pieces"]).alias("pieces"),
                        F.when(here, F.concat(acc["ids"], F.array(z["idx"]))).otherwise(acc["ids"]).alias("ids"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"), F.array().cast("array<int>").alias("ids"))
    found = found.select("_w", F.aggregate("s", start, follow).alias("f"), "_n")
    unknown = vocab.filter(F.col("piece") == UNKNOWN_PIECE).agg(F.max("idx")).first()[0]   # one number
    whole = (F.col("f.at") == F.col("_n")) & (F.size("f.pieces") > 0)
    return found.select(F.col("_w").alias(word), F.when(whole, F.col("f.pieces")).otherwise(F.array(F.lit(UNKNOWN_PIECE))).alias("pieces"),
                        F.when(whole, F.col("f.ids")).otherwise(F.array(F.lit(unknown).cast("int"))).alias("ids"))


def _broadcast_ids(vocab: DataFrame):
    """The ids of the pieces, broadcast, and that of the unknown piece; None if the vocabulary is too large for that."""
    rows = vocab.count()
    if rows > BROADCAST_PIECES:
        return None
    ids = {}
    for piece, idx in vocab.filter(F.col("piece").isNotNull() & F.col("idx").isNotNull()).select("piece", "idx").collect():   # a vocabulary, as if broadcast
        ids[piece] = min(idx, ids.get(piece, idx))
    unknown = vocab.filter(F.col("piece") == UNKNOWN_PIECE).agg(F.max("idx")).first()[0]   # one number
    return vocab.sparkSession.sparkContext.broadcast(ids), unknown


PIECES = "pieces array<string>, ids array<int>"


def split_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``tokens`` (token, ...) with their pieces and ids as ``split_words`` has them; null tokens go. Where the vocabulary can be
    broadcast, each batch splits its distinct tokens where they are; else distinct words are split by joins and met by another."""
    ids = _broadcast_ids(vocab)
    if ids is None:
        return tokens.join(split_words(tokens, vocab), "token")
    t = tokens.filter(F.col("token").isNotNull()).withColumn("_s", F.arrow_udf(_splitter(*ids), T.StructType.fromDDL(PIECES))("token"))
    return t.select(*tokens.columns, "_s.pieces", "_s.ids")


#: Words whose pieces a worker remembers before it starts anew.
REMEMBERED_WORDS = 100_000


def _splitter(vocab, unknown: int | None):
    """The pieces of words by longest match first (see ``split_words``), as a function of Arrow arrays."""
    inside, chars, most, nothing = INSIDE, WORD_CHARS, REMEMBERED_WORDS, ([UNKNOWN_PIECE], [unknown])
    known: dict = {}

    def pieces_of(word, ids, front, back):
        at, pieces = 0, []
        while at < len(word):
            mark = inside if at else ""
            for k in range(min(back if at else front, len(word) - at), 0, -1):
                if (piece := mark + word[at:at + k]) in ids:
                    break
            else:
                return nothing
            pieces.append(piece)
            at += k
        return pieces, [ids[p] for p in pieces]

    def split(words: pa.Array) -> pa.Array:
        import pyarrow as pa
        ids = vocab.value
        if None not in known:
            known[None] = max(map(len, ids), default=0), max((len(p) - len(inside) for p in ids if p.startswith(inside)), default=0)
        elif len(known) > most:
            limits = known[None]
            known.clear()
            known[None] = limits
        front, back = known[None]
        code = words.dictionary_encode()
        out = []
        for word in code.dictionary.to_pylist():
            if word not in known:
                known[word] = pieces_of(word, ids, front, back) if 0 < len(word) <= chars else nothing
            out.append(known[word])
        found = pa.StructArray.from_arrays([pa.array([p for p, _ in out], pa.list_(pa.string())), pa.array([i for _, i in out], pa.list_(pa.int32()))], ["pieces", "ids"])
        return found.take(code.indices)

    return split


def encode_subwords(tokens: DataFrame, vocab: DataFrame, keys, parts: int | None = None) -> DataFrame:
    """``tokens`` (keys, tok_idx, token) -> (keys, tok_idx, token, pieces, ids, sub_start, sub_end): the
    pieces of each token by ``vocab`` and its sub-word span, a running offset from 1 (place 0 is
    the first mark). A token without pieces, also an empty one, is one unknown piece. ``parts``: into how many parts
    the tokens are dealt by document, so that what is dealt alike finds them there.

    ``tokens`` may be whole documents (keys, tokens array<string>, other lists): then a key is one row with the same as the
    list ``encoded`` and its other lists, and nothing moves but documents whose key comes again (their lists are put together,
    their tokens ordered by tok_idx). Documents without tokens, and null keys, give no row."""
    keys = _k(keys)
    if "tokens" in tokens.columns:
        return _encode_documents(tokens, vocab, keys)
    t = split_tokens(tokens.select(*keys, "tok_idx", "token"), vocab).withColumn("_k", F.size("pieces"))
    t = t.repartition(parts, *keys) if parts else t
    w = Window.partitionBy(*keys).orderBy("tok_idx").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("sub_end", (1 + F.sum("_k").over(w)).cast("int"))
    return t.select(*keys, "tok_idx", "token", "pieces", "ids", (F.col("sub_end") - F.col("_k")).alias("sub_start"), "sub_end")


ENCODED = f"tok_idx int, token string, {PIECES}, sub_start int, sub_end int"
#: Tokens that a task encodes at once (a longer document is taken alone).
ENCODED_AT_ONCE = 200_000


def _encode_documents(docs: DataFrame, vocab: DataFrame, keys: list[str]) -> DataFrame:
    more = [c for c in docs.columns if c not in (*keys, "tokens")]
    g = gathered(docs, keys, *more, "tokens")
    g = g.select(*keys, *[F.flatten(c).alias(c) for c in more], "tokens")
    ids = _broadcast_ids(vocab)
    if ids is None:   # tokens as rows, which meet their words
        t = g.select(*keys, F.explode("tokens").alias("_t")).select(*keys, F.posexplode("_t").alias("tok_idx", "token"))
        fields = T.StructType.fromDDL(ENCODED).names
        e = encode_subwords(t, vocab, keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("encoded"))
        return g.drop("tokens").join(e, keys) if more else e
    split, size = _splitter(*ids), ENCODED_AT_ONCE

    def run(batches):
        return _encode_batches(batches, split, size)

    return ship(g).mapInArrow(run, T.StructType([*g.drop("tokens").schema, T.StructField("encoded", T.ArrayType(T.StructType.fromDDL(ENCODED)))]))


def _encode_batches(batches, split, size: int):
    """Arrow batches of (..., tokens array<array<string>>) -> (..., encoded), in runs of rows of at most ``size`` tokens; a row without tokens goes."""
    import numpy as np
    import pyarrow.compute as pc
    lengths = lambda x: pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends = np.concatenate(([0], np.cumsum(lengths(lists.flatten()))))[np.cumsum(lengths(lists))]
        at = 0
        while at < len(lists):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            found = _encoded(lists.slice(at, upto - at), split)
            out = pa.RecordBatch.from_arrays([*[c.slice(at, upto - at) for c in batch.columns[:-1]], found], [*batch.schema.names[:-1], "encoded"])
            yield out.filter(pc.greater(pc.list_value_length(found), 0))
            at = upto


def _encoded(lists, split):
    """What ``encode_subwords`` has of the tokens of each list of lists; a row's lists are put together by tok_idx."""
    import numpy as np
    import pyarrow.compute as pc
    lengths = lambda x: pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
    held, inner = lengths(lists), lists.flatten()
    n, tokens = lengths(inner), inner.flatten()
    row = np.repeat(np.repeat(np.arange(len(lists)), held), n)
    tok_idx = np.arange(len(tokens)) - np.repeat(np.cumsum(n) - n, n)
    if tokens.null_count:
        there = np.asarray(tokens.is_valid())
        tokens, row, tok_idx = tokens.drop_null(), row[there], tok_idx[there]
    if held.max(initial=0) > 1:
        order = np.lexsort((tok_idx, row))
        tokens, row, tok_idx = tokens.take(pa.array(order)), row[order], tok_idx[order]
    found = split(tokens)
    k = lengths(found.field("ids"))
    so_far = np.cumsum(k, dtype=np.int64)
    end = 1 + so_far - (so_far - k)[np.searchsorted(row, row)]
    ints = lambda x: pa.array(x.astype(np.int32))
    row_at = np.searchsorted(row, np.arange(len(lists) + 1))
    return pa.ListArray.from_arrays(ints(row_at), pa.StructArray.from_arrays([ints(tok_idx), tokens, found.field("pieces"), found.field("ids"), ints(end - k), ints(end)],
                                                                            ["tok_idx", "token", "pieces", "ids", "sub_start", "sub_end"]))


def encodings(encoded: DataFrame, vocab: DataFrame, keys) -> DataFrame:
    """(keys, encoding array<int>) of ``encode_subwords``' rows: the first mark, all ids in order, the last mark. Its whole
    documents (list ``encoded``) keep their columns and gain ``encoding``."""
    keys = _k(keys)
    mark = lambda m: F.max(F.when(F.col("piece") == m, F.col("idx")))
    marks = vocab.agg(mark(FIRST_PIECE).alias("_f"), mark(LAST_PIECE).alias("_l"))   # one row
    if "encoded" in encoded.columns:
        ids = F.flatten(F.col("encoded")["ids"])
        return encoded.crossJoin(F.broadcast(marks)).select(*encoded.columns, F.concat(F.array("_f"), ids, F.array("_l")).alias("encoding"))
    e = encoded.groupBy(*keys).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("tok_idx", "ids"))), lambda z: z["ids"])).alias("_ids"))
    return e.crossJoin(F.broadcast(marks)).select(*keys, F.concat(F.array("_f"), "_ids", F.array("_l")).alias("encoding"))


def decode_spans(sub_spans: DataFrame, token_spans: DataFrame | str, keys) -> DataFrame:
    """C11: sub-word span -> token range by equi-join on sub_start (first
    token) and sub_end (last token). ``sub_spans`` may be whole documents, with the spans as the list ``mentions`` and
    the tokens as the list that ``token_spans`` names: then the elements of ``mentions`` gain start and end in the row."""
    keys = _k(keys)
    if isinstance(token_spans, str):
        d = met_listed(sub_spans, "mentions", token_spans, ("sub_start", "sub_start"), {"start": "tok_idx"}, outer=True)
        d = met_listed(d, "mentions", token_spans, ("sub_end", "sub_end"), {"end": "tok_idx"}, outer=True)
        return d.withColumn("mentions", F.transform("mentions", lambda m: m.withField("end", m["end"] + 1)))
    a = token_spans.select(*keys, F.col("sub_start"), F.col("tok_idx").alias("start"))
    b = token_spans.select(*keys, F.col("sub_end"), (F.col("tok_idx") + 1).alias("end"))
    return met(met(sub_spans, a, keys, ["sub_start"], outer=True), b, keys, ["sub_end"], outer=True)


# ---- C12: orientation of relations ------------------------------------------------------

def orient_relations(rels: DataFrame, types: DataFrame) -> DataFrame:
    """``reverse`` = tail starts before head; symmetric types swap their
    arguments so that the first in text is the head. ``rels`` has type, head,
    tail, hs, he, ts_, te (+ types ht, tt); ``types`` has (type, symmetric);
    the type table is a dimension with one row per type."""
    j = rels.join(F.broadcast(types.select("type", "symmetric")), "type", "left")
    rev = F.col("ts_") < F.col("hs")
    swap = F.coalesce(F.col("symmetric"), F.lit(False)) & rev
    cols = {"head": "tail", "hs": "ts_", "he": "te", "ht": "tt"}
    sel = []
    for c in j.columns:
        if c in cols:
            sel.append(F.when(swap, F.col(cols[c])).otherwise(F.col(c)).alias(c))
        elif c in cols.values():
            inv = {v: k for k, v in cols.items()}[c]
            sel.append(F.when(swap, F.col(inv)).otherwise(F.col(c)).alias(c))
        else:
            sel.append(F.col(c))
    return j.select(*sel, rev.alias("reverse"))


# ---- C13-C18: candidate spans and pairs ---------------------------------------------------

def enumerate_spans(docs: DataFrame, keys, max_size: int) -> DataFrame:
    """All spans of 1..max_size tokens of a document, one row each: (keys, start, end, size)."""
    keys = _k(keys)
    n = F.size("tokens")
    d = docs.filter(n > 0).select(*keys, n.alias("_n"), F.explode(F.sequence(F.lit(1), F.least(F.lit(max_size), n))).alias("size"))
    d = d.select(*keys, "size", F.explode(F.sequence(F.lit(0), F.col("_n") - F.col("size"))).alias("start"))
    return d.select(*keys, "start", (F.col("start") + F.col("size")).alias("end"), "size")


def negative_spans(docs: DataFrame, keys, max_size: int, listed: bool = False) -> DataFrame:
    """C14: candidate spans that are not gold spans, one row each: (keys, start, end, size). Documents are dealt as their
    length and entities; the places of a size, less those where a gold span of it begins, are worked out in the row and
    widened there, so that neither places nor candidates move. ``listed``: one row per key with all of them as the list
    ``spans`` of (size, starts array<int>); documents whose key comes once are not dealt then."""
    keys = _k(keys)
    if listed:
        return _negative_lists(docs, keys, max_size)
    d = dealt(docs.withColumn("_n", F.size("tokens")), keys, "_n", "entities", parts=deal_parts(docs))
    known = F.flatten(F.collect_list("entities").over(Window.partitionBy(*keys)))   # a key may repeat
    d = d.withColumn("_known", F.when(_no_null(keys), known)).filter("_n > 0")
    d = d.select(*keys, "_n", "_known", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_size), F.col("_n")))).alias("size"))
    places = F.sequence(F.lit(0), F.col("_n") - F.col("size"))
    taken = F.transform(F.filter("_known", lambda e: e["end"] - e["start"] == F.col("size")), lambda e: e["start"].cast("int"))
    free = F.when(F.col("_known").isNull(), places).otherwise(F.array_except(places, taken))
    d = d.select(*keys, "size", F.explode_outer(free).alias("start")).filter(F.col("start").isNotNull())
    return d.select(*keys, "start", (F.col("start") + F.col("size")).alias("end"), "size")


def _negative_lists(docs: DataFrame, keys: list[str], max_size: int) -> DataFrame:
    d = docs.withColumn("_n", F.size("tokens"))
    known = F.transform(F.flatten("entities"), lambda e: F.struct(e["start"].cast("int").alias("start"), (e["end"] - e["start"]).alias("size")))
    g = gathered(d, keys, "_n", "entities").select(*keys, "_n", known.alias("_known"))
    lost = d.filter(~_no_null(keys)).groupBy(*keys).agg(F.collect_list("_n").alias("_n"))   # null is no key: no span is known
    g = g.unionByName(lost.withColumn("_known", F.array().cast(g.schema["_known"].dataType)))
    g = g.withColumn("_sizes", F.transform(F.sequence(F.lit(1), F.lit(max_size)), lambda k: F.struct(k.alias("size"), F.transform(
        F.filter("_known", lambda e: e["size"] == k), lambda e: e["start"]).alias("taken"))))
    # each size is bound with its known starts, so that a place is not compared with all of them
    lists = F.transform("_n", lambda n: F.transform(F.filter("_sizes", lambda z: z["size"] <= n), lambda z: F.struct(
        z["size"].alias("size"), F.array_except(F.sequence(F.lit(0), n - z["size"]), z["taken"]).alias("starts"))))
    return g.select(*keys, F.flatten(lists).alias("spans")).filter(F.size("spans") > 0)


#: Spans of which ``sample_per_group`` looks at once at most (a longer list is taken alone).
SAMPLED_AT_ONCE = 2_000_000


def _sampler(n: int, seed: str):
    """At most ``n`` spans of each list of (size, starts) by md5(seed || start:end), as an Arrow function. An id is hashed once by a worker."""
    most = SAMPLED_AT_ONCE
    known: dict = {}

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def sample(spans: pa.Array) -> pa.Array:
        import numpy as np
        inner = spans.flatten().flatten()[1]
        size = np.concatenate(([0], np.cumsum(np.diff(inner.offsets.to_numpy())))) if len(inner) else np.zeros(1, np.int64)
        ends = size[np.cumsum(np.diff(spans.offsets.to_numpy()))] if len(spans) else np.zeros(0, np.int64)
        out, at = [], 0
        while at < len(spans) or not out:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            out.append(_sampled(spans.slice(at, upto - at), n, seed, known))
            at = upto
        return pa.concat_arrays(out)

    return sample


def _sampled(spans, n: int, seed: str, known: dict):
    import hashlib

    import numpy as np
    sizes, starts = spans.flatten().flatten()
    count = np.diff(starts.offsets.to_numpy()) if len(starts) else np.zeros(0, np.int64)
    row = np.repeat(np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()) if len(spans) else 0), count)
    start = starts.flatten().to_numpy(zero_copy_only=False)
    size = np.repeat(sizes.to_numpy(zero_copy_only=False), count)
    high = np.empty(len(start), np.uint64)
    for k in np.unique(size):   # few: the first half of the hash by size and start
        own = np.flatnonzero(size == k)
        at = start[own]
        table, there = known.get(k) or (np.zeros(0, np.uint64), np.zeros(0, bool))
        if (far := int(at.max()) + 1) > len(table):
            table, there = (np.concatenate((x, np.zeros(2 * far - len(x), x.dtype))) for x in (table, there))
            known[k] = table, there
        for a in np.unique(at[~there[at]]):
            table[a] = int.from_bytes(hashlib.md5(f"{seed}{a}:{a + k}".encode()).digest()[:8], "big")
            there[a] = True
        high[own] = table[at]
    # a row's size tells below which hash some more than n of its spans are expected; a row with fewer there is ordered whole
    held = np.bincount(row, minlength=len(spans))
    below = np.minimum((n + 6 * math.isqrt(n) + 8) / np.maximum(held, 1), 1.0) * float(2**64 - 2**11)
    few = (high <= below.astype(np.uint64)[row]) | (held <= n)[row]
    few |= (np.bincount(row[few], minlength=len(spans)) < np.minimum(n, held))[row]
    row, start, size, high = row[few], start[few], size[few], high[few]
    order = np.lexsort((high, row))
    row, start, size, high = row[order], start[order], size[order], high[order]
    alike = np.flatnonzero((np.diff(high) == 0) & (np.diff(row) == 0) & ((np.diff(start) != 0) | (np.diff(size) != 0)))
    if len(alike):   # by the whole hash
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], hashlib.md5(f"{seed}{start[i]}:{start[i] + size[i]}".encode()).digest())), np.int64)
        row, start, size = row[order], start[order], size[order]
    first = np.searchsorted(row, np.arange(len(spans) + 1))
    keep = np.arange(len(row)) - first[row] < n
    row, start, size = row[keep], start[keep], size[keep]
    ints = lambda x: pa.array(x.astype(np.int32))
    return pa.ListArray.from_arrays(ints(np.searchsorted(row, np.arange(len(spans) + 1))), pa.StructArray.from_arrays([ints(start), ints(start + size)], ["start", "end"]))


def sample_per_group(df: DataFrame, keys, n: int, seed: str, id_col: Column | None = None) -> DataFrame:
    """C15 (row form): at most n rows per group by md5(seed || id) order. A group's size tells below which hash some
    more than n of its rows are expected; only those are ordered. A group with fewer than n below it (never seen, but
    possible, as with many rows of one id) is ordered whole. ``df`` may hold a group a row with the list ``spans`` of
    ``negative_spans``: then a span (its id is start:end) is a row of the group, and all is done in the group's row."""
    keys = _k(keys)
    if id_col is None:
        return df.select(*keys, F.explode(_sampler(n, seed)("spans")).alias("_s")).select(*keys, "_s.*")
    h = df.withColumn("_h", F.md5(F.concat(F.lit(seed), id_col.cast("string"))))
    rows = n + 6 * math.isqrt(n) + 8
    size = df.filter(_no_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    below = F.lpad(F.lower(F.hex(F.floor(F.lit(float(rows << 32)) / F.col("_size")))), 8, "0")
    size = size.withColumn("_below", F.when(F.col("_size") > rows, below))   # null: all
    few = h.join(size.select(*keys, "_below").hint("shuffle_hash"), keys, "left")
    few = few.filter(F.col("_below").isNull() | F.col("_h").isNull() | (F.col("_h") < F.col("_below"))).select(*df.columns, "_h")
    row = F.struct(*df.columns)
    both = few.select(*keys, "_h", row.alias("_row"), F.lit(None).cast("long").alias("_size"))
    both = both.unionByName(size.select(*keys, F.lit(None).cast("string").alias("_h"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), "_size"))
    every = Window.partitionBy(*keys)
    both = both.withColumns({"_rn": F.row_number().over(every.orderBy(F.col("_row").isNull(), "_h")), "_found": F.count("_row").over(every),
                             "_all": F.max("_size").over(every)})
    missed = F.col("_found") < F.least(F.lit(n), F.coalesce("_all", F.lit(0)))
    both = both.filter(F.when(F.col("_row").isNull(), missed).otherwise((F.col("_rn") <= n) & ~missed))
    both = cut_lineage(both.select(*keys, "_row"), "sample")
    out = both.filter(F.col("_row").isNotNull()).select("_row.*")
    whole = both.filter(F.col("_row").isNull()).select(*keys)
    if whole.isEmpty():
        return out
    rest = h.join(whole, keys, "left_semi").withColumn("_rn", F.row_number().over(every.orderBy("_h")))
    return out.unionByName(rest.filter(F.col("_rn") <= n).drop("_rn", "_h"))


def relation_targets(rels: DataFrame, keys, n_types: int) -> DataFrame:
    """Group relations by (head span, tail span) -> multi-hot vector over
    type indices 1..T-1."""
    keys = _k(keys)
    g = rels.groupBy(*keys, "hs", "he", "ts_", "te").agg(F.collect_set("type_idx").alias("_t"))
    return g.withColumn("targets", F.transform(F.sequence(F.lit(1), F.lit(n_types - 1)),
                                               lambda t: F.array_contains("_t", t).cast("int"))).drop("_t")


#: Rows of a document that one block of pairs holds, and pairs that one task makes.
PAIR_BLOCK, TASK_PAIRS = 256, 20_000_000


def ordered_pairs(rows: DataFrame, keys, idx: str, left: list[str], right: list[str], block: int = PAIR_BLOCK) -> DataFrame:
    """All ordered pairs of ``rows`` of one document: (keys, l struct<left>, r struct<right>), a row with itself
    included. Rows are put in blocks of ``block`` by ``idx`` (0, 1, ... in a document); each two blocks of a
    document are one bounded row, dealt anew by (document, block, block), so that a long document's
    pairs spread over many tasks, and widened to pairs there."""
    keys = _k(keys)
    b = F.expr(f"`{idx}` div {block}").cast("int")
    blocks = rows.groupBy(*keys, b.alias("_b")).agg(F.collect_list(F.struct(*left)).alias("_l"), F.collect_list(F.struct(*right)).alias("_r"))
    n = rows.groupBy(*keys).agg((F.max(b) + 1).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    total = n.agg(F.sum(F.col("_rows") * F.col("_rows"))).first()[0] or 0   # one number
    lft = blocks.select(*keys, "_b", "_l").join(n.drop("_rows"), keys)
    lft = lft.select(*keys, F.col("_b").alias("_lb"), "_l", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_rb"))
    j = lft.join(blocks.select(*keys, F.col("_b").alias("_rb"), "_r"), [*keys, "_rb"])
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(-(-total // TASK_PAIRS)))
    j = j.repartition(tasks, *keys, "_lb", "_rb")
    j = j.select(*keys, F.explode("_l").alias("l"), "_r")
    return j.select(*keys, "l", F.explode("_r").alias("r"))


def negative_pairs(docs: DataFrame, keys) -> DataFrame:
    """C17: ordered pairs of gold spans with different spans and not a gold
    (head, tail) span pair; direction-sensitive, duplicated spans repeat:
    (keys, s1, e1, s2, e2). A head carries the tails of its own relations (few) into the pairs."""
    keys = _k(keys)
    d = dealt(docs, keys, "entities", "relations")
    no = F.lit(None).cast("struct<start:int,end:int>")
    heads = relations_with_spans(d, keys).select(*keys, F.lit(None).cast("int").alias("ent_idx"), F.col("hs").alias("start"), F.col("he").alias("end"),
                                                 F.struct(F.col("ts_").alias("start"), F.col("te").alias("end")).alias("tail"))
    ents = to_mentions(d, keys).select(*keys, "ent_idx", "start", "end", no.alias("tail")).unionByName(heads)
    ents = ents.withColumn("tails", F.collect_set("tail").over(Window.partitionBy(*keys, "start", "end"))).filter(F.col("ent_idx").isNotNull()).drop("tail")
    p = ordered_pairs(ents, keys, "ent_idx", ["start", "end", "tails"], ["start", "end"])
    other = (F.col("l.start") != F.col("r.start")) | (F.col("l.end") != F.col("r.end"))
    p = p.filter(other & ~F.array_contains("l.tails", F.col("r")))
    return p.select(*keys, F.col("l.start").alias("s1"), F.col("l.end").alias("e1"), F.col("r.start").alias("s2"), F.col("r.end").alias("e2"))


def candidate_pairs(docs: DataFrame, keys) -> DataFrame:
    """Ordered pairs (i, j), i != j, of the positions of a document's entities: (keys, i, j). Positions need no entity rows:
    a document is its number of entities (rows with the same keys are one document, each with its own positions), cut into
    blocks where it is; each two blocks are one narrow row, dealt by (document, block, block) and widened to pairs there."""
    keys = _k(keys)
    sizes = docs.filter(_no_null(keys)).select(*keys, F.size(F.col("entities.start")).alias("_n")).filter("_n > 0")
    g = sizes.groupBy(*keys).agg(F.collect_list("_n").alias("_ns"), F.sum(F.col("_n").cast("long")).alias("_rows"))
    total = g.agg(F.sum(F.col("_rows") * F.col("_rows"))).first()[0] or 0   # one number
    b = lambda n: F.explode(F.sequence(F.lit(0), F.expr(f"cast(({n} - 1) div {PAIR_BLOCK} as int)")))
    j = g.select(*keys, "_ns", F.explode("_ns").alias("_ln")).select(*keys, "_ln", F.explode("_ns").alias("_rn"))
    j = j.select(*keys, "_ln", "_rn", b("_ln").alias("_lb")).select(*keys, "_ln", "_rn", "_lb", b("_rn").alias("_rb"))
    j = j.repartition(max(docs.sparkSession.sparkContext.defaultParallelism, int(-(-total // TASK_PAIRS))), *keys, "_lb", "_rb")
    at = lambda b, n: F.explode(F.sequence(F.col(b) * PAIR_BLOCK, F.least((F.col(b) + 1) * PAIR_BLOCK, F.col(n)) - 1))
    j = j.select(*keys, "_rb", "_rn", at("_lb", "_ln").alias("i"))
    return j.select(*keys, "i", at("_rb", "_rn").alias("j")).filter("i <> j")


# ---- C21 / C22: pooling over spans, batch padding -------------------------------------------

def span_max_pool(spans: DataFrame, vectors: DataFrame, keys, span: str, dim: int) -> DataFrame:
    """Element-wise max of the token vectors inside each span: ``spans`` (keys, span, start, end), ``vectors``
    (keys, pos, vec) -> (keys, span, vec); zeros where a span is empty."""
    keys = _k(keys)
    at = spans.filter(F.col("start") < F.col("end")).select(*keys, span, F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"))
    # places of spans and tokens are one table: each place sees its token's vector in a window, which moves nothing if both are dealt by document
    dims = [f"_m{i}" for i in range(dim)]
    none, nowhere = F.lit(None).cast("double"), F.lit(None).cast(spans.schema[span].dataType)
    both = at.select(*keys, span, "pos", F.lit(True).alias("_in"), *[none.alias(c) for c in dims]).unionByName(vectors.select(
        *keys, nowhere.alias(span), "pos", F.lit(False).alias("_in"), *[F.element_at("vec", i + 1).cast("double").alias(c) for i, c in enumerate(dims)]))
    w = Window.partitionBy(*keys, "pos")
    both = both.withColumns({c: F.max(c).over(w) for c in dims}).filter("_in")
    m = both.groupBy(*keys, span).agg(*[F.max(c).alias(c) for c in dims])
    zero = F.lit(0.0)
    return spans.select(*keys, span).join(m, [*keys, span], "left").select(
        *keys, span, F.array(*[F.coalesce(F.col(f"_m{i}"), zero) for i in range(dim)]).alias("vec"))


def pad_batch(df: DataFrame, batch_col: str, arr_col: str, fill=0) -> DataFrame:
    """Pad ``arr_col`` to the longest array of its batch."""
    from tessera.functions.arrays import pad_to
    w = Window.partitionBy(batch_col)
    return df.withColumn("_mx", F.max(F.size(arr_col)).over(w)).withColumn(
        arr_col, pad_to(arr_col, F.col("_mx"), fill)).drop("_mx")


# ---- C27: validation report -----------------------------------------------------------------

def validate_docs(docs: DataFrame) -> DataFrame:
    """One row of violation counts instead of assertions."""
    n = F.size("tokens")
    ne = F.size("entities")
    bad_span = F.exists("entities", lambda e: (e["start"] < 0) | (e["end"] > n) | (e["start"] >= e["end"]))
    bad_arg = F.exists("relations", lambda r: r["head"].isNull() | r["tail"].isNull() | (r["head"] < 0)
                       | (r["tail"] < 0) | (r["head"] >= ne) | (r["tail"] >= ne))
    return docs.agg(F.count(F.lit(1)).alias("n_docs"),
                    F.count_if(bad_span).alias("docs_bad_span"),
                    F.count_if(bad_arg).alias("docs_bad_arg"),
                    F.count_if(n == 0).alias("docs_empty"))


# ---- C30: prediction output layout ------------------------------------------------------------

def format_predictions(docs: DataFrame) -> DataFrame:
    """Entities sorted by start (stable), relations re-pointed to the
    first equal entity of the sorted list and sorted by head (stable)."""
    from tessera.functions.arrays import positions
    ents = F.col("entities")
    keyed = F.transform(ents, lambda e, i: F.struct(e["start"].alias("s"), i.alias("i"), e.alias("e")))
    sorted_e = F.transform(F.array_sort(keyed), lambda z: z["e"])
    arg = lambda c: F.transform("relations", lambda r: F.element_at(ents, r[c] + 1))
    d = docs.withColumn("_se", sorted_e)
    d = d.withColumns({"_head": positions(F.col("_se"), arg("head")), "_tail": positions(F.col("_se"), arg("tail"))})
    rels = F.transform("relations", lambda r, i: F.struct(F.get("_head", i).alias("head"), i.alias("i"), r["type"].alias("type"), F.get("_tail", i).alias("tail")))
    rels = F.transform(F.array_sort(rels), lambda z: F.struct(
        z["type"].alias("type"), z["head"].alias("head"), z["tail"].alias("tail")))
    return d.withColumn("relations", rels).withColumn("entities", F.col("_se")).drop("_se", "_head", "_tail")
