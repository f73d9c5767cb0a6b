"""Joins and set operations (D1, D2, D4-D13; D3 lives in ``asof.py``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.splits import global_rank


def _k(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def latest_per_key(files: DataFrame, keys, path: str = "path") -> DataFrame:
    """A10 rule: one file per key; a '.gz' file wins over the plain one."""
    keys = _k(keys)
    return files.groupBy(*keys).agg(F.max_by(F.col(path), F.struct(
        F.col(path).endswith(".gz").alias("gz"), F.col(path).alias("p"))).alias(path))


def pair_samples(left: DataFrame, right: DataFrame, keys, lpath: str = "left_file",
                 rpath: str = "right_file") -> DataFrame:
    """Keys present on both sides; one file per key per side."""
    keys = _k(keys)
    lft = latest_per_key(left.select(*keys, F.col(lpath).alias("path")), keys).withColumnRenamed("path", lpath)
    rgt = latest_per_key(right.select(*keys, F.col(rpath).alias("path")), keys).withColumnRenamed("path", rpath)
    return lft.join(rgt, keys, "inner")


def zip_by_rank(a: DataFrame, b: DataFrame, a_order: list[Column], b_order: list[Column]) -> DataFrame:
    """Pair two lists by sorted position (not by key): global rank on each
    side, equi-join on the rank."""
    ra = global_rank(a, a_order, "_rank")
    rb = global_rank(b, b_order, "_rank")
    return ra.join(rb, "_rank").withColumnRenamed("_rank", "pos")


def label_history(labels: DataFrame, key: str, on: str, label: str) -> DataFrame:
    """Distinct (key, date, label) rows; order is by (key, date)."""
    return labels.select(key, on, label).dropDuplicates([key, on, label])


def drop_unlabelled(df: DataFrame, label: str) -> DataFrame:
    """D5."""
    return df.dropna(subset=[label])


def union_docs(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def merge_types(first: DataFrame, second: DataFrame, key: str = "name",
                values=("short", "verbose")) -> DataFrame:
    """Merged registry: key order of the first registry (then new keys of
    the second in their order), value of the later registry wins; idx =
    position + 1. Inputs: (name, pos, values...)."""
    a = first.select(key, F.lit(0).alias("_src"), "pos", *values)
    b = second.select(key, F.lit(1).alias("_src"), "pos", *values)
    u = a.unionByName(b)
    g = u.groupBy(key).agg(F.min(F.struct("_src", "pos")).alias("_first"),
                           F.max_by(F.struct(*values), F.col("_src")).alias("_v"))
    w = Window.orderBy("_first")   # registries hold a handful of types
    return g.select(key, (F.row_number().over(w)).cast("int").alias("idx"),
                    *[F.col(f"_v.{v}").alias(v) for v in values])


def hconcat(a: DataFrame, b: DataFrame, keys, col_a: str, col_b: str, out: str) -> DataFrame:
    """Side-by-side concat of two row-aligned matrices."""
    keys = _k(keys)
    return a.join(b, keys).select(*keys, F.concat(col_a, col_b).alias(out))


def match_sets(gold: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Set union of gold and predicted tuples with membership flags."""
    both = gold.select(*keys, F.lit(True).alias("_g")).unionByName(pred.select(*keys, F.lit(False).alias("_g")))
    # a tuple with a null equals none of the other side
    side = F.when(F.coalesce(*[F.when(F.col(k).isNull(), True) for k in keys]), F.col("_g"))
    return both.groupBy(*keys, side.alias("_s")).agg(F.bool_or("_g").alias("in_gold"), F.bool_or(~F.col("_g")).alias("in_pred")).drop("_s")


def overlapping(mentions: DataFrame, doc_keys, start: str = "start", end: str = "end",
                type_col: str = "type") -> DataFrame:
    """D10 (sweep form): distinct (span, type) tuples that overlap another,
    different tuple of the same document: an earlier tuple (in (start, end,
    type) order) reaching past this start, or the next tuple starting before
    this end. One sort per document; no pair blow-up."""
    doc_keys = _k(doc_keys)
    d = mentions.select(*doc_keys, start, end, type_col).distinct()
    w = Window.partitionBy(*doc_keys).orderBy(start, end, type_col)
    prev_end = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.lead(start).over(w)
    d = d.withColumn("_ov", F.coalesce(prev_end > F.col(start), F.lit(False))
                     | F.coalesce(nxt < F.col(end), F.lit(False)))
    return d.filter("_ov").drop("_ov")


def has_any_overlap(mentions: DataFrame, doc_keys, docs: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """for every document of ``docs``, whether any two entries overlap
    (identical spans do count): running max(end) of earlier entries > start."""
    doc_keys = _k(doc_keys)
    w = Window.partitionBy(*doc_keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    d = mentions.withColumn("_ov", F.coalesce(F.max(end).over(w) > F.col(start), F.lit(False)))
    found = d.groupBy(*doc_keys).agg(F.bool_or("_ov").alias("has_overlap"))
    return docs.select(*doc_keys).join(found, doc_keys, "left").withColumn("has_overlap", F.coalesce("has_overlap", F.lit(False)))


def remove_overlapping(mentions: DataFrame, rels: DataFrame | None, doc_keys):
    """Drop every entity that overlaps another (both sides go;
    identical tuples do not count), and relations whose own two arguments
    overlap (not relations of removed entities)."""
    doc_keys = _k(doc_keys)
    ov = overlapping(mentions, doc_keys)
    ents = mentions.join(ov, [*doc_keys, "start", "end", "type"], "left_anti")
    if rels is None:
        return ents, None
    same = (F.col("hs") == F.col("ts_")) & (F.col("he") == F.col("te")) & (F.col("ht") == F.col("tt"))
    ovl = (F.col("hs") < F.col("te")) & (F.col("ts_") < F.col("he"))
    return ents, rels.filter(same | ~ovl)


def set_mismatch(gold: DataFrame, pred: DataFrame, doc_keys, value_cols: list[str], docs: DataFrame) -> DataFrame:
    """For every document of ``docs``, whether the gold set differs from
    the predicted set (a document missing on a side has an empty set there)."""
    doc_keys = _k(doc_keys)
    m = match_sets(gold, pred, [*doc_keys, *value_cols])
    found = m.groupBy(*doc_keys).agg(F.bool_or(F.col("in_gold") != F.col("in_pred")).alias("mismatch"))
    return docs.select(*doc_keys).join(found, doc_keys, "left").withColumn("mismatch", F.coalesce("mismatch", F.lit(False)))
