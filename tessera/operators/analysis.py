"""Exploratory and error analysis (F1-F16) over annotated documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Distance bins of the relation-distance error analysis (fixed values):
# [0,1) [1,2) ... [9,10) [10,100); a distance >= 100 falls in no bin.
DISTANCE_BINS = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8), (8, 9), (9, 10), (10, 100)]
DISTANCE_LABELS = ["0-1", "1-2", "2-3", "3-4", "4-5", "5-6", "6-7", "7-8", "8-9", "9-10", "10+"]


def type_distribution(rows: DataFrame, type_col: str = "type") -> DataFrame:
    """F1/F2."""
    return rows.groupBy(type_col).agg(F.count(F.lit(1)).alias("n"))


def density(docs: DataFrame, keys) -> DataFrame:
    """entities / relations / tokens per document."""
    return docs.select(*keys, F.size("entities").alias("n_entities"), F.size("relations").alias("n_relations"),
                       F.size("tokens").alias("n_tokens"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """equal-width bins over [min, max]; the last bin is closed on the
    right. All bins are returned (zero-filled); the bin table is ``bins``
    rows built from the one-row min/max aggregate."""
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()  # two numbers
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = grid.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                       (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"))
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if hi > lo else F.lit(0)
    counts = df.select(idx.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, "bin", "left").fillna(0, ["n"])


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """value counts, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def doc_error(gold: DataFrame, pred: DataFrame, keys) -> DataFrame:
    """a document is wrong when its relation lists differ as ordered
    lists of (type, head, tail) positions (not as sets)."""
    g = gold.select(*keys, F.col("relations").alias("_g"), F.col("entities").alias("_ge"))
    p = pred.select(*keys, F.col("relations").alias("_p"))
    j = g.join(p, keys)
    return j.select(*keys, "_ge", "_g", (~(F.col("_g") == F.col("_p"))).alias("is_error"))


def avg_relation_distance(docs: DataFrame) -> F.Column:
    """mean |head.start - tail.start| over a document's relations; 0 when
    it has none (and those zeros count in later means). Row-local."""
    ents = F.col("_ge") if "_ge" in docs.columns else F.col("entities")
    rels = F.col("_g") if "_g" in docs.columns else F.col("relations")
    d = F.transform(rels, lambda r: F.abs(F.element_at(ents, r["head"] + 1)["start"] - F.element_at(ents, r["tail"] + 1)["start"]))
    return F.when(F.size(rels) > 0, F.aggregate(d, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(rels)
                  ).otherwise(F.lit(0.0))


def distance_bin_errors(errs: DataFrame) -> DataFrame:
    """per relation of the gold documents, its head-tail distance bin;
    the document's error flag counts once per relation. All 11 bins, empty
    bins rate 0; distance >= 100 is in no bin."""
    r = errs.select("is_error", F.explode("_g").alias("r"), "_ge")
    start = lambda i: F.element_at("_ge", F.col(i) + 1)["start"]
    r = r.select("is_error", F.abs(start("r.head") - start("r.tail")).alias("dist"))
    b = None
    for i, (lo, hi) in enumerate(DISTANCE_BINS):
        cond = (F.col("dist") >= lo) & (F.col("dist") < hi)
        b = F.when(cond, F.lit(i)) if b is None else b.when(cond, F.lit(i))
    r = r.withColumn("bin", b).filter(F.col("bin").isNotNull())
    c = r.groupBy("bin").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_error").alias("errors"))
    spark = errs.sparkSession
    bins = spark.createDataFrame([(i, DISTANCE_LABELS[i]) for i in range(len(DISTANCE_BINS))], "bin int, label string")
    out = F.broadcast(bins).join(c, "bin", "left").fillna(0, ["total", "errors"])
    return out.withColumn("error_rate", F.when(F.col("total") > 0, F.col("errors") / F.col("total")).otherwise(F.lit(0.0)))
