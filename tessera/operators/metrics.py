"""Prediction decoding (E1-E3) and evaluation aggregates.

Strict scores take one pass: gold and predicted tuples are one table, grouped
by tuple to see which sides hold it; counts per type and over all types are
grouping sets of one aggregate over that, with partial (map-side) aggregation.
Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax
from tessera.operators.splits import global_cumsum


def _k(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def sdiv(a, b):
    """Zero-division -> 0 (sklearn zero_division=0), ANSI-safe."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


# ---- E1-E3: decoding ----------------------------------------------------------------------

def decode_entities(df: DataFrame, scores: str = "scores", mask: str = "mask") -> DataFrame:
    """Type index = argmax(scores) (first on ties) times the sample mask;
    index 0 (None) is dropped; score = probability of the chosen type."""
    t = (argmax(scores) * F.col(mask).cast("int")).cast("int")
    d = df.withColumn("type_idx", t).filter(F.col("type_idx") != 0)
    return d.withColumn("score", F.element_at(scores, F.col("type_idx") + 1))


def decode_relations(df: DataFrame, scores: str = "scores", threshold: float = 0.4) -> DataFrame:
    """Scores strictly below the threshold become 0 (equal is kept); each
    remaining non-zero (pair, type) is a relation with type index col + 1."""
    from tessera.operators.spans import explode_rows
    cols = [c for c in df.columns if c != scores]
    e = explode_rows(df, cols, scores, "_c", "score")
    e = e.withColumn("score", F.when(F.col("score") < threshold, F.lit(0.0)).otherwise(F.col("score")))
    return e.filter(F.col("score") != 0).withColumn("type_idx", (F.col("_c") + 1).cast("int")).drop("_c")


def dedup_relations(rels: DataFrame, doc_keys, key_cols: list[str], order: str) -> DataFrame:
    """Keep the first occurrence (by ``order``) of each relation key; its
    score stays (not the best one)."""
    doc_keys = _k(doc_keys)
    w = Window.partitionBy(*doc_keys, *key_cols).orderBy(order)
    return rels.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# ---- E4-E9: strict-match evaluation ---------------------------------------------------------

def memberships(gold: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct tuples of both sides (``keys``, null-safe) with in_gold and in_pred: one union, one aggregate."""
    both = gold.select(*keys, F.lit(True).alias("_g")).unionByName(pred.select(*keys, F.lit(False).alias("_g")))
    return both.groupBy(*keys).agg(F.bool_or("_g").alias("in_gold"), F.bool_or(~F.col("_g")).alias("in_pred"))


def _counted():
    return [F.count_if(F.col("in_gold") & F.col("in_pred")).alias("tp"), F.count_if(~F.col("in_gold") & F.col("in_pred")).alias("fp"),
            F.count_if(F.col("in_gold") & ~F.col("in_pred")).alias("fn")]


def score_counts(members: DataFrame, type_col: str = "type") -> DataFrame:
    """Per type TP / FP / FN over the per-document set union of tuples (``memberships``)."""
    return members.groupBy(type_col).agg(*_counted())


def prf_report(members: DataFrame, type_col: str = "type", by: list[str] = (), scale: float = 100.0) -> DataFrame:
    """Per-type precision / recall / F1 / support, then 'micro' (pooled
    counts) and 'macro' (mean of per-type values) rows, all for each ``by``; zero division -> 0.
    Labels = types present in gold or prediction. Per-type and pooled counts are grouping
    sets of one aggregate; each type's row then stands for itself and in the mean."""
    by = list(by)
    c = members.groupingSets([[*by, type_col], by], *by, type_col).agg(F.grouping(type_col).alias("_all"), *_counted())
    p = sdiv(F.col("tp"), F.col("tp") + F.col("fp"))
    r = sdiv(F.col("tp"), F.col("tp") + F.col("fn"))
    c = c.select(*by, type_col, "_all", p.alias("precision"), r.alias("recall"), (F.col("tp") + F.col("fn")).alias("support"))
    f1 = sdiv(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    label = F.when(F.col("_all") == 1, F.array(F.lit("micro"))).otherwise(F.array(F.col(type_col), F.lit("macro")))
    rows = c.select(*by, F.explode(label).alias("label"), "precision", "recall", f1.alias("f1"), "support")
    return rows.groupBy(*by, "label").agg(*[(F.avg(m) * scale).alias(m) for m in ("precision", "recall", "f1")], F.sum("support").alias("support"))


def format_report(report: DataFrame) -> DataFrame:
    """E8: '%.2f' strings and the integer support."""
    return report.select("label", *[F.format_string("%.2f", F.col(c)).alias(c)
                                    for c in ("precision", "recall", "f1")], "support")


def doc_examples(gold: DataFrame, pred: DataFrame, doc_keys, value_cols: list[str],
                 docs: DataFrame, score: str = "score") -> DataFrame:
    """For every document of ``docs``: micro P/R/F1 x100 (100 each when
    both sides are empty), TP / FN / FP lists of ``values:score``; TP and FP
    sorted by score desc, FN score -1."""
    doc_keys = _k(doc_keys)
    keys = [*doc_keys, *value_cols]
    g = gold.select(*keys, F.lit(None).cast(pred.schema[score].dataType).alias(score), F.lit(True).alias("_g"))
    both = g.unionByName(pred.select(*keys, score, F.lit(False).alias("_g")))   # one table and one aggregate, as in ``memberships``
    m = both.groupBy(*keys).agg(F.first(score, ignorenulls=True).alias(score), F.bool_or("_g").alias("in_gold"), F.bool_or(~F.col("_g")).alias("in_pred"))
    item = F.concat_ws(":", *[F.col(c).cast("string") for c in value_cols])
    tp = F.col("in_gold") & F.col("in_pred")
    a = m.groupBy(*doc_keys).agg(
        F.count_if(tp).alias("n_tp"), F.count_if(F.col("in_gold") & ~F.col("in_pred")).alias("n_fn"),
        F.count_if(~F.col("in_gold") & F.col("in_pred")).alias("n_fp"),
        F.sort_array(F.collect_list(F.when(tp, F.struct((-F.col(score)).alias("k"), item.alias("v"))))).alias("_tp"),
        F.sort_array(F.collect_list(F.when(~F.col("in_gold") & F.col("in_pred"),
                                           F.struct((-F.col(score)).alias("k"), item.alias("v"))))).alias("_fp"),
        F.sort_array(F.collect_list(F.when(F.col("in_gold") & ~F.col("in_pred"), item))).alias("fn"))
    a = docs.select(*doc_keys).join(a, doc_keys, "left").fillna(0, ["n_tp", "n_fn", "n_fp"])
    p_ = sdiv(F.col("n_tp"), F.col("n_tp") + F.col("n_fp"))
    r_ = sdiv(F.col("n_tp"), F.col("n_tp") + F.col("n_fn"))
    f_ = sdiv(2 * p_ * r_, p_ + r_)
    none = F.array().cast("array<string>")
    empty = (F.col("n_tp") + F.col("n_fn") + F.col("n_fp")) == 0
    return a.select(*doc_keys, "n_tp", "n_fn", "n_fp",
                    F.when(empty, 100.0).otherwise(p_ * 100).alias("precision"),
                    F.when(empty, 100.0).otherwise(r_ * 100).alias("recall"),
                    F.when(empty, 100.0).otherwise(f_ * 100).alias("f1"),
                    *[F.coalesce(F.transform(f"_{c}", lambda z: F.concat_ws(":", z["v"], (-z["k"]).cast("string"))), none).alias(c)
                      for c in ("tp", "fp")],
                    F.coalesce(F.transform("fn", lambda v: F.concat(v, F.lit(":-1.0"))), none).alias("fn"))


# ---- E11-E17: classification metrics -----------------------------------------------------------

def accuracy(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, n) for every label pair, zero-filled. The label
    set is collected as one bounded array (K classes) and exploded twice."""
    counts = df.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))
    labels = df.select(F.array_union(F.collect_set(y), F.collect_set(p)).alias("L"))
    grid = labels.select(F.explode("L").alias(y), "L").select(y, F.explode("L").alias(p))
    return grid.join(counts, [y, p], "left").fillna(0, ["n"])


def per_class_counts(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """tp / fp / fn per label (labels seen in truth or prediction)."""
    t = df.select(F.col(y).alias("label"), (F.col(y) == F.col(p)).alias("hit"), F.lit("t").alias("side"))
    q = df.select(F.col(p).alias("label"), (F.col(y) == F.col(p)).alias("hit"), F.lit("p").alias("side"))
    u = t.unionByName(q)
    return u.groupBy("label").agg(
        F.count_if((F.col("side") == "t") & F.col("hit")).alias("tp"),
        F.count_if((F.col("side") == "p") & ~F.col("hit")).alias("fp"),
        F.count_if((F.col("side") == "t") & ~F.col("hit")).alias("fn"))


def classification_report(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Per-class P/R/F1/support, accuracy, macro avg, weighted avg."""
    c = per_class_counts(df, y, p).withColumn("support", F.col("tp") + F.col("fn"))
    pr = sdiv(F.col("tp"), F.col("tp") + F.col("fp"))
    rc = sdiv(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = sdiv(2 * pr * rc, pr + rc)
    per = c.select(F.col("label").cast("string").alias("label"), pr.alias("precision"),
                   rc.alias("recall"), f1.alias("f1"), F.col("support").cast("long").alias("support"))
    n = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("label"),
                       (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"), n.alias("support"))
    acc = df.agg(F.lit("accuracy").alias("label"),
                 F.avg((F.col(y) == F.col(p)).cast("double")).alias("precision"),
                 F.avg((F.col(y) == F.col(p)).cast("double")).alias("recall"),
                 F.avg((F.col(y) == F.col(p)).cast("double")).alias("f1"),
                 F.count(F.lit(1)).alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, y: str = "y_true", score: str = "score") -> DataFrame:
    """Binary ROC-AUC (Mann-Whitney, ties count half). Scores are first
    reduced to distinct values with (pos, neg) counts, then a scalable
    running sum of negatives gives the rank statistic. Null when one class is
    missing."""
    g = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    c = global_cumsum(g, "s", ["neg"])
    t = c.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
              F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return t.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                           F.col("u") / (F.col("P") * F.col("N"))).alias("auc"))


def roc_curve(df: DataFrame, y: str = "y_true", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending; the rate of a class without rows is null."""
    g = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    g = g.withColumn("neg_s", -F.col("s"))
    c = global_cumsum(g, "neg_s", ["pos", "neg"])
    return c.select(F.col("s").alias("threshold"), F.try_divide("cum_neg", "total_neg").alias("fpr"),
                    F.try_divide("cum_pos", "total_pos").alias("tpr"))


def auc_ovr_hard(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One-vs-rest AUC of hard labels = mean over classes of
    (TPR + TNR) / 2, aligned by label (the reference aligns by column
    position of observed classes; documented difference)."""
    # every row is a tp or fn of its own label, so their total over labels is the number of rows
    c = per_class_counts(df, y, p).withColumn("_n", F.sum(F.col("tp") + F.col("fn")).over(Window.partitionBy()))   # one row a class
    tn = F.col("_n") - F.col("tp") - F.col("fp") - F.col("fn")
    tpr = sdiv(F.col("tp"), F.col("tp") + F.col("fn"))
    tnr = sdiv(tn, tn + F.col("fp"))
    return c.agg(F.avg((tpr + tnr) / 2).alias("auc_ovr"))


# ---- E18-E22: losses and errors ------------------------------------------------------------------

def epoch_loss(df: DataFrame, epoch: str, batch: str, loss: str) -> DataFrame:
    """Mean of batch means per epoch, and mean per sample."""
    b = df.groupBy(epoch, batch).agg(F.avg(loss).alias("_bm"), F.sum(loss).alias("_s"),
                                     F.count(F.lit(1)).alias("_n"))
    return b.groupBy(epoch).agg(F.avg("_bm").alias("mean_batch_loss"),
                                (F.sum("_s") / F.sum("_n")).alias("mean_sample_loss"))


def cross_entropy_rows(df: DataFrame, logits: str, y: str) -> DataFrame:
    """Per-row -log_softmax(logits)[y]."""
    from tessera.functions.arrays import log_softmax
    return df.withColumn("ce", -F.element_at(log_softmax(logits), F.col(y) + 1))


def masked_mean(df: DataFrame, loss: str, mask: str, batch: list[str], out: str) -> DataFrame:
    """Per batch the mean of ``loss`` over rows whose ``mask`` holds, null where none does, and how many do."""
    m = F.col(mask).cast("double")
    return df.groupBy(*batch).agg(F.try_divide(F.sum(F.col(loss) * m), F.sum(m)).alias(out), F.count_if(mask).alias(f"n_{out}"))


def bce_rows(df: DataFrame, logits: str, targets: str) -> DataFrame:
    """Per row the mean over types of the binary cross-entropy of logits and 0/1 targets, stable for large logits:
    max(x, 0) - x t + log(1 + exp(-|x|))."""
    each = F.zip_with(F.col(logits), F.col(targets), lambda x, t: F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x))))
    return df.withColumn("bce", F.aggregate(each, F.lit(0.0), lambda a, v: a + v) / F.size(logits))


def masked_bce(df: DataFrame, logits: str, targets: str, mask: str, batch: list[str]) -> DataFrame:
    """(batch, rel_loss, n_rel_loss): masked mean of the pairs' losses, null in a batch without a valid pair."""
    return masked_mean(bce_rows(df, logits, targets), "bce", mask, batch, "rel_loss")


def joint_loss(entity: DataFrame, relation: DataFrame, batch: list[str], entity_loss: str = "entity_loss", rel_loss: str = "rel_loss") -> DataFrame:
    """train_loss = entity loss + relation loss; the relation part is left out where it has no valid pair."""
    j = entity.join(relation, batch, "left")
    return j.withColumn("train_loss", F.col(entity_loss) + F.coalesce(F.col(rel_loss), F.lit(0.0)))


def label_smoothing_loss(df: DataFrame, logits: str, y: str, eps: float, width: int) -> DataFrame:
    """Sum over rows and classes of -q * log_softmax with q = (1-eps) on
    the gold class and eps/(width-1) elsewhere; width = max label + 1."""
    from tessera.functions.arrays import log_softmax
    ls = log_softmax(logits)
    q = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.when(
        j == F.col(y), F.lit(1.0 - eps)).otherwise(F.lit(eps / (width - 1))))
    term = F.aggregate(F.zip_with(q, ls, lambda a, b: -a * b), F.lit(0.0), lambda a, x: a + x)
    return df.agg(F.sum(term).alias("loss"))


def rel_error(df: DataFrame, x: str, y: str, eps: float = 1e-8) -> DataFrame:
    """max|x-y| / max(max(|x|+|y|), eps) over all elements."""
    e = df.select(F.explode(F.arrays_zip(F.col(x).alias("a"), F.col(y).alias("b"))).alias("z"))
    return e.agg((F.max(F.abs(F.col("z.a") - F.col("z.b"))) /
                  F.greatest(F.max(F.abs("z.a") + F.abs("z.b")), F.lit(eps))).alias("rel_error"))


# ---- E23-E27 ---------------------------------------------------------------------------------------

def psnr(df: DataFrame, a: str, b: str, data_range: float = 1.0) -> DataFrame:
    """Per-pair PSNR = 10 log10(range^2 / mse)."""
    mse = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                      lambda s, v: s + v) / F.size(a)
    return df.withColumn("psnr", 10 * F.log10(F.lit(data_range * data_range) / mse))


def best_epoch(hist: DataFrame, epoch: str, metric: str, mode: str = "max") -> DataFrame:
    """First epoch with the best value (strict improvement wins)."""
    key = F.struct((F.col(metric) if mode == "max" else -F.col(metric)).alias("m"), (-F.col(epoch)).alias("e"))
    return hist.agg(F.max_by(F.col(epoch), key).alias("best_epoch"))


def early_stop(hist: DataFrame, epoch: str, metric: str, patience: int, mode: str = "min",
               keys=()) -> DataFrame:
    """First epoch at which ``patience`` epochs passed without a strict
    improvement of the running best. One history per key (small tables)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(epoch)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min(metric).over(prior) if mode == "min" else F.max(metric).over(prior)
    improved = best_before.isNull() | ((F.col(metric) < best_before) if mode == "min" else (F.col(metric) > best_before))
    d = hist.withColumn("_imp", improved)
    d = d.withColumn("_last_imp", F.max(F.when(F.col("_imp"), F.col(epoch))).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_since", F.col(epoch) - F.col("_last_imp"))
    return d.groupBy(*keys).agg(F.min(F.when(F.col("_since") >= patience, F.col(epoch))).alias("stop_epoch"))
