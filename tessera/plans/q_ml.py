"""Fitting and scoring (iterative; rows-only checks) plus the
remaining file-layout readers (A10, A11)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import ml as ML
from tessera.plans.registry import query
from tessera.session import checkpoint_dir, table


def _split(spark, sf):
    e = table(spark, sf, "embeddings")
    f = ML.features(e, "embedding", "label")
    return f.filter(F.col("vec_id") % 2 == 1), f.filter(F.col("vec_id") % 2 == 0)


def _eval(model, test):
    s = ML.score(model, test, "vec_id").join(test.select("vec_id", F.col("label").cast("int").alias("y_true")), "vec_id")
    return s


@query("i1_fit_softmax")
def i1(spark, sf):
    train, test = _split(spark, sf)
    s = _eval(ML.fit_softmax(train), test)
    return s.select("vec_id", "y_true", "y_pred", F.round("p_max", 6).alias("p_max"))


@query("i2_fit_mlp")
def i2(spark, sf):
    train, test = _split(spark, sf)
    s = _eval(ML.fit_mlp(train, [64, 16, 10]), test)
    return s.select("vec_id", "y_true", "y_pred", F.round("p_max", 6).alias("p_max"))


@query("i3_score")
def i3(spark, sf):
    train, test = _split(spark, sf)
    s = ML.score(ML.fit_softmax(train, max_iter=20), test, "vec_id")
    return s.select("vec_id", "y_pred", F.size("prob").alias("n_classes"), F.round("p_max", 6).alias("p_max"))


@query("i4_compare_models")
def i4(spark, sf):
    train, test = _split(spark, sf)
    reps = {"softmax": M.classification_report(_eval(ML.fit_softmax(train), test)),
            "mlp": M.classification_report(_eval(ML.fit_mlp(train, [64, 16, 10]), test))}
    return ML.compare_models(reps)


@query("i5_transfer_eval")
def i5(spark, sf):
    """Train on the merged corpora (both halves of the labelled vectors
    except the held-out part of corpus B), evaluate on each corpus's
    held-out part separately."""
    e = ML.features(table(spark, sf, "embeddings"), "embedding", "label")
    corpus = F.when(F.col("vec_id") % 2 == 1, "A").otherwise("B")
    held = (F.col("vec_id") % 5) == 0
    e = e.withColumn("corpus", corpus).withColumn("held", held)
    model = ML.fit_softmax(e.filter(~F.col("held")))
    out = None
    for c in ("A", "B"):
        test = e.filter(F.col("held") & (F.col("corpus") == c))
        acc = M.accuracy(_eval(model, test)).withColumn("corpus", F.lit(c))
        out = acc if out is None else out.unionByName(acc)
    return out.select("corpus", F.round("accuracy", 6).alias("accuracy"))
