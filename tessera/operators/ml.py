"""Model fitting and scoring on feature tables (I1-I5), with pyspark.ml
estimators (distributed, iterative); evaluation reuses the E operators."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def features(df: DataFrame, arr: str, label: str | None = None) -> DataFrame:
    out = df.withColumn("features", array_to_vector(F.col(arr).cast("array<double>")))
    if label:
        out = out.withColumn("label", F.col(label).cast("double"))
    return out


def fit_softmax(train: DataFrame, max_iter: int = 50, reg: float = 0.0):
    """Multinomial logistic regression (cross-entropy)."""
    return LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg).fit(train)


def fit_mlp(train: DataFrame, layers: list[int], max_iter: int = 50, seed: int = 1):
    """Feed-forward classifier."""
    return MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed).fit(train)


def score(model, df: DataFrame, id_col: str) -> DataFrame:
    """(id, y_pred, probability array, p_max)."""
    p = model.transform(df)
    return p.select(id_col, F.col("prediction").cast("int").alias("y_pred"),
                    vector_to_array("probability").alias("prob")).withColumn("p_max", F.array_max("prob"))


def compare_models(reports: dict[str, DataFrame]) -> DataFrame:
    """I4: classification reports side by side (one row per model x label)."""
    out = None
    for name, rep in reports.items():
        r = rep.withColumn("model", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out
