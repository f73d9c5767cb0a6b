"""Rows that the given tables hold none of: null keys, one class, tabs around labels."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.text import normalize_label, strip_span
from tessera.operators.asof import asof_nearest
from tessera.operators.metrics import roc_curve


def test_null_keys_meet_nothing(spark):
    day = dt.date(2024, 1, 1)
    left = spark.createDataFrame([("a", day), (None, day)], "k string, d date")
    right = spark.createDataFrame([("a", day, "A"), (None, day, "NULLKEY")], "k string, d date, label string")
    right = right.select("k", "d", "label")
    rows = {r["k"]: (r["label"], r["delta"]) for r in asof_nearest(left, right, ["k"], "d", ["label"]).collect()}
    assert rows == {"a": ("A", 0), None: (None, None)}


def test_roc_curve_of_one_class_has_null_rates(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4)], "y_true int, score double")
    rows = sorted(tuple(r) for r in roc_curve(df).collect())
    assert [(t, f) for t, f, _ in rows] == [(0.4, None), (0.9, None)]
    assert sorted(r[2] for r in rows) == [0.5, 1.0]


def test_white_space_of_any_kind_is_stripped(spark):
    df = spark.createDataFrame([("\tCN \r\n",)], "t string")
    assert df.select(normalize_label("t")).first()[0] == "CN"
    s = df.select(strip_span(F.col("t"), F.lit(10), F.lit(16)).alias("s")).first()["s"]
    assert (s["text"], s["start"], s["end"]) == ("CN", 11, 13)
