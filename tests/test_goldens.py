"""Unit goldens: published expected values (transcribed as numbers) and
hand-worked rule cases."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as X
from tessera.operators import metrics as M
from tessera.operators import sequence as Q
from tessera.operators import vectors as V
from tessera.operators.asof import asof_nearest, asof_nearest_small


def test_normalize_label(spark):
    df = spark.createDataFrame([("SMC",), ("EMCI",), ("Dementia",), (" cn ",), ("",), ("XX",), (None,)], "dx string")
    got = [r[0] for r in df.select(X.normalize_label("dx")).collect()]
    assert got == ["CN", "MCI", "AD", "CN", None, None, None]


def test_parse_filename(spark):
    df = spark.createDataFrame([("dir/002_S_0295__2006-05-09__S118671.5T.csv.gz",), ("bad_name.csv",)], "p string")
    rows = df.select(X.parse_filename("p").alias("x")).collect()
    assert (rows[0].x.ptid, rows[0].x.date, rows[0].x.tag) == ("002_S_0295", "2006-05-09", "S118671.5T")
    assert rows[1].x is None


def test_asof_hand_case(spark):
    labels = spark.createDataFrame([("p", dt.date(2020, 1, 1), "CN", 1), ("p", dt.date(2020, 1, 11), "AD", 2)],
                                   "ptid string, d date, dx string, tie int")
    scans = spark.createDataFrame([(1, "p", dt.date(2020, 1, 6)), (2, "p", dt.date(2020, 1, 11)),
                                   (3, "p", dt.date(2020, 1, 9)), (4, "q", dt.date(2020, 1, 9))],
                                  "sid int, ptid string, d date")
    out = asof_nearest(scans, labels.withColumnRenamed("d", "ld"), ["ptid"], "d", ["dx"], tie="tie",
                       right_on="ld", bucket_width=2)
    got = {r.sid: (r.dx, r.delta) for r in out.collect()}
    assert got == {1: ("CN", 5), 2: ("AD", 0), 3: ("AD", 2), 4: (None, None)}


def test_asof_scale_equals_small(spark):
    rng = np.random.default_rng(7)
    left = [(int(i), int(rng.integers(0, 5)), int(rng.integers(0, 400))) for i in range(300)]
    right = [(int(i), int(rng.integers(0, 5)), int(rng.integers(0, 400))) for i in range(200)]
    L = spark.createDataFrame(left, "lid int, k int, t long")
    R = spark.createDataFrame(right, "rid int, k int, rt long").withColumn("t", F.col("rt"))
    a = asof_nearest(L, R.select("k", "t", "rid"), ["k"], "t", ["rid"], tie="rid", bucket_width=16)
    b = asof_nearest_small(L, R.select("k", "t", "rid"), ["k"], "t", ["rid"], tie="rid")
    assert sorted(map(tuple, a.select("lid", "rid", "delta").collect())) == \
        sorted(map(tuple, b.select("lid", "rid", "delta").collect()))


def test_between_span(spark):
    df = spark.createDataFrame([(1, 3, 5, 6), (5, 6, 1, 3), (1, 3, 3, 4), (1, 4, 2, 6)], "a int, b int, c int, d int")
    got = [(r.x.start, r.x.end) for r in df.select(A.between_span("a", "b", "c", "d").alias("x")).collect()]
    assert got[0] == (3, 5) and got[1] == (3, 5)
    assert got[2][0] >= got[2][1] and got[3][0] >= got[3][1]


def test_encode_sequence_golden(spark):
    df = spark.createDataFrame([("BOS POSITIVE 0333 add POSITIVE 0696 EOS",),
                                ("BOS NEGATIVE 0286 subtract NEGATIVE 0044 EOS",)], "e string")
    got = [list(r[0]) for r in df.select(Q.encode_sequence(F.col("e"))).collect()]
    assert got[0] == [14, 10, 0, 3, 3, 3, 12, 10, 0, 6, 9, 6, 15]
    assert got[1] == [14, 11, 0, 2, 8, 6, 13, 11, 0, 0, 4, 4, 15]


def test_positions_golden(spark):
    row = spark.range(1).select(A.position_sinusoid(4, 4).alias("p"), A.position_simple(4, 4).alias("s")).first()
    assert np.allclose(row.p[1], [0.84147, 0.54030, 0.84147, 0.54030], atol=1e-5)
    assert np.allclose(row.s[2], [0.5] * 4)


def test_layer_norm_golden(spark):
    x = np.linspace(-0.4, 0.6, 8).reshape(2, 4)
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "x array<double>")
    for r in df.select(A.layer_norm("x")).collect():
        assert np.allclose(r[0], [-1.34164, -0.44721, 0.44721, 1.34164], atol=1e-5)


def test_attention_golden(spark):
    q = np.linspace(-0.4, 0.6, 20).reshape(5, 4)
    k = np.linspace(-0.8, 0.5, 20).reshape(5, 4)
    v = np.linspace(-0.3, 0.8, 20).reshape(5, 4)
    mk = lambda a: spark.createDataFrame([(0, i, list(map(float, a[i]))) for i in range(5)], "g int, i int, x array<double>")
    out = V.attention(mk(q), mk(k), mk(v), "g", "i", "x").orderBy("i").collect()
    assert np.allclose(out[0].out, [0.08283, 0.14073, 0.19862, 0.25652], atol=1e-5)
    assert all(abs(r.p_sum - 1) < 1e-9 for r in out)


@pytest.mark.parametrize("cm, expect", [
    ([[256, 14], [67, 84]], {"accuracy": 0.8076, "wp": 0.8157, "wr": 0.8076, "wf": 0.7957, "mp": 0.8249, "mr": 0.7522, "mf": 0.7691}),
    ([[262, 8], [98, 53]], {"accuracy": 0.7482, "wp": 0.7784, "wr": 0.7482, "wf": 0.7128, "mp": 0.7983, "mr": 0.6607, "mf": 0.6659}),
])
def test_classification_report_golden(spark, cm, expect):
    rows = [(t, p) for t in range(2) for p in range(2) for _ in range(cm[t][p])]
    df = spark.createDataFrame(rows, "y_true int, y_pred int")
    rep = {r.label: r for r in M.classification_report(df).collect()}
    assert abs(rep["accuracy"].precision - expect["accuracy"]) < 1e-4
    assert abs(rep["weighted avg"].precision - expect["wp"]) < 1e-4
    assert abs(rep["weighted avg"].recall - expect["wr"]) < 1e-4
    assert abs(rep["weighted avg"].f1 - expect["wf"]) < 1e-4
    assert abs(rep["macro avg"].precision - expect["mp"]) < 1e-4
    assert abs(rep["macro avg"].recall - expect["mr"]) < 1e-4
    assert abs(rep["macro avg"].f1 - expect["mf"]) < 1e-4
