"""H1-H6, H15, H16, C28 (causal attention), E23-E24 (image pairs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import metrics as M
from tessera.operators import vectors as V
from tessera.plans.registry import query
from tessera.session import table

EMB = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"


def emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))


@query("h1_zscore", f"""
SELECT vec_id, d, round((x - avg(x) OVER w) / nullif(stddev_samp(x) OVER w, 0), 6) AS z FROM (
  SELECT vec_id, unnest(generate_series(0, 63)) AS d, unnest(e) AS x FROM ({EMB}))
WINDOW w AS (PARTITION BY vec_id, d % 8)""")
def h1(spark, sf):
    lg = V.to_long(emb(spark, sf), ["vec_id"], "e").withColumn("ch", F.col("d") % 8)
    z = V.zscore(lg, ["vec_id", "ch"], "x")
    return z.select("vec_id", F.col("d").cast("bigint").alias("d"), F.round("z", 6).alias("z"))


@query("h2_reshape_grid", f"""
SELECT vec_id, CAST(d % 4 AS INTEGER) AS c, CAST((d // 4) // 4 AS INTEGER) AS r, CAST((d // 4) % 4 AS INTEGER) AS col, x
FROM (SELECT vec_id, unnest(generate_series(0, 63)) AS d, unnest(e) AS x FROM ({EMB}))""")
def h2(spark, sf):
    lg = V.to_long(emb(spark, sf), ["vec_id"], "e")
    lg = lg.withColumn("point", F.floor(F.col("d") / 4)).withColumn("channel", (F.col("d") % 4).cast("int"))
    g = V.reshape_grid(lg, "point", "channel", 4)
    return g.select("vec_id", F.col("c").cast("int").alias("c"), "r", "col", "x")


@query("h3_layer_norm", f"""
SELECT vec_id, round(y[1], 6) AS y0, round(y[2], 6) AS y1, round(list_sum(list_transform(y, lambda t: t * t)), 6) AS sumsq FROM (
  SELECT vec_id, list_transform(e, lambda x: (x - mu) / (sqrt(var) + 1e-10)) AS y FROM (
    SELECT vec_id, e, list_avg(e) AS mu,
           list_avg(list_transform(e, lambda x: (x - list_avg(e)) * (x - list_avg(e)))) AS var FROM ({EMB})))""")
def h3(spark, sf):
    e = emb(spark, sf).withColumn("y", A.layer_norm("e"))
    return e.select("vec_id", F.round(F.element_at("y", 1), 6).alias("y0"), F.round(F.element_at("y", 2), 6).alias("y1"),
                    F.round(A.arr_sum(F.transform("y", lambda t: t * t)), 6).alias("sumsq"))


W_LIN = [[((i * 64 + j) % 7 - 3) / 10 for j in range(64)] for i in range(3)]
B_LIN = [0.1, -0.2, 0.3]


def _lin_sql(i):
    return (f"greatest(list_sum(list_transform(generate_series(1, 64), lambda j: e[j] * ((({i} * 64 + j - 1) % 7) - 3) / 10.0))"
            f" + {B_LIN[i]}, 0.0)")


@query("h4_linear", f"""
SELECT vec_id, {', '.join(f'round({_lin_sql(i)}, 6) AS o{i}' for i in range(3))} FROM ({EMB})""")
def h4(spark, sf):
    e = emb(spark, sf).withColumn("o", V.linear(F.col("e"), W_LIN, B_LIN, relu=True))
    return e.select("vec_id", *[F.round(F.element_at("o", i + 1), 6).alias(f"o{i}") for i in range(3)])


#: Positions of a sequence made from neighbouring vectors.
SEQ = 100


def micro(arr):
    """A vector as text of millionths, which every engine prints alike."""
    return F.array_join(F.transform(arr, lambda x: F.round(x * 1e6).cast("long").cast("string")), ",")


def micro_sql(arr):
    return f"array_to_string(list_transform({arr}, lambda x: CAST(round(x * 1e6) AS BIGINT)), ',')"


_SEQ_SQL = f"SELECT vec_id // {SEQ} AS g, vec_id % {SEQ} AS i, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


def _softmax_sql(q, k, v, dim, causal=False):
    """(g, qi, d, o): attention by all pairs of one sequence."""
    s = f"list_dot_product(q.x, k.x) / sqrt({dim})"
    if causal:
        s = f"CASE WHEN k.i > q.i THEN -1e9 ELSE {s} END"
    return f"""
  SELECT p.g, p.qi, d, sum(p.p * v.x[d]) AS o FROM (
    SELECT g, qi, ki, e / sum(e) OVER (PARTITION BY g, qi) AS p FROM (
      SELECT g, qi, ki, exp(s - max(s) OVER (PARTITION BY g, qi)) AS e FROM (
        SELECT q.g, q.i AS qi, k.i AS ki, {s} AS s FROM {q} q JOIN {k} k ON q.g = k.g))) p
  JOIN {v} v ON v.g = p.g AND v.i = p.ki, (SELECT unnest(generate_series(1, {dim})) AS d) GROUP BY ALL"""


def _att_sql(causal: bool):
    return f"""
WITH seq AS MATERIALIZED ({_SEQ_SQL})
SELECT g AS grp, qi AS pos, {micro_sql('list(o ORDER BY d)')} AS out FROM ({_softmax_sql('seq', 'seq', 'seq', 64, causal)}) GROUP BY g, qi"""


def _seq(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.expr(f"vec_id div {SEQ}").alias("grp"), (F.col("vec_id") % SEQ).alias("pos"),
                    F.col("embedding").cast("array<double>").alias("x"))


def _att(spark, sf, causal):
    s = _seq(spark, sf)
    return V.attention(s, s, s, "grp", "pos", "x", causal=causal).select("grp", "pos", micro("out").alias("out"))


@query("h5_attention", _att_sql(False))
def h5(spark, sf):
    return _att(spark, sf, False)


@query("c28_causal_attention", _att_sql(True))
def c28(spark, sf):
    return _att(spark, sf, True)


#: Two heads of 32 dimensions over all 64: weights (query, key, value) of each head, and of the output.
HEAD = 32
W_HEAD = [[[[((i * 64 + j * (3 + s) + 5 * h) % 11 - 5) / 20 for j in range(64)] for i in range(HEAD)] for s in range(3)] for h in range(2)]
W_OUT = [[((i * 64 + j) % 5 - 2) / 4 for j in range(64)] for i in range(8)]


def _head_sql(h, s):
    return (f"(SELECT g, i, list_transform(generate_series(0, {HEAD - 1}), lambda a: list_sum(list_transform(generate_series(0, 63), "
            f"lambda b: x[b + 1] * ((a * 64 + b * {3 + s} + {5 * h}) % 11 - 5) / 20.0))) AS x FROM seq)")


def _h6_sql():
    heads = ", ".join(f"{n}{h} AS MATERIALIZED {_head_sql(h, s)}" for h in range(2) for s, n in enumerate("qkv"))
    both = " UNION ALL ".join(f"SELECT g, qi, d + {h * HEAD} AS d, o FROM ({_softmax_sql(f'q{h}', f'k{h}', f'v{h}', HEAD)})" for h in range(2))
    return f"""
WITH seq AS MATERIALIZED ({_SEQ_SQL}), {heads}, o AS (SELECT g, qi, list(o ORDER BY d) AS o FROM ({both}) GROUP BY g, qi)
SELECT g AS grp, qi AS pos, {micro_sql("list_transform(generate_series(0, 7), lambda a: list_sum(list_transform(generate_series(0, 63), lambda b: o[b + 1] * ((a * 64 + b) % 5 - 2) / 4.0)))")} AS y FROM o"""


@query("h6_multi_head", _h6_sql())
def h6(spark, sf):
    """Two heads of 32 dimensions, projected from all 64, concatenated and projected to 8."""
    return V.multi_head(_seq(spark, sf), "grp", "pos", "x", [tuple(w) for w in W_HEAD], W_OUT).select("grp", "pos", micro("y").alias("y"))


@query("h15_pool", f"""
SELECT label, CAST(d AS INTEGER) AS d, round(max(x), 6) AS m, round(avg(x), 6) AS a FROM (
  SELECT label, unnest(generate_series(0, len(e) - 1)) AS d, unnest(e) AS x FROM ({EMB})) GROUP BY ALL""")
def h15(spark, sf):
    return V.pool(emb(spark, sf), ["label"], "e").select("label", "d", F.round("max", 6).alias("m"), F.round("mean", 6).alias("a"))


@query("h15_pick_token", f"""
SELECT vec_id // {SEQ} AS grp, vec_id % {SEQ} AS pos, {micro_sql('e')} AS vec FROM ({EMB}) WHERE label = 3""")
def h15_pick(spark, sf):
    """Token ids of a sequence are the labels of its vectors; those of id 3 are picked."""
    e = emb(spark, sf).select(F.expr(f"vec_id div {SEQ}").alias("grp"), (F.col("vec_id") % SEQ).alias("pos"), "label", "e")
    return V.pick_token(e.drop("label"), e.drop("e"), ["grp", "pos"], "label", 3).select("grp", "pos", micro("e").alias("vec"))


@query("h16_embed", f"""
SELECT ev.event_id, {micro_sql("list_transform(t.x, lambda x, i: x + CASE WHEN i % 2 = 1 THEN sin(ev.event_id % 8) ELSE cos(ev.event_id % 8) END)")} AS vec
FROM events ev JOIN (SELECT vec_id AS tok, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id < 16) t ON t.tok = ev.event_id % 16""")
def h16(spark, sf):
    ev = table(spark, sf, "events").select("event_id", (F.col("event_id") % 16).alias("tok"), (F.col("event_id") % 8).alias("p"))
    tab = table(spark, sf, "embeddings").filter(F.col("vec_id") < 16).select(
        F.col("vec_id").alias("tok"), F.col("embedding").cast("array<double>").alias("vec"))
    # one position vector a place, as wide as the token vectors
    wide = F.sequence(F.lit(0), F.lit((tab.agg(F.max(F.size("vec"))).first()[0] or 1) - 1))   # one number
    at = F.col("p").cast("double")
    pos = ev.select("p").distinct().select("p", F.transform(wide, lambda i: F.when(i % 2 == 0, F.sin(at)).otherwise(F.cos(at))).alias("vec"))
    return V.embed(ev, tab, "tok", "p", pos).select("event_id", micro("vec").alias("vec"))


def image_pairs(spark, sf):
    """8x8 images from embeddings: vec 2k with 2k+1, rescaled to [0, 1] by
    the table-wide min / max."""
    e = emb(spark, sf)
    lo, hi = e.select(F.explode("e").alias("x")).agg(F.min("x"), F.max("x")).first()   # two numbers
    sc = F.transform("e", lambda x: (x - F.lit(lo)) / F.lit(hi - lo))
    a = e.filter(F.col("vec_id") % 2 == 0).select(F.expr("vec_id div 2").alias("pair"), sc.alias("a"))
    b = e.filter(F.col("vec_id") % 2 == 1).select(F.expr("vec_id div 2").alias("pair"), sc.alias("b"))
    return a.join(b, "pair")


_PAIRS_SQL = f"""
WITH mm AS (SELECT min(x) AS lo, max(x) AS hi FROM (SELECT unnest(e) AS x FROM ({EMB}))),
s AS (SELECT vec_id, list_transform(e, lambda x: (x - lo) / (hi - lo)) AS e FROM ({EMB}) v, mm),
p AS (SELECT a.vec_id // 2 AS pair, a.e AS a, b.e AS b FROM s a JOIN s b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0)"""


@query("e23_psnr", _PAIRS_SQL + """
SELECT pair, round(10 * log10(1.0 / (list_sum(list_transform(generate_series(1, 64), lambda i: (a[i] - b[i]) * (a[i] - b[i]))) / 64)), 6) AS psnr FROM p""")
def e23(spark, sf):
    p = M.psnr(image_pairs(spark, sf), "a", "b", 1.0)
    return p.select("pair", F.round("psnr", 6).alias("psnr"))


def ssim_long(pairs, h: int = 8, w: int = 8, win: int = 7, data_range: float = 1.0):
    """SSIM with a win x win uniform window, sample covariance
    (N/(N-1)), K1=0.01, K2=0.03, border cropped (mean over windows fully
    inside the image). Pixels become rows; each window position gathers its
    win*win pixels by an equi-join on (pair, window) after exploding each
    pixel into the windows that contain it (at most win*win, bounded)."""
    px = pairs.select("pair", F.posexplode(F.arrays_zip("a", "b")).alias("i", "z")).select(
        "pair", (F.col("i") / w).cast("int").alias("r"), (F.col("i") % w).cast("int").alias("c"),
        F.col("z.a").alias("a"), F.col("z.b").alias("b"))
    nwin_r, nwin_c = h - win + 1, w - win + 1
    px = px.withColumn("wr", F.explode(F.sequence(F.greatest(F.col("r") - win + 1, F.lit(0)),
                                                  F.least(F.col("r"), F.lit(nwin_r - 1)))))
    px = px.withColumn("wc", F.explode(F.sequence(F.greatest(F.col("c") - win + 1, F.lit(0)),
                                                  F.least(F.col("c"), F.lit(nwin_c - 1)))))
    n = win * win
    g = px.groupBy("pair", "wr", "wc").agg(F.avg("a").alias("ua"), F.avg("b").alias("ub"),
                                           F.avg(F.col("a") * F.col("a")).alias("aa"), F.avg(F.col("b") * F.col("b")).alias("bb"),
                                           F.avg(F.col("a") * F.col("b")).alias("ab"))
    cov = n / (n - 1)
    c1, c2 = (0.01 * data_range) ** 2, (0.03 * data_range) ** 2
    vx = (F.col("aa") - F.col("ua") * F.col("ua")) * cov
    vy = (F.col("bb") - F.col("ub") * F.col("ub")) * cov
    vxy = (F.col("ab") - F.col("ua") * F.col("ub")) * cov
    s = ((2 * F.col("ua") * F.col("ub") + c1) * (2 * vxy + c2)) / (
        (F.col("ua") * F.col("ua") + F.col("ub") * F.col("ub") + c1) * (vx + vy + c2))
    return g.withColumn("s", s).groupBy("pair").agg(F.avg("s").alias("ssim"))


@query("e24_ssim", _PAIRS_SQL + """,
px AS (SELECT pair, (i - 1) // 8 AS r, (i - 1) % 8 AS c, a[i] AS a, b[i] AS b FROM p, LATERAL (SELECT unnest(generate_series(1, 64)) AS i) t),
g AS (SELECT w.pair, w.wr, w.wc, avg(a) AS ua, avg(b) AS ub, avg(a * a) AS aa, avg(b * b) AS bb, avg(a * b) AS ab
      FROM (SELECT DISTINCT pair FROM px) q, (SELECT unnest([0, 1]) AS wr) x, (SELECT unnest([0, 1]) AS wc) y,
           LATERAL (SELECT q.pair, x.wr, y.wc) w
      JOIN px ON px.pair = w.pair AND px.r BETWEEN w.wr AND w.wr + 6 AND px.c BETWEEN w.wc AND w.wc + 6
      GROUP BY ALL)
SELECT pair, round(avg(((2 * ua * ub + 0.0001) * (2 * (ab - ua * ub) * 49 / 48 + 0.0009)) /
   ((ua * ua + ub * ub + 0.0001) * ((aa - ua * ua) * 49 / 48 + (bb - ub * ub) * 49 / 48 + 0.0009))), 6) AS ssim
FROM g GROUP BY pair""")
def e24(spark, sf):
    s = ssim_long(image_pairs(spark, sf))
    return s.select("pair", F.round("ssim", 6).alias("ssim"))
