"""Prediction decoding and evaluation aggregates as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators import spans as S
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query
from tessera.session import table

DOC = FX.DOC
R6 = 6
ENT = [*DOC, "start", "end", "type"]
REL = [*DOC, "hs", "he", "ts_", "te", "type"]


def _cands(spark, sf):
    g = S.to_mentions(FX.gold_docs(spark, sf), DOC)
    p = S.to_mentions(FX.pred_docs(spark, sf), DOC)
    return g.select(*DOC, "start", "end").unionByName(p.select(*DOC, "start", "end")).distinct()


def _ent_scores(c):
    scores = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: (
        (F.col("start") * 7 + F.col("end") * 3 + k * 5 + F.col("doc_id") + F.col("sent_no")) % 11) / 10.0)
    mask = (F.col("start") + F.col("end") + F.col("sent_no")) % 9 != 0
    return c.withColumn("scores", scores).withColumn("mask", mask)


_CANDS_SQL = """(SELECT DISTINCT doc_id, sent_no, "start", "end" FROM (
  SELECT doc_id, sent_no, "start", "end" FROM gold UNION ALL SELECT doc_id, sent_no, "start", "end" FROM pred))"""
_SCORES_SQL = f"""SELECT doc_id, sent_no, "start", "end",
  list_transform(generate_series(0, 5), lambda k: (("start" * 7 + "end" * 3 + k * 5 + doc_id + sent_no) % 11) / 10.0) AS sc,
  ("start" + "end" + sent_no) % 9 <> 0 AS mask FROM {_CANDS_SQL}"""


@query("e1_decode_entities", with_ctes(f"""
SELECT doc_id, sent_no, "start", "end", type_idx, round(sc[type_idx + 1], 6) AS score FROM (
  SELECT *, CAST((list_position(sc, list_max(sc)) - 1) * CAST(mask AS INTEGER) AS INTEGER) AS type_idx FROM ({_SCORES_SQL}))
WHERE type_idx <> 0""", "gold", "pred"))
def e1(spark, sf):
    d = M.decode_entities(_ent_scores(_cands(spark, sf)))
    return d.select(*DOC, "start", "end", "type_idx", F.round("score", R6).alias("score"))


def _rel_scores(spark, sf):
    r = S.relations_with_spans(FX.gold_docs(spark, sf), DOC)
    sc = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: (
        (F.col("head") * 13 + F.col("tail") * 7 + k * 3 + F.col("sent_no")) % 10) / 10.0)
    return r.withColumn("scores", sc)


_REL_DEC_SQL = """
SELECT doc_id, sent_no, rel_idx, hs, ts_, CAST(k + 1 AS INTEGER) AS type_idx, s AS score FROM (
  SELECT doc_id, sent_no, rel_idx, hs, ts_, unnest(generate_series(0, 2)) AS k,
         unnest(list_transform(generate_series(0, 2), lambda k: ((head * 13 + tail * 7 + k * 3 + sent_no) % 10) / 10.0)) AS s
  FROM gold_relx) WHERE s >= 0.4 AND s <> 0"""


@query("e2_decode_relations", with_ctes(f"""
SELECT doc_id, sent_no, rel_idx, type_idx, round(score, 6) AS score FROM ({_REL_DEC_SQL})""", "gold_relx"))
def e2(spark, sf):
    d = M.decode_relations(_rel_scores(spark, sf).select(*DOC, "rel_idx", "scores"), "scores", 0.4)
    return d.select(*DOC, "rel_idx", "type_idx", F.round("score", R6).alias("score"))


@query("e3_dedup_relations", with_ctes(f"""
SELECT doc_id, sent_no, a, b, type_idx, round(score, 6) AS score, rel_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, sent_no, a, b, type_idx ORDER BY rel_idx, type_idx) AS rn FROM (
    SELECT doc_id, sent_no, rel_idx, type_idx, score,
           CASE WHEN type_idx = 1 AND ts_ < hs THEN ts_ ELSE hs END AS a,
           CASE WHEN type_idx = 1 AND ts_ < hs THEN hs ELSE ts_ END AS b FROM ({_REL_DEC_SQL})))
WHERE rn = 1""", "gold_relx"))
def e3(spark, sf):
    d = M.decode_relations(_rel_scores(spark, sf).select(*DOC, "rel_idx", "hs", "ts_", "scores"), "scores", 0.4)
    swap = (F.col("type_idx") == 1) & (F.col("ts_") < F.col("hs"))
    d = d.withColumn("a", F.when(swap, F.col("ts_")).otherwise(F.col("hs"))) \
         .withColumn("b", F.when(swap, F.col("hs")).otherwise(F.col("ts_"))) \
         .withColumn("_o", F.col("rel_idx") * 10 + F.col("type_idx"))
    u = M.dedup_relations(d, DOC, ["a", "b", "type_idx"], "_o")
    return u.select(*DOC, "a", "b", "type_idx", F.round("score", R6).alias("score"), "rel_idx")


def _ents(spark, sf):
    return tuple(S.to_mentions(S.dealt(d, DOC, "entities"), DOC) for d in (FX.gold_docs(spark, sf), FX.pred_docs(spark, sf)))


def _rels(spark, sf):
    return tuple(S.relations_with_spans(S.dealt(d, DOC, "entities", "relations"), DOC) for d in (FX.gold_docs(spark, sf), FX.pred_docs(spark, sf)))


def _counts_sql(gsrc, psrc, keys):
    k = ", ".join(keys)
    return f"""
SELECT type, count(*) FILTER (WHERE g AND p) AS tp, count(*) FILTER (WHERE NOT g AND p) AS fp,
       count(*) FILTER (WHERE g AND NOT p) AS fn FROM (
  SELECT {k}, gg.doc_id IS NOT NULL AS g, pp.doc_id IS NOT NULL AS p
  FROM (SELECT DISTINCT {k} FROM {gsrc}) gg FULL JOIN (SELECT DISTINCT {k} FROM {psrc}) pp USING ({k}))
GROUP BY type"""


ENT_KEYS = ["doc_id", "sent_no", '"start"', '"end"', "type"]
REL_KEYS = ["doc_id", "sent_no", "hs", "he", "ts_", "te", "type"]
REL_NEC_KEYS = REL_KEYS + ["ht", "tt"]
E4_SQL = _counts_sql("gold", "pred", ENT_KEYS)
E5_SQL = _counts_sql("gold_relx", "pred_relx", REL_KEYS)
E6_SQL = _counts_sql("gold_relx", "pred_relx", REL_NEC_KEYS)


@query("e4_score_entities", with_ctes(E4_SQL, "gold", "pred"))
def e4(spark, sf):
    g, p = _ents(spark, sf)
    return M.score_counts(M.memberships(g, p, ENT))


@query("e5_score_relations", with_ctes(E5_SQL, "gold_relx", "pred_relx"))
def e5(spark, sf):
    g, p = _rels(spark, sf)
    return M.score_counts(M.memberships(g, p, REL))


@query("e6_score_relations_nec", with_ctes(E6_SQL, "gold_relx", "pred_relx"))
def e6(spark, sf):
    g, p = _rels(spark, sf)
    return M.score_counts(M.memberships(g, p, [*REL, "ht", "tt"]))


def _report_sql(counts_sql):
    return f"""
WITH c AS ({counts_sql}),
per AS (SELECT type AS label,
   CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
   CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r, tp + fn AS support FROM c),
per2 AS (SELECT label, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f, support FROM per),
mic AS (SELECT CASE WHEN sum(tp) + sum(fp) = 0 THEN 0.0 ELSE sum(tp) / (sum(tp) + sum(fp)) END AS p,
               CASE WHEN sum(tp) + sum(fn) = 0 THEN 0.0 ELSE sum(tp) / (sum(tp) + sum(fn)) END AS r,
               sum(tp) + sum(fn) AS support FROM c)
SELECT label, round(p * 100, 6) AS precision, round(r * 100, 6) AS recall, round(f * 100, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'micro', round(p * 100, 6), round(r * 100, 6),
       round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END * 100, 6), CAST(support AS BIGINT) FROM mic
UNION ALL SELECT 'macro', round(avg(p) * 100, 6), round(avg(r) * 100, 6), round(avg(f) * 100, 6),
       CAST(sum(support) AS BIGINT) FROM per2"""


def _rounded(rep):
    return rep.select("label", *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def _with_extra(sql_with_with: str, *ctes: str) -> str:
    """Merge a query that starts with its own WITH list into the fixture CTEs."""
    body = sql_with_with.strip()
    assert body.startswith("WITH ")
    base = with_ctes("SELECT 1", *ctes)
    head = base[:base.rindex("\nSELECT 1")]
    return head + ",\n" + body[len("WITH "):]


E7_SQL = _with_extra(_report_sql(E4_SQL), "gold", "pred")


@query("e7_prf_report", E7_SQL)
def e7(spark, sf):
    g, p = _ents(spark, sf)
    return _rounded(M.prf_report(M.memberships(g, p, ENT)))


@query("e8_format_report", _with_extra(_report_sql(E4_SQL).replace("\nSELECT label, round", ", rep AS (SELECT label, round", 1) + ")" + """
SELECT label, printf('%.2f', precision) AS precision, printf('%.2f', recall) AS recall,
       printf('%.2f', f1) AS f1, support FROM rep""", "gold", "pred"))
def e8(spark, sf):
    g, p = _ents(spark, sf)
    rep = M.prf_report(M.memberships(g, p, ENT))
    return M.format_report(_rounded(rep)).withColumn("support", F.col("support").cast("long"))


def _pred_scored(spark, sf):
    _, p = _ents(spark, sf)
    return p.withColumn("score", ((F.col("start") * 7 + F.col("end") * 3) % 11) / 10.0)


@query("e9_doc_examples", with_ctes("""
SELECT doc_id, sent_no, n_tp, n_fn, n_fp,
  round(CASE WHEN n_tp + n_fn + n_fp = 0 THEN 100.0 ELSE 100 * pr END, 6) AS precision,
  round(CASE WHEN n_tp + n_fn + n_fp = 0 THEN 100.0 ELSE 100 * rc END, 6) AS recall,
  round(CASE WHEN n_tp + n_fn + n_fp = 0 THEN 100.0 ELSE 100 * CASE WHEN pr + rc = 0 THEN 0 ELSE 2 * pr * rc / (pr + rc) END END, 6) AS f1,
  tp, fp, fn FROM (
  SELECT *, CASE WHEN n_tp + n_fp = 0 THEN 0.0 ELSE n_tp / (n_tp + n_fp) END AS pr,
            CASE WHEN n_tp + n_fn = 0 THEN 0.0 ELSE n_tp / (n_tp + n_fn) END AS rc FROM (
    SELECT doc_id, sent_no, coalesce(n_tp, 0) AS n_tp, coalesce(n_fn, 0) AS n_fn, coalesce(n_fp, 0) AS n_fp,
           coalesce(tp, '') AS tp, coalesce(fp, '') AS fp, coalesce(fn, '') AS fn FROM sents LEFT JOIN (
    SELECT doc_id, sent_no, count(*) FILTER (WHERE g AND p) AS n_tp, count(*) FILTER (WHERE g AND NOT p) AS n_fn,
      count(*) FILTER (WHERE NOT g AND p) AS n_fp,
      string_agg(item || ':' || score, ' ' ORDER BY -score, item) FILTER (WHERE g AND p) AS tp,
      string_agg(item || ':' || score, ' ' ORDER BY -score, item) FILTER (WHERE NOT g AND p) AS fp,
      string_agg(item || ':-1.0', ' ' ORDER BY item) FILTER (WHERE g AND NOT p) AS fn
    FROM (SELECT doc_id, sent_no, CAST("start" AS VARCHAR) || ':' || CAST("end" AS VARCHAR) || ':' || type AS item,
                 gg.doc_id IS NOT NULL AS g, pp.doc_id IS NOT NULL AS p, pp.score
          FROM (SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM gold) gg
          FULL JOIN (SELECT doc_id, sent_no, "start", "end", type, (("start" * 7 + "end" * 3) % 11) / 10.0 AS score FROM pred) pp
          USING (doc_id, sent_no, "start", "end", type))
    GROUP BY doc_id, sent_no) USING (doc_id, sent_no)))""", "sents", "gold", "pred"))
def e9(spark, sf):
    g, _ = _ents(spark, sf)
    ex = M.doc_examples(g, _pred_scored(spark, sf), DOC, ["start", "end", "type"], FX.sentences(spark, sf))
    return ex.select(*DOC, "n_tp", "n_fn", "n_fp", *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1")],
                     *[F.array_join(c, " ").alias(c) for c in ("tp", "fp", "fn")])


@query("e10_example_views", with_ctes("""
SELECT doc_id, sent_no, CAST(len(tokens) AS INTEGER) AS length, CAST(rn - 1 AS INTEGER) AS first_rank,
       CAST(row_number() OVER (ORDER BY len(tokens), rn) - 1 AS INTEGER) AS length_rank FROM (
  SELECT *, row_number() OVER (ORDER BY doc_id, sent_no) AS rn FROM sents ORDER BY doc_id, sent_no LIMIT 20)""", "sents"))
def e10(spark, sf):
    s = FX.sentences(spark, sf).select(*DOC, F.size("tokens").alias("length"))
    first = s.orderBy(*DOC).limit(20)   # the first-N view is the feature
    w1 = Window.orderBy(*DOC)
    first = first.withColumn("first_rank", (F.row_number().over(w1) - 1).cast("int"))
    w2 = Window.orderBy("length", "first_rank")
    return first.withColumn("length_rank", (F.row_number().over(w2) - 1).cast("int"))


@query("e11_accuracy", with_ctes("SELECT round(avg(CAST(y_true = y_pred AS DOUBLE)), 6) AS accuracy FROM class_preds",
                                 "class_preds"))
def e11(spark, sf):
    return M.accuracy(FX.class_preds(spark, sf)).select(F.round("accuracy", R6).alias("accuracy"))


@query("e12_confusion_matrix", with_ctes("""
SELECT a.y_true, b.y_pred, count(c.vec_id) AS n
FROM (SELECT DISTINCT y_true FROM (SELECT y_true FROM class_preds UNION SELECT y_pred FROM class_preds)) a,
     (SELECT DISTINCT y_true AS y_pred FROM (SELECT y_true FROM class_preds UNION SELECT y_pred FROM class_preds)) b
LEFT JOIN class_preds c ON c.y_true = a.y_true AND c.y_pred = b.y_pred
GROUP BY a.y_true, b.y_pred""", "class_preds"))
def e12(spark, sf):
    cm = M.confusion_matrix(FX.class_preds(spark, sf))
    return cm.select("y_true", "y_pred", F.col("n").cast("long").alias("n"))


_CLS_SQL = """
WITH c AS (SELECT label, count(*) FILTER (WHERE side = 't' AND hit) AS tp, count(*) FILTER (WHERE side = 'p' AND NOT hit) AS fp,
                  count(*) FILTER (WHERE side = 't' AND NOT hit) AS fn FROM (
             SELECT y_true AS label, y_true = y_pred AS hit, 't' AS side FROM class_preds
             UNION ALL SELECT y_pred, y_true = y_pred, 'p' FROM class_preds) GROUP BY label),
per AS (SELECT CAST(label AS VARCHAR) AS label, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r, tp + fn AS support FROM c),
per2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM per)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', round(avg(CAST(y_true = y_pred AS DOUBLE)), 6), round(avg(CAST(y_true = y_pred AS DOUBLE)), 6),
       round(avg(CAST(y_true = y_pred AS DOUBLE)), 6), count(*) FROM class_preds
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
       round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per2"""


def _cls_report(spark, sf):
    r = M.classification_report(FX.class_preds(spark, sf))
    return r.select("label", *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("e14_classification_report", _with_extra(_CLS_SQL, "class_preds"))
def e14(spark, sf):
    return _cls_report(spark, sf)


E13_SQL = _with_extra(_CLS_SQL.replace("\nSELECT label, round(p, 6)", ",\nrep AS (SELECT label, round(p, 6)", 1)
                      + ")\nSELECT * FROM rep WHERE label IN ('macro avg', 'weighted avg')", "class_preds")


@query("e13_prf_weighted_macro", E13_SQL)
def e13(spark, sf):
    return _cls_report(spark, sf).filter(F.col("label").isin("macro avg", "weighted avg"))


@query("e15_roc_auc", with_ctes("""
SELECT round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
  SELECT s, pos, neg, sum(neg) OVER (ORDER BY s) AS cum_neg FROM (
    SELECT score AS s, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
    FROM binary_scores GROUP BY score))""", "binary_scores"))
def e15(spark, sf):
    return M.roc_auc(FX.binary_scores(spark, sf)).select(F.round("auc", R6).alias("auc"))


@query("e16_roc_curve", with_ctes("""
SELECT s AS threshold, round(cum_neg / sum(neg) OVER (), 6) AS fpr, round(cum_pos / sum(pos) OVER (), 6) AS tpr FROM (
  SELECT s, pos, neg, sum(neg) OVER (ORDER BY s DESC) AS cum_neg, sum(pos) OVER (ORDER BY s DESC) AS cum_pos FROM (
    SELECT score AS s, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
    FROM binary_scores GROUP BY score))""", "binary_scores"))
def e16(spark, sf):
    r = M.roc_curve(FX.binary_scores(spark, sf))
    return r.select("threshold", F.round("fpr", R6).alias("fpr"), F.round("tpr", R6).alias("tpr"))


@query("e17_auc_ovr_hard", with_ctes("""
SELECT round(avg((CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END
                 + CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END) / 2), 6) AS auc_ovr FROM (
  SELECT *, (SELECT count(*) FROM class_preds) - tp - fp - fn AS tn FROM (
    SELECT label, count(*) FILTER (WHERE side = 't' AND hit) AS tp, count(*) FILTER (WHERE side = 'p' AND NOT hit) AS fp,
           count(*) FILTER (WHERE side = 't' AND NOT hit) AS fn FROM (
      SELECT y_true AS label, y_true = y_pred AS hit, 't' AS side FROM class_preds
      UNION ALL SELECT y_pred, y_true = y_pred, 'p' FROM class_preds) GROUP BY label))""", "class_preds"))
def e17(spark, sf):
    return M.auc_ovr_hard(FX.class_preds(spark, sf)).select(F.round("auc_ovr", R6).alias("auc_ovr"))


@query("e18_epoch_loss", """
SELECT epoch, round(avg(bm), 6) AS mean_batch_loss, round(sum(s) / sum(n), 6) AS mean_sample_loss FROM (
  SELECT CAST(day(ts) AS INTEGER) AS epoch, event_id // 64 AS batch, avg(value) AS bm, sum(value) AS s, count(*) AS n
  FROM events GROUP BY ALL) GROUP BY epoch""")
def e18(spark, sf):
    ev = table(spark, sf, "events").select(F.dayofmonth("ts").alias("epoch"),
                                           F.expr("event_id div 64").alias("batch"), F.col("value"))
    r = M.epoch_loss(ev, "epoch", "batch", "value")
    return r.select("epoch", F.round("mean_batch_loss", R6).alias("mean_batch_loss"),
                    F.round("mean_sample_loss", R6).alias("mean_sample_loss"))


_LOGSM = """list_transform(logits, lambda x: x - (ln(list_sum(list_transform(logits, lambda z: exp(z - list_max(logits))))) + list_max(logits)))"""


@query("e19_cross_entropy", with_ctes(f"""
SELECT round(sum(ce), 6) AS ce_sum, round(avg(ce), 6) AS ce_mean,
       round(sum(ce * m) / nullif(sum(m), 0), 6) AS ce_masked_mean FROM (
  SELECT -({_LOGSM})[y_true + 1] AS ce, CASE WHEN vec_id % 3 <> 0 THEN 1.0 ELSE 0.0 END AS m FROM class_preds)""",
    "class_preds"))
def e19(spark, sf):
    c = M.cross_entropy_rows(FX.class_preds(spark, sf), "logits", "y_true")
    m = F.when(F.col("vec_id") % 3 != 0, 1.0).otherwise(0.0)
    return c.agg(F.round(F.sum("ce"), R6).alias("ce_sum"), F.round(F.avg("ce"), R6).alias("ce_mean"),
                 F.round(F.try_divide(F.sum(F.col("ce") * m), F.sum(m)), R6).alias("ce_masked_mean"))


@query("e20_label_smoothing_loss", with_ctes(f"""
SELECT round(sum(list_sum(list_transform({_LOGSM}, lambda l, j:
   -(CASE WHEN j - 1 = y_true THEN 0.9 ELSE 0.1 / (width - 1) END) * l))), 6) AS loss
FROM class_preds, (SELECT max(greatest(len(logits), y_true + 1)) AS width FROM class_preds)""",
    "class_preds"))
def e20(spark, sf):
    cp = FX.class_preds(spark, sf)
    width = (cp.agg(F.max(F.greatest(F.size("logits"), F.col("y_true") + 1))).first()[0] or 1)   # one number: max label + 1
    return M.label_smoothing_loss(cp, "logits", "y_true", 0.1, width).select(F.round("loss", R6).alias("loss"))


@query("e22_rel_error", """
SELECT round(max(abs(x - round(x, 2))) / greatest(max(abs(x) + abs(round(x, 2))), 1e-8), 6) AS rel_error
FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)""")
def e22(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("x"))
    e = e.withColumn("y", F.transform("x", lambda v: F.round(v, 2)))
    return M.rel_error(e, "x", "y").select(F.round("rel_error", R6).alias("rel_error"))


def history(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type", F.dayofmonth("ts").alias("epoch")).agg(F.avg("value").alias("metric"))


_HIST_SQL = "SELECT event_type, CAST(day(ts) AS INTEGER) AS epoch, avg(value) AS metric FROM events GROUP BY ALL"


@query("e25_best_epoch", f"""
SELECT event_type, arg_max(epoch, metric * 1000000 - epoch) AS best_epoch FROM (
  SELECT event_type, epoch, first(epoch ORDER BY metric DESC, epoch) OVER (PARTITION BY event_type) AS b, metric
  FROM ({_HIST_SQL})) WHERE epoch = b GROUP BY event_type""")
def e25(spark, sf):
    h = history(spark, sf)
    key = F.struct(F.col("metric").alias("m"), (-F.col("epoch")).alias("e"))
    return h.groupBy("event_type").agg(F.max_by("epoch", key).alias("best_epoch"))


@query("e26_early_stop", f"""
SELECT event_type, min(epoch) FILTER (WHERE epoch - last_imp >= 5) AS stop_epoch FROM (
  SELECT *, max(CASE WHEN imp THEN epoch END) OVER (PARTITION BY event_type ORDER BY epoch
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM (
    SELECT *, best_before IS NULL OR metric < best_before AS imp FROM (
      SELECT *, min(metric) OVER (PARTITION BY event_type ORDER BY epoch
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM ({_HIST_SQL}))))
GROUP BY event_type""")
def e26(spark, sf):
    return M.early_stop(history(spark, sf), "epoch", "metric", 5, "min", keys=["event_type"])


def _e27_sql():
    reps = {"ner": E4_SQL, "rel": E5_SQL, "rel_nec": E6_SQL}
    cols = []
    for t, c in reps.items():
        for a in ("micro", "macro"):
            for m in ("precision", "recall", "f1"):
                cols.append(f"(SELECT {m} FROM ({_report_sql(c)}) WHERE label = '{a}') AS {t}_{a}_{m}")
    return with_ctes("SELECT " + ",\n  ".join(cols), "gold", "pred", "gold_relx", "pred_relx")


@query("e27_eval_row", _e27_sql())
def e27(spark, sf):
    """18 metrics from one pass over each side: a document gives its tuples of all three tasks."""
    rep = M.prf_report(M.memberships(_task_tuples(FX.gold_docs(spark, sf)), _task_tuples(FX.pred_docs(spark, sf)),
                                     ["task", *DOC, "a", "b", "c", "d", "type", "ht", "tt"]), by=["task"])
    rows = rep.filter(F.col("label").isin("micro", "macro"))
    long = rows.select(F.explode(F.array(*[F.struct(F.concat_ws("_", "task", "label", F.lit(m)).alias("k"),
                                                     F.round(F.col(m), R6).alias("v"))
                                           for m in ("precision", "recall", "f1")])).alias("x"))
    names = [f"{t}_{a}_{m}" for t in ("ner", "rel", "rel_nec") for a in ("micro", "macro")
             for m in ("precision", "recall", "f1")]
    return long.groupBy().pivot("x.k", names).agg(F.first("x.v"))


def _task_tuples(docs):
    """(task, keys, a, b, c, d, type, ht, tt): entities, relations, and relations with the types of their arguments."""
    no, nowhere = F.lit(None).cast("string"), F.lit(None).cast("int")
    tup = lambda task, a, b, c, d, t, ht, tt: F.struct(F.lit(task).alias("task"), a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"),
                                                       t.alias("type"), ht.alias("ht"), tt.alias("tt"))
    arg = lambda i: F.element_at("entities", i + 1)

    def rel(task, nec):
        return F.transform("relations", lambda r: tup(task, arg(r["head"])["start"], arg(r["head"])["end"], arg(r["tail"])["start"], arg(r["tail"])["end"],
                                                      r["type"], arg(r["head"])["type"] if nec else no, arg(r["tail"])["type"] if nec else no))
    ents = F.transform("entities", lambda e: tup("ner", e["start"], e["end"], nowhere, nowhere, e["type"], no, no))
    d = S.explode_rows(S.dealt(docs, DOC, "entities", "relations").select(*DOC, F.concat(ents, rel("rel", False), rel("rel_nec", True)).alias("t")), DOC, "t", "_i", "t")
    return d.select(*DOC, "t.*")


#: Batches of ten documents; of every fifth no pair is valid.
_PAIRS_SQL = """SELECT doc_id // 10 AS batch, list_transform(generate_series(0, 2), lambda k: ((head * 13 + tail * 7 + k * 3 + sent_no) % 10 - 4.5) / 2) AS x,
  CASE type WHEN 'associated_with' THEN 0 WHEN 'treatment_for' THEN 1 ELSE 2 END AS y,
  (rel_idx + doc_id) % 3 <> 0 AND (doc_id // 10) % 5 <> 0 AS mask FROM gold_relx"""
_SPANS_SQL = """SELECT doc_id // 10 AS batch, list_transform(generate_series(0, 5), lambda k: (("start" * 7 + "end" * 3 + k * 5 + doc_id) % 11) / 3.0) AS x,
  CASE type WHEN 'disease' THEN 1 WHEN 'drug' THEN 2 WHEN 'gene' THEN 3 WHEN 'method' THEN 4 ELSE 5 END AS y, (ent_idx + sent_no) % 4 <> 0 AS mask FROM gold"""


@query("e19_masked_bce", with_ctes(f"""
SELECT batch, round(entity_loss, 6) AS entity_loss, n_entities, round(rel_loss, 6) AS rel_loss, coalesce(n_pairs, 0) AS n_pairs,
       round(entity_loss + coalesce(rel_loss, 0), 6) AS train_loss FROM (
  SELECT batch, sum(ce) FILTER (WHERE mask) / nullif(count(*) FILTER (WHERE mask), 0) AS entity_loss, count(*) FILTER (WHERE mask) AS n_entities FROM (
    SELECT batch, mask, ln(list_sum(list_transform(x, lambda z: exp(z - list_max(x))))) + list_max(x) - x[y + 1] AS ce FROM ({_SPANS_SQL})) GROUP BY batch)
LEFT JOIN (SELECT batch, sum(bce) FILTER (WHERE mask) / nullif(count(*) FILTER (WHERE mask), 0) AS rel_loss, count(*) FILTER (WHERE mask) AS n_pairs FROM (
    SELECT batch, mask, list_sum(list_transform(x, lambda z, i: greatest(z, 0) - CASE WHEN i - 1 = y THEN z ELSE 0 END + ln(1 + exp(-abs(z))))) / 3 AS bce
    FROM ({_PAIRS_SQL})) GROUP BY batch) USING (batch)""", "gold", "gold_relx"))
def e19_masked(spark, sf):
    """Losses of batches of ten documents: entities by cross-entropy, relations by masked binary cross-entropy."""
    d = FX.gold_docs(spark, sf)
    batch = F.expr("doc_id div 10").alias("batch")
    ents = S.to_mentions(d, DOC)
    types = F.array(*[F.lit(t) for t in [*FX.ENTITY_TYPES_BY_LEN_MOD4, FX.PAIR_ENTITY_TYPE]])
    ents = ents.select(batch, F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: (
        (F.col("start") * 7 + F.col("end") * 3 + k * 5 + F.col("doc_id")) % 11) / 3.0).alias("x"),
        F.array_position(types, F.col("type")).cast("int").alias("y"), ((F.col("ent_idx") + F.col("sent_no")) % 4 != 0).alias("mask"))
    entity = M.masked_mean(M.cross_entropy_rows(ents, "x", "y"), "ce", "mask", ["batch"], "entity_loss")
    rels = S.to_relations(d, DOC)
    kinds = F.array(*[F.lit(t) for t in FX.RELATION_TYPES_BY_DIST_MOD3])
    rels = rels.select(batch, F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: (
        (F.col("head") * 13 + F.col("tail") * 7 + k * 3 + F.col("sent_no")) % 10 - 4.5) / 2).alias("x"),
        F.transform(kinds, lambda t: F.when(t == F.col("type"), 1.0).otherwise(0.0)).alias("y"),
        (((F.col("rel_idx") + F.col("doc_id")) % 3 != 0) & (F.expr("doc_id div 10") % 5 != 0)).alias("mask"))
    j = M.joint_loss(entity, M.masked_bce(rels, "x", "y", "mask", ["batch"]), ["batch"])
    return j.select("batch", F.round("entity_loss", R6).alias("entity_loss"), F.col("n_entity_loss").alias("n_entities"), F.round("rel_loss", R6).alias("rel_loss"),
                    F.coalesce("n_rel_loss", F.lit(0)).alias("n_pairs"), F.round("train_loss", R6).alias("train_loss"))
