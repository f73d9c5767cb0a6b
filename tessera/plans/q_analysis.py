"""F1-F16: exploratory and error analysis queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import analysis as AN
from tessera.operators import joins as J
from tessera.operators import spans as S
from tessera.operators.splits import sample_per_class
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.q_joins import MISMATCH_CTES, MISMATCH_SQL, mismatch
from tessera.plans.registry import query
from tessera.session import table

DOC = FX.DOC


@query("f1_entity_distribution", with_ctes("SELECT type, count(*) AS n FROM gold GROUP BY type", "gold"))
def f1(spark, sf):
    return AN.type_distribution(S.to_mentions(FX.gold_docs(spark, sf), DOC))


@query("f2_relation_distribution", with_ctes("SELECT type, count(*) AS n FROM gold_rel GROUP BY type", "gold_rel"))
def f2(spark, sf):
    return AN.type_distribution(S.to_relations(FX.gold_docs(spark, sf), DOC))


@query("f3_density", with_ctes("""
SELECT s.doc_id, s.sent_no, CAST(coalesce(e.n, 0) AS INTEGER) AS n_entities, CAST(coalesce(r.n, 0) AS INTEGER) AS n_relations,
       CAST(len(s.tokens) AS INTEGER) AS n_tokens
FROM sents s LEFT JOIN (SELECT doc_id, sent_no, count(*) AS n FROM gold GROUP BY ALL) e USING (doc_id, sent_no)
LEFT JOIN (SELECT doc_id, sent_no, count(*) AS n FROM gold_rel GROUP BY ALL) r USING (doc_id, sent_no)""",
    "sents", "gold", "gold_rel"))
def f3(spark, sf):
    return AN.density(FX.gold_docs(spark, sf), DOC)


@query("f4_histogram", with_ctes("""
WITH x AS (SELECT CAST(len(tokens) AS DOUBLE) AS x FROM sents), mm AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
b AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n FROM x, mm GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * (hi - lo) / 20, 6) AS "left", round(lo + (g.bin + 1) * (hi - lo) / 20, 6) AS "right",
       coalesce(b.n, 0) AS n
FROM (SELECT unnest(generate_series(0, 19)) AS bin) g, mm LEFT JOIN b ON b.bin = g.bin""".replace("WITH x AS", "x AS"),
    "sents").replace("\nx AS (SELECT CAST", ",\nx AS (SELECT CAST"))
def f4(spark, sf):
    s = FX.sentences(spark, sf).select(F.size("tokens").alias("n_tokens"))
    h = AN.histogram(s, "n_tokens", 20)
    return h.select(F.col("bin").cast("int").alias("bin"), F.round("left", 6).alias("left"),
                    F.round("right", 6).alias("right"), "n")


@query("f5_class_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def f5(spark, sf):
    return AN.class_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("f6_dataset_summary", with_ctes("""
SELECT (SELECT count(*) FROM sents) AS n_docs, (SELECT count(*) FROM gold) AS n_entities,
       (SELECT count(*) FROM gold_rel) AS n_relations, (SELECT count(DISTINCT type) FROM gold) AS n_entity_types,
       (SELECT count(DISTINCT type) FROM gold_rel) AS n_relation_types,
       (SELECT CAST(sum(len(tokens)) AS BIGINT) FROM sents) AS n_tokens""", "sents", "gold", "gold_rel"))
def f6(spark, sf):
    d = FX.gold_docs(spark, sf)
    m = S.to_mentions(d, DOC)
    r = S.to_relations(d, DOC)
    a = d.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("entities")).cast("long").alias("n_entities"),
              F.sum(F.size("relations")).cast("long").alias("n_relations"),
              F.sum(F.size("tokens")).cast("long").alias("n_tokens"))
    n_et = m.agg(F.count_distinct("type")).first()[0]     # one number each
    n_rt = r.agg(F.count_distinct("type")).first()[0]
    a = a.withColumn("n_entity_types", F.lit(n_et).cast("long")).withColumn("n_relation_types", F.lit(n_rt).cast("long"))
    return a.select(
        "n_docs", "n_entities", "n_relations", "n_entity_types", "n_relation_types", "n_tokens")


@query("f7_edge_cases", with_ctes(f"SELECT * FROM ({MISMATCH_SQL}) WHERE ent_mismatch OR rel_mismatch",
                                  *MISMATCH_CTES))
def f7(spark, sf):
    return mismatch(spark, sf).filter(F.col("ent_mismatch") | F.col("rel_mismatch"))


_RETYPED_SQL = MISMATCH_SQL.replace("FROM pred_rel", "FROM retyped_rel").replace("FROM pred)", "FROM retyped)")


@query("f8_relation_only_errors", with_ctes(f"""
SELECT doc_id, sent_no, CAST(row_number() OVER (ORDER BY doc_id, sent_no) - 1 AS BIGINT) AS case_rank
FROM ({_RETYPED_SQL}) WHERE rel_mismatch AND NOT ent_mismatch""", "sents", "gold", "gold_rel", "retyped", "retyped_rel"))
def f8(spark, sf):
    """Sentences in which a relation classifier over the gold entities errs, though the entities are right."""
    from tessera.operators.splits import global_rank
    m = mismatch(spark, sf, FX.retyped_docs).filter(F.col("rel_mismatch") & ~F.col("ent_mismatch")).select(*DOC)
    return global_rank(m, [F.col("doc_id"), F.col("sent_no")], "case_rank")


@query("f9_has_overlap", with_ctes("""
SELECT s.doc_id, s.sent_no, coalesce(bool_or(a.doc_id IS NOT NULL AND EXISTS (SELECT 1 FROM gold b WHERE b.doc_id = a.doc_id
   AND b.sent_no = a.sent_no AND b.ent_idx <> a.ent_idx AND a."start" < b."end" AND b."start" < a."end")), false) AS has_overlap
FROM sents s LEFT JOIN gold a ON a.doc_id = s.doc_id AND a.sent_no = s.sent_no GROUP BY ALL""", "sents", "gold"))
def f9(spark, sf):
    d = FX.gold_docs(spark, sf)
    return J.has_any_overlap(S.to_mentions(d, DOC), DOC, d)


_ERR_SQL = """
SELECT s.doc_id, s.sent_no, coalesce(g.l, '') <> coalesce(p.l, '') AS is_error, coalesce(g.d, 0.0) AS dist,
       coalesce(o.ov, false) AS has_overlap
FROM sents s
LEFT JOIN (SELECT doc_id, sent_no, string_agg(type || ':' || head || ':' || tail, ' ' ORDER BY rel_idx) AS l,
                  avg(abs(hs - ts_)) AS d FROM gold_relx GROUP BY ALL) g USING (doc_id, sent_no)
LEFT JOIN (SELECT doc_id, sent_no, string_agg(type || ':' || head || ':' || tail, ' ' ORDER BY rel_idx) AS l
           FROM pred_rel GROUP BY ALL) p USING (doc_id, sent_no)
LEFT JOIN (SELECT doc_id, sent_no, bool_or(EXISTS (SELECT 1 FROM gold b WHERE b.doc_id = a.doc_id AND b.sent_no = a.sent_no
             AND b.ent_idx <> a.ent_idx AND a."start" < b."end" AND b."start" < a."end")) AS ov
           FROM gold a GROUP BY ALL) o USING (doc_id, sent_no)"""
_ERR_CTES = ("sents", "gold", "gold_relx", "pred_rel")


def _errors(spark, sf):
    g, p = FX.gold_docs(spark, sf), FX.pred_docs(spark, sf)
    e = AN.doc_error(g, p, DOC)
    e = e.withColumn("dist", AN.avg_relation_distance(e).cast("double"))
    return e.join(J.has_any_overlap(S.to_mentions(g, DOC), DOC, g), DOC)


@query("f11_doc_error", with_ctes(f"SELECT doc_id, sent_no, is_error FROM ({_ERR_SQL})", *_ERR_CTES))
def f11(spark, sf):
    return _errors(spark, sf).select(*DOC, "is_error")


@query("f10_overlap_error_rates", with_ctes(f"""
SELECT has_overlap, count(*) AS n, round(avg(CAST(is_error AS DOUBLE)), 6) AS error_rate,
       round(avg(CAST(NOT is_error AS DOUBLE)), 6) AS correct_rate FROM ({_ERR_SQL}) GROUP BY has_overlap""", *_ERR_CTES))
def f10(spark, sf):
    e = _errors(spark, sf)
    return e.groupBy("has_overlap").agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.avg(F.col("is_error").cast("double")), 6).alias("error_rate"),
                                        F.round(F.avg((~F.col("is_error")).cast("double")), 6).alias("correct_rate"))


@query("f12_avg_relation_distance", with_ctes(f"SELECT doc_id, sent_no, round(dist, 6) AS dist FROM ({_ERR_SQL})", *_ERR_CTES))
def f12(spark, sf):
    return _errors(spark, sf).select(*DOC, F.round("dist", 6).alias("dist"))


@query("f13_distance_by_correctness", with_ctes(f"""
SELECT is_error, round(avg(dist), 6) AS avg_dist, count(*) AS n FROM ({_ERR_SQL}) GROUP BY is_error""", *_ERR_CTES))
def f13(spark, sf):
    e = _errors(spark, sf)
    return e.groupBy("is_error").agg(F.round(F.avg("dist"), 6).alias("avg_dist"), F.count(F.lit(1)).alias("n"))


@query("f14_distance_bin_errors", with_ctes(f"""
SELECT b.bin, b.label, coalesce(c.total, 0) AS total, coalesce(c.errors, 0) AS errors,
       round(CASE WHEN coalesce(c.total, 0) > 0 THEN c.errors / c.total ELSE 0.0 END, 6) AS error_rate
FROM (SELECT unnest(generate_series(0, 10)) AS bin,
             unnest(['0-1', '1-2', '2-3', '3-4', '4-5', '5-6', '6-7', '7-8', '8-9', '9-10', '10+']) AS label) b
LEFT JOIN (SELECT CASE WHEN d < 10 THEN d ELSE 10 END AS bin, count(*) AS total, count(*) FILTER (WHERE is_error) AS errors
           FROM (SELECT abs(r.hs - r.ts_) AS d, e.is_error FROM gold_relx r JOIN ({_ERR_SQL}) e USING (doc_id, sent_no))
           WHERE d < 100 GROUP BY 1) c USING (bin)""", *_ERR_CTES))
def f14(spark, sf):
    r = AN.distance_bin_errors(_errors(spark, sf))
    return r.select(F.col("bin").cast("bigint").alias("bin"), "label", "total", "errors",
                    F.round("error_rate", 6).alias("error_rate"))


@query("f16_sample_per_class", """
SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label
   ORDER BY md5('f16' || CAST(vec_id AS VARCHAR)), vec_id) AS rn FROM embeddings) WHERE rn <= 3""")
def f16(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id")
    return sample_per_class(e, "label", "vec_id", 3, "f16")
