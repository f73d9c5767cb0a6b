"""D1-D13 (D3 flagship is in q_flagship): joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import joins as J
from tessera.operators import spans as S
from tessera.operators.asof import asof_nearest
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.q_scalars import CLINICAL_SQL, DX_NORM_SQL, clinical_labels
from tessera.plans.registry import query
from tessera.session import table

DOC = FX.DOC
RE = X.FILENAME_RE


def _parsed(names):
    p = names.select("path", X.parse_filename("path").alias("p")).filter(F.col("p").isNotNull())
    return p.select("p.ptid", "p.date", "p.tag", "path")


def _left_files(spark, sf):
    n = FX.scan_names(spark, sf, "view")
    gz = n.filter(F.col("event_id") % 5 == 0).select("event_id", F.concat("path", F.lit(".gz")).alias("path"))
    return _parsed(n.unionByName(gz))


_FILES_SQL = f"""
SELECT ptid, date, tag, first(path ORDER BY suffix(path, '.gz') DESC, path DESC) AS path FROM (
  SELECT regexp_extract(path, '{RE}', 1) AS ptid, regexp_extract(path, '{RE}', 2) AS date,
         regexp_extract(path, '{RE}', 3) AS tag, path FROM (@SRC@) WHERE regexp_matches(path, '{RE}'))
GROUP BY ALL"""


def _files_sql(src):
    return _FILES_SQL.replace("@SRC@", src)


@query("d1_pair_samples", with_ctes(f"""
SELECT l.ptid, l.date, l.tag, l.path AS left_file, r.path AS right_file
FROM ({_files_sql("SELECT path FROM scan_left UNION ALL SELECT path || '.gz' FROM scan_left WHERE event_id % 5 = 0")}) l
JOIN ({_files_sql("SELECT path FROM scan_right")}) r USING (ptid, date, tag)""", "scan_left", "scan_right"))
def d1(spark, sf):
    left = _left_files(spark, sf).withColumnRenamed("path", "left_file")
    right = _parsed(FX.scan_names(spark, sf, "click")).withColumnRenamed("path", "right_file")
    return J.pair_samples(left, right, ["ptid", "date", "tag"])


@query("d2_zip_by_rank", with_ctes("""
SELECT CAST(a.pos AS BIGINT) AS pos, a.path AS left_path, b.path AS right_path
FROM (SELECT path, row_number() OVER (ORDER BY path) - 1 AS pos FROM (SELECT DISTINCT path FROM scan_left)) a
JOIN (SELECT path, row_number() OVER (ORDER BY path) - 1 AS pos FROM (SELECT DISTINCT path FROM scan_right)) b
USING (pos)""", "scan_left", "scan_right"))
def d2(spark, sf):
    a = FX.scan_names(spark, sf, "view").select(F.col("path").alias("left_path")).distinct()
    b = FX.scan_names(spark, sf, "click").select(F.col("path").alias("right_path")).distinct()
    z = J.zip_by_rank(a, b, [F.col("left_path")], [F.col("right_path")])
    return z.select("pos", "left_path", "right_path")


def label_table(spark, sf):
    """D4 input: normalized, dated, de-duplicated label history; tie column =
    first event id of the (patient, date, label) row."""
    c = clinical_labels(spark, sf)
    c = c.select("event_id", "ptid", X.safe_date("examdate").alias("exam"), X.normalize_label("dx").alias("dx_norm"))
    c = c.dropna(subset=["exam", "dx_norm"])
    return c.groupBy("ptid", "exam", "dx_norm").agg(F.min("event_id").alias("tie"))


_LABELS_SQL = f"""
SELECT ptid, exam, dx_norm, min(event_id) AS tie FROM (
  SELECT event_id, ptid, CAST(try_strptime(examdate, '%Y-%m-%d') AS DATE) AS exam, {DX_NORM_SQL.format(c='dx')} AS dx_norm
  FROM ({CLINICAL_SQL})) WHERE exam IS NOT NULL AND dx_norm IS NOT NULL GROUP BY ALL"""


@query("d4_label_history", f"SELECT ptid, exam, dx_norm FROM ({_LABELS_SQL})")
def d4(spark, sf):
    lt = label_table(spark, sf)
    return J.label_history(lt, "ptid", "exam", "dx_norm")


_ASOF_LABEL_SQL = f"""
SELECT event_id, ptid, day, CASE WHEN delta <= 3 THEN dx_norm END AS dx_norm, matched, delta FROM (
  SELECT s.event_id, s.ptid, s.day, l.dx_norm, l.exam AS matched, CAST(abs(l.exam - s.day) AS BIGINT) AS delta,
         row_number() OVER (PARTITION BY s.event_id ORDER BY abs(l.exam - s.day) NULLS LAST, l.exam, l.tie) AS rn
  FROM (SELECT event_id, user_id AS ptid, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view') s
  LEFT JOIN ({_LABELS_SQL}) l ON l.ptid = s.ptid) WHERE rn = 1"""


def _asof_labels(spark, sf):
    scans = table(spark, sf, "events").filter(F.col("event_type") == "view").select(
        "event_id", F.col("user_id").alias("ptid"), F.col("ts").cast("date").alias("day"))
    lt = label_table(spark, sf).withColumn("matched", F.col("exam"))
    return asof_nearest(scans, lt, by=["ptid"], on="day", right_cols=["dx_norm", "matched"], tie="tie", right_on="exam",
                        tolerance=3, null_beyond=["dx_norm"], bucket_width=8)


@query("d3_asof_labels_tolerance", _ASOF_LABEL_SQL)
def d3t(spark, sf):
    return _asof_labels(spark, sf).select("event_id", "ptid", "day", "dx_norm", "matched", "delta")


@query("d5_drop_unlabelled", f"SELECT event_id, dx_norm FROM ({_ASOF_LABEL_SQL}) WHERE dx_norm IS NOT NULL")
def d5(spark, sf):
    return J.drop_unlabelled(_asof_labels(spark, sf), "dx_norm").select("event_id", "dx_norm")


@query("d6_union_docs", with_ctes("""
SELECT doc_id, sent_no, CASE WHEN doc_id % 2 = 1 THEN 'odd' ELSE 'even' END AS corpus, count(*) AS n_ent
FROM gold GROUP BY ALL""", "gold"))
def d6(spark, sf):
    m = S.to_mentions(FX.gold_docs(spark, sf), DOC)
    odd = m.filter(F.col("doc_id") % 2 == 1).withColumn("corpus", F.lit("odd"))
    even = m.filter(F.col("doc_id") % 2 == 0).withColumn("corpus", F.lit("even"))
    u = J.union_docs(odd, even)
    return u.groupBy(*DOC, "corpus").agg(F.count(F.lit(1)).alias("n_ent"))


def registries(spark, sf):
    """Entity-type registry per corpus (odd / even doc_id): position by first
    document, short = 3 upper letters, verbose = type@corpus."""
    from pyspark.sql import Window
    m = S.to_mentions(FX.gold_docs(spark, sf), DOC).withColumn(
        "corpus", F.when(F.col("doc_id") % 2 == 1, "odd").otherwise("even"))
    f = m.groupBy("corpus", F.col("type").alias("name")).agg(F.min("doc_id").alias("first"))
    w = Window.partitionBy("corpus").orderBy("first", "name")
    f = f.withColumn("pos", F.row_number().over(w)).withColumn("short", F.upper(F.substring("name", 1, 3))) \
        .withColumn("verbose", F.concat("name", F.lit("@"), F.col("corpus")))
    return f.filter(F.col("corpus") == "odd"), f.filter(F.col("corpus") == "even")


_REG_SQL = """
SELECT corpus, name, row_number() OVER (PARTITION BY corpus ORDER BY first, name) AS pos,
       upper(substr(name, 1, 3)) AS "short", name || '@' || corpus AS "verbose"
FROM (SELECT CASE WHEN doc_id % 2 = 1 THEN 'odd' ELSE 'even' END AS corpus, type AS name,
             min(doc_id) AS first FROM gold GROUP BY ALL)"""


@query("d7_merge_types", with_ctes(f"""
SELECT name, CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS idx, "short", "verbose" FROM (
  SELECT coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NOT NULL THEN a.pos ELSE 1000 + b.pos END AS k,
         coalesce(b."short", a."short") AS "short", coalesce(b."verbose", a."verbose") AS "verbose"
  FROM (SELECT * FROM ({_REG_SQL}) WHERE corpus = 'odd') a
  FULL JOIN (SELECT * FROM ({_REG_SQL}) WHERE corpus = 'even') b USING (name))""", "gold"))
def d7(spark, sf):
    a, b = registries(spark, sf)
    return J.merge_types(a, b, "name", ("short", "verbose"))


@query("d8_hconcat", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS s FROM embeddings""")
def d8(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    a = e.select("vec_id", F.slice("e", 1, 32).alias("a"))
    b = e.select("vec_id", F.slice("e", 33, 32).alias("b"))
    h = J.hconcat(a, b, "vec_id", "a", "b", "x")
    return h.select("vec_id", F.size("x").alias("n"),
                    F.round(F.aggregate("x", F.lit(0.0), lambda s, v: s + v), 6).alias("s"))


@query("d9_match_sets", with_ctes("""
SELECT doc_id, sent_no, "start", "end", type, g.doc_id IS NOT NULL AS in_gold, p.doc_id IS NOT NULL AS in_pred
FROM (SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM gold) g
FULL JOIN (SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM pred) p USING (doc_id, sent_no, "start", "end", type)""",
    "gold", "pred"))
def d9(spark, sf):
    g = S.to_mentions(FX.gold_docs(spark, sf), DOC)
    p = S.to_mentions(FX.pred_docs(spark, sf), DOC)
    return J.match_sets(g, p, [*DOC, "start", "end", "type"])


_OVL = """EXISTS (SELECT 1 FROM gold b WHERE b.doc_id = a.doc_id AND b.sent_no = a.sent_no
  AND NOT (b."start" = a."start" AND b."end" = a."end" AND b.type = a.type)
  AND a."start" < b."end" AND b."start" < a."end")"""


@query("d10_overlaps", with_ctes(f"""
SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM gold a WHERE {_OVL}""", "gold"))
def d10(spark, sf):
    return J.overlapping(S.to_mentions(FX.gold_docs(spark, sf), DOC), DOC)


@query("d11_remove_overlapping_entities", with_ctes(f"""
SELECT doc_id, sent_no, ent_idx, "start", "end", type FROM gold a WHERE NOT {_OVL}""", "gold"))
def d11e(spark, sf):
    ents, _ = J.remove_overlapping(S.to_mentions(FX.gold_docs(spark, sf), DOC), None, DOC)
    return ents.select(*DOC, "ent_idx", "start", "end", "type")


@query("d11_remove_overlapping_relations", with_ctes("""
SELECT doc_id, sent_no, rel_idx FROM gold_relx
WHERE (hs = ts_ AND he = te AND ht = tt) OR NOT (hs < te AND ts_ < he)""", "gold_relx"))
def d11r(spark, sf):
    d = FX.gold_docs(spark, sf)
    _, rels = J.remove_overlapping(S.to_mentions(d, DOC), S.relations_with_spans(d, DOC), DOC)
    return rels.select(*DOC, "rel_idx")


def mismatch(spark, sf, predicted=FX.pred_docs):
    """D13 for entities and relations of every sentence."""
    g, p = (S.dealt(d, DOC, "entities", "relations") for d in (FX.gold_docs(spark, sf), predicted(spark, sf)))
    e = J.set_mismatch(S.to_mentions(g, DOC), S.to_mentions(p, DOC), DOC, ["start", "end", "type"], g) \
        .withColumnRenamed("mismatch", "ent_mismatch")
    r = J.set_mismatch(S.to_relations(g, DOC), S.to_relations(p, DOC), DOC, ["type", "head", "tail"], g) \
        .withColumnRenamed("mismatch", "rel_mismatch")
    return e.join(r, DOC)


MISMATCH_SQL = """
SELECT s.doc_id, s.sent_no, coalesce(e.mm, false) AS ent_mismatch, coalesce(r.mm, false) AS rel_mismatch
FROM sents s
LEFT JOIN (SELECT doc_id, sent_no, bool_or(g.doc_id IS NULL OR p.doc_id IS NULL) AS mm FROM
        (SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM gold) g
        FULL JOIN (SELECT DISTINCT doc_id, sent_no, "start", "end", type FROM pred) p USING (doc_id, sent_no, "start", "end", type)
      GROUP BY ALL) e ON e.doc_id = s.doc_id AND e.sent_no = s.sent_no
LEFT JOIN (SELECT doc_id, sent_no, bool_or(g.doc_id IS NULL OR p.doc_id IS NULL) AS mm FROM
        (SELECT DISTINCT doc_id, sent_no, type, head, tail FROM gold_rel) g
        FULL JOIN (SELECT DISTINCT doc_id, sent_no, type, head, tail FROM pred_rel) p USING (doc_id, sent_no, type, head, tail)
      GROUP BY ALL) r ON r.doc_id = s.doc_id AND r.sent_no = s.sent_no"""
MISMATCH_CTES = ("sents", "gold", "pred", "gold_rel", "pred_rel")


@query("d13_set_mismatch", with_ctes(MISMATCH_SQL, *MISMATCH_CTES))
def d13(spark, sf):
    return mismatch(spark, sf)
