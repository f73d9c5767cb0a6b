"""Scalar string / label / date / array functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as X
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query
from tessera.session import table

# Free-text diagnosis vocabulary assigned to events by event_id % 11 (fixed values).
DX_TEXT = [" cn ", "SMC", "emci", "Dementia", "probable dementia", "LMCI ", "AD", "xx", "",
           "MCI-like", "nc"]
_DX_SQL_LIST = "[" + ", ".join("'" + t + "'" for t in DX_TEXT) + "]"


def dx_text_col():
    return F.element_at(F.array(*[F.lit(t) for t in DX_TEXT]), (F.col("event_id") % 11 + 1).cast("int"))


def clinical_labels(spark, sf_dir):
    """Clinical-style label table from events: PTID, EXAMDATE (string), DX."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").alias("ptid"),
                     F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd").alias("examdate"),
                     dx_text_col().alias("dx"))


DX_NORM_SQL = """CASE WHEN upper(trim({c})) = '' OR {c} IS NULL THEN NULL
  WHEN upper(trim({c})) IN ('CN', 'NC', 'SMC') THEN 'CN'
  WHEN upper(trim({c})) IN ('MCI', 'EMCI', 'LMCI') OR contains(upper(trim({c})), 'MCI') THEN 'MCI'
  WHEN upper(trim({c})) IN ('AD', 'DEMENTIA') OR contains(upper(trim({c})), 'DEMENT') THEN 'AD'
  ELSE NULL END"""

CLINICAL_SQL = f"""SELECT event_id, user_id AS ptid, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS examdate,
  {_DX_SQL_LIST}[event_id % 11 + 1] AS dx FROM events"""


@query("b1_normalize_label", f"""
SELECT event_id, dx, {DX_NORM_SQL.format(c='dx')} AS dx_norm FROM ({CLINICAL_SQL})""")
def b1(spark, sf_dir):
    return clinical_labels(spark, sf_dir).select(
        "event_id", "dx", X.normalize_label("dx").alias("dx_norm"))


def odd_scan_names(spark, sf_dir):
    """Scan names with .gz variants and malformed names mixed in."""
    n = FX.scan_names(spark, sf_dir, "view")
    path = (F.when(F.col("event_id") % 7 == 0, F.regexp_replace("path", "__", "_"))
             .when(F.col("event_id") % 3 == 0, F.concat(F.lit("/data/left/"), F.col("path"), F.lit(".gz")))
             .otherwise(F.concat(F.lit("left/"), F.col("path"))))
    return n.select("event_id", path.alias("path"))


ODD_NAMES_SQL = with_ctes("""SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN replace(path, '__', '_')
       WHEN event_id % 3 = 0 THEN '/data/left/' || path || '.gz'
       ELSE 'left/' || path END AS path FROM scan_left""", "scan_left")


@query("b2_parse_filename", f"""
SELECT event_id, regexp_extract(b, '{X.FILENAME_RE}', 1) AS ptid,
       regexp_extract(b, '{X.FILENAME_RE}', 2) AS date,
       regexp_extract(b, '{X.FILENAME_RE}', 3) AS tag
FROM (SELECT event_id, regexp_extract(path, '([^/]*)$', 1) AS b FROM ({ODD_NAMES_SQL}))
WHERE regexp_matches(b, '{X.FILENAME_RE}')""")
def b2(spark, sf_dir):
    p = odd_scan_names(spark, sf_dir).select("event_id", X.parse_filename("path").alias("p"))
    return p.filter(F.col("p").isNotNull()).select("event_id", "p.ptid", "p.date", "p.tag")


@query("b3_safe_date", """
SELECT event_id, d FROM (
  SELECT event_id, CAST(try_strptime(s, '%Y-%m-%d') AS DATE) AS d FROM (
    SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '2024-13-45'
                          WHEN event_id % 13 = 0 THEN 'n/a'
                          ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS s FROM events))
WHERE d IS NOT NULL""")
def b3(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    s = (F.when(F.col("event_id") % 9 == 0, F.lit("2024-13-45"))
          .when(F.col("event_id") % 13 == 0, F.lit("n/a"))
          .otherwise(F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd")))
    return ev.select("event_id", X.safe_date(s).alias("d")).dropna(subset=["d"])


_MARK_TOKENS = ["-LRB-", "-RRB-", "COMMA", "-LSB-", "-RSB-"]


def _marked_tokens():
    arr = F.array(*[F.lit(t) for t in _MARK_TOKENS])
    return F.transform("tokens", lambda t, i: F.when(i % 6 == 0, F.element_at(arr, (i % 5 + 1).cast("int"))).otherwise(t))


@query("b4_replace_tokens", with_ctes("""
SELECT doc_id, sent_no, array_to_string(list_transform(list_transform(tokens, lambda t, i:
         CASE WHEN (i - 1) % 6 = 0 THEN ['-LRB-', '-RRB-', 'COMMA', '-LSB-', '-RSB-'][(i - 1) % 5 + 1] ELSE t END),
       lambda t: CASE t WHEN '-LSB-' THEN '[' WHEN '-RSB-' THEN ']' WHEN '-LRB-' THEN '('
                        WHEN '-RRB-' THEN ')' WHEN 'COMMA' THEN ',' ELSE t END), ' ') AS text
FROM sents""", "sents"))
def b4(spark, sf_dir):
    s = FX.sentences(spark, sf_dir)
    mapping = {**X.BRACKET_TOKENS, **X.COLUMN_CORPUS_TOKENS}
    return s.select("doc_id", "sent_no",
                    F.array_join(X.replace_tokens(_marked_tokens(), mapping), " ").alias("text"))


@query("b5_split_entity_token", with_ctes("""
SELECT doc_id, sent_no, ent_idx, n_parts, parts,
  CAST(coalesce(sum(n_parts) OVER (PARTITION BY doc_id, sent_no ORDER BY ent_idx
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS tok_start
FROM (SELECT g.doc_id, g.sent_no, g.ent_idx,
        CAST(len(string_split(w, '/')) AS INTEGER) AS n_parts,
        array_to_string(list_transform(string_split(w, '/'), lambda t: CASE t WHEN 'COMMA' THEN ','
            WHEN '-LRB-' THEN '(' WHEN '-RRB-' THEN ')' ELSE t END), '|') AS parts
      FROM (SELECT *, replace(phrase, ' ', '/') AS w FROM gold) g)""", "gold"))
def b5(spark, sf_dir):
    from pyspark.sql import Window
    from tessera.operators.spans import to_mentions
    docs = FX.gold_docs(spark, sf_dir)
    m = to_mentions(docs, FX.DOC, with_tokens=True)
    w = F.array_join(F.slice("tokens", F.col("start") + 1, F.col("end") - F.col("start")), "/")
    parts = X.split_entity_token(w)
    m = m.select(*FX.DOC, "ent_idx", F.size(parts).alias("n_parts"),
                 F.array_join(parts, "|").alias("parts"))
    win = Window.partitionBy(*FX.DOC).orderBy("ent_idx").rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumn("tok_start", F.coalesce(F.sum("n_parts").over(win), F.lit(0)).cast("long"))


@query("b6_split_glued", with_ctes(r"""
SELECT doc_id, sent_no, string_agg(piece || '@' || CAST(pstart AS VARCHAR), ' ' ORDER BY tok_idx, k) AS pieces
FROM (
  SELECT doc_id, sent_no, tok_idx, k, piece,
         CAST(char_start + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, sent_no, tok_idx ORDER BY k
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS pstart
  FROM (
    SELECT doc_id, sent_no, tok_idx, char_start,
           unnest(generate_series(1, len(ps))) AS k, unnest(ps) AS piece
    FROM (
      SELECT doc_id, sent_no, tok_idx, char_start,
             CASE WHEN contains(g, ')-') THEN flatten(list_transform(string_split(g, ')-'), lambda p, i:
                     (CASE WHEN p <> '' THEN [p] ELSE [] END) ||
                     (CASE WHEN i < len(string_split(g, ')-')) THEN [')', '-'] ELSE [] END)))
                  WHEN g = 'bisabolol-' THEN ['bisabolol', '-'] ELSE [g] END AS ps
      FROM (SELECT doc_id, sent_no, tok_idx, char_start,
                   CASE WHEN tok_idx % 4 = 0 AND nxt IS NOT NULL
                        THEN token || ')-' || nxt ELSE token END AS g FROM toks))))
GROUP BY doc_id, sent_no""", "toks"))
def b6(spark, sf_dir):
    s = FX.sentences(spark, sf_dir)
    toks = F.col("tokens")
    s = s.select("doc_id", "sent_no", "tokens", F.concat(F.slice(toks, 2, F.size(toks)), F.array(F.lit(""))).alias("nxt"), "starts")
    s = s.select("doc_id", "sent_no", F.arrays_zip("tokens", "nxt", "starts").alias("z"))
    glued = F.transform("z", lambda z, i: F.struct(
        F.when((i % 4 == 0) & (z["nxt"] != ""), F.concat(z["tokens"], F.lit(")-"), z["nxt"]))
         .otherwise(z["tokens"]).alias("token"), z["starts"].cast("int").alias("start")))
    out = X.split_glued(glued)
    return s.select("doc_id", "sent_no", F.array_join(F.transform(
        out, lambda z: F.concat(z["token"], F.lit("@"), z["start"].cast("string"))), " ").alias("pieces"))


@query("b7_tokenize_sentence", with_ctes(r"""
SELECT doc_id, sent_no, string_agg(tok || '@' || CAST(st AS VARCHAR), ' ' ORDER BY k) AS toks FROM (
  SELECT doc_id, sent_no, k, tok, st FROM (
    SELECT doc_id, sent_no, k, regexp_replace(p, '^\s+', '') AS tok,
           CAST(sum(length(p)) OVER (PARTITION BY doc_id, sent_no ORDER BY k)
                - length(regexp_replace(p, '^\s+', '')) AS INTEGER) AS st
    FROM (SELECT doc_id, sent_no, unnest(generate_series(1, len(ps))) AS k, unnest(ps) AS p
          FROM (SELECT doc_id, sent_no, regexp_extract_all(CASE WHEN suffix(line, '.')
                   THEN regexp_replace(line, '\.$', '') ELSE line END, '(\s*\S+)', 1) AS ps
                FROM lines WHERE trim(line) <> '')))
  UNION ALL
  SELECT doc_id, sent_no, 1000000, '.', CAST(len(rtrim(b)) AS INTEGER) FROM (
    SELECT doc_id, sent_no, regexp_replace(line, '\.$', '') AS b FROM lines
    WHERE trim(line) <> '' AND suffix(line, '.') AND regexp_matches(regexp_replace(line, '\.$', ''), '\S')))
GROUP BY doc_id, sent_no""", "lines"))
def b7(spark, sf_dir):
    from tessera.operators.spans import tokenize
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("sent_no", "line"))
    lines = lines.filter(F.trim("line") != "").withColumn("sent_no", F.col("sent_no").cast("long"))
    t = tokenize(lines, ["doc_id", "sent_no"], "line", detach_final_dot=True, listed=True)
    a = F.sort_array(F.transform("tokens", lambda z: F.struct(z["tok_idx"], F.concat(z["token"], F.lit("@"), z["char_start"].cast("string")).alias("s"))))
    return t.select("doc_id", "sent_no", F.array_join(F.transform(a, lambda z: z["s"]), " ").alias("toks"))


@query("b8_strip_span", with_ctes("""
SELECT doc_id, sent_no, ent_idx, trim(t) AS text, CAST(cs + (length(t) - length(ltrim(t))) AS INTEGER) AS "start",
       CAST(ce - (length(t) - length(rtrim(t))) AS INTEGER) AS "end"
FROM (SELECT g.doc_id, g.sent_no, g.ent_idx,
        CASE WHEN g.ent_idx % 3 = 0 THEN ' ' || g.phrase || '  ' ELSE g.phrase END AS t,
        CASE WHEN g.ent_idx % 3 = 0 THEN 100 - 1 ELSE 100 END AS cs,
        CASE WHEN g.ent_idx % 3 = 0 THEN 200 + 2 ELSE 200 END AS ce
      FROM gold g)""", "gold"))
def b8(spark, sf_dir):
    from tessera.operators.spans import to_mentions
    m = to_mentions(FX.gold_docs(spark, sf_dir), FX.DOC, with_tokens=True)
    ph = X.phrase("tokens", "start", "end")
    pad = F.col("ent_idx") % 3 == 0
    t = F.when(pad, F.concat(F.lit(" "), ph, F.lit("  "))).otherwise(ph)
    cs = F.when(pad, F.lit(99)).otherwise(F.lit(100))
    ce = F.when(pad, F.lit(202)).otherwise(F.lit(200))
    r = X.strip_span(t, cs, ce)
    return m.select(*FX.DOC, "ent_idx", r["text"].alias("text"), r["start"].alias("start"),
                    r["end"].alias("end"))


@query("b9_capitalize", """
SELECT p_partkey, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS cap FROM part""")
def b9(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.capitalize("p_type").alias("cap"))


@query("b10_phrase", with_ctes("""
SELECT doc_id, sent_no, ent_idx, phrase FROM gold""", "gold"))
def b10(spark, sf_dir):
    from tessera.operators.spans import to_mentions
    m = to_mentions(FX.gold_docs(spark, sf_dir), FX.DOC, with_tokens=True)
    return m.select(*FX.DOC, "ent_idx", X.phrase("tokens", "start", "end").alias("phrase"))


@query("b11_clean_markers", with_ctes("""
SELECT doc_id, sent_no, replace(replace(replace(replace(replace(replace(replace(
  '[CLS] _start_ ' || array_to_string(tokens, ' ') || ' <unk> [SEP] [PAD] [PAD]',
  '_start_', ''), '_classify_', ''), '<unk>', ''), '⁇', ''), '[CLS]', ''), '[SEP]', ''), '[PAD]', '') AS text
FROM sents""", "sents"))
def b11(spark, sf_dir):
    s = FX.sentences(spark, sf_dir)
    t = F.concat(F.lit("[CLS] _start_ "), F.array_join("tokens", " "), F.lit(" <unk> [SEP] [PAD] [PAD]"))
    return s.select("doc_id", "sent_no", X.clean_markers(t).alias("text"))


@query("b12_encode_label", f"""
SELECT event_id, dx_norm, CAST(CASE dx_norm WHEN 'CN' THEN 0 WHEN 'AD' THEN 1 WHEN 'MCI' THEN 2 END AS INTEGER) AS label_idx
FROM (SELECT event_id, {DX_NORM_SQL.format(c='dx')} AS dx_norm FROM ({CLINICAL_SQL})) WHERE dx_norm IS NOT NULL""")
def b12(spark, sf_dir):
    d = clinical_labels(spark, sf_dir).select("event_id", X.normalize_label("dx").alias("dx_norm"))
    d = d.dropna(subset=["dx_norm"])
    return d.select("event_id", "dx_norm", X.encode_label("dx_norm").alias("label_idx"))


@query("b13_filter_labels", f"""
SELECT event_id, dx_norm FROM (SELECT event_id, {DX_NORM_SQL.format(c='dx')} AS dx_norm FROM ({CLINICAL_SQL}))
WHERE dx_norm IN ('AD', 'CN')""")
def b13(spark, sf_dir):
    d = clinical_labels(spark, sf_dir).select("event_id", X.normalize_label("dx").alias("dx_norm"))
    return d.filter(F.col("dx_norm").isin("AD", "CN"))


EMB_SQL = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"


def emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))


@query("b14_scale", f"""
SELECT vec_id, round(list_sum(list_transform(e, lambda x: x * 2 - 1)), 6) AS s_unit,
  round(list_sum(list_transform(e, lambda x: x * 0.5 + 0.5)), 6) AS s_half,
  CAST(list_sum(list_transform(e, lambda x: CAST(trunc(least(greatest(x * 255 + 0.5, 0.0), 255.0)) AS INTEGER))) AS BIGINT) AS s_u8
FROM ({EMB_SQL})""")
def b14(spark, sf_dir):
    e = emb(spark, sf_dir)
    return e.select("vec_id", F.round(A.arr_sum(A.scale("e", 2.0, -1.0)), 6).alias("s_unit"),
                    F.round(A.arr_sum(A.scale("e", 0.5, 0.5)), 6).alias("s_half"),
                    F.aggregate(A.to_uint8("e"), F.lit(0).cast("long"), lambda a, x: a + x).alias("s_u8"))


@query("b15_softmax", f"""
SELECT vec_id,
  round(list_transform(e, lambda x: exp(x - list_max(e)))[1] / list_sum(list_transform(e, lambda x: exp(x - list_max(e)))), 6) AS p0,
  round(e[2] - (ln(list_sum(list_transform(e, lambda x: exp(x - list_max(e))))) + list_max(e)), 6) AS logp1,
  round(list_sum(list_transform(e, lambda x: 1.0 / (1.0 + exp(-x)))), 6) AS s_sigmoid,
  round(list_sum(list_transform(e, lambda x: tanh(x))), 6) AS s_tanh,
  round(list_sum(list_transform(e, lambda x: greatest(x, 0.0))), 6) AS s_relu
FROM ({EMB_SQL})""")
def b15(spark, sf_dir):
    e = emb(spark, sf_dir)
    return e.select("vec_id", F.round(F.element_at(A.softmax("e"), 1), 6).alias("p0"),
                    F.round(F.element_at(A.log_softmax("e"), 2), 6).alias("logp1"),
                    F.round(A.arr_sum(A.sigmoid("e")), 6).alias("s_sigmoid"),
                    F.round(A.arr_sum(A.tanh("e")), 6).alias("s_tanh"),
                    F.round(A.arr_sum(A.relu("e")), 6).alias("s_relu"))


@query("b16_argmax", f"""
SELECT vec_id, CAST(list_position(e, list_max(e)) - 1 AS INTEGER) AS arg FROM ({EMB_SQL})""")
def b16(spark, sf_dir):
    return emb(spark, sf_dir).select("vec_id", A.argmax("e").alias("arg"))


@query("b17_delta_days", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
       CAST(abs(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) AS INTEGER) AS delta
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def b17(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    X.delta_days(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
                    .cast("int").alias("delta"))
