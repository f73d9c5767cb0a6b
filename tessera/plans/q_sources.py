"""Sources and sinks. Each query writes data derived from the driver's
tables in the reference's file layout into the shared checkpoint folder, then
reads it back with the reader under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import spans as S
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query
from tessera.session import table
from tessera.sources import readers as RD
from tessera.sources import writers as WR

DOC = FX.DOC


def _dir(spark, sf, name):
    return RD.new_folder(spark, sf, name)


def _m1(spark, sf):
    d = FX.gold_docs(spark, sf)
    return d.select("tokens", "entities", "relations",
                    F.concat_ws("_", F.col("doc_id").cast("string"), F.col("sent_no").cast("string")).alias("orig_id"),
                    "doc_id")


_M1_SQL = """
SELECT CAST(s.doc_id AS VARCHAR) || '_' || CAST(s.sent_no AS VARCHAR) AS orig_id, s.doc_id, array_to_string(s.tokens, ' ') AS text,
       coalesce(e.l, '') AS entities, coalesce(r.l, '') AS relations
FROM sents s LEFT JOIN (SELECT doc_id, sent_no, string_agg(type || ':' || "start" || ':' || "end", ' ' ORDER BY ent_idx) AS l FROM gold GROUP BY ALL) e
  ON e.doc_id = s.doc_id AND e.sent_no = s.sent_no
LEFT JOIN (SELECT doc_id, sent_no, string_agg(type || ':' || head || ':' || tail, ' ' ORDER BY rel_idx) AS l FROM gold_rel GROUP BY ALL) r
  ON r.doc_id = s.doc_id AND r.sent_no = s.sent_no"""
_M1_ROWS = with_ctes(f"SELECT orig_id, text, entities, relations FROM ({_M1_SQL})", "sents", "gold", "gold_rel")


def _listed(col, *fields):
    return F.array_join(F.transform(col, lambda e: F.concat_ws(":", *[e[f].cast("string") for f in fields])), " ").alias(col)


def _contents(df, *more):
    """A document as text: its id, tokens, entities and relations."""
    return df.select(*more, "orig_id", F.array_join("tokens", " ").alias("text"), _listed("entities", "type", "start", "end"), _listed("relations", "type", "head", "tail"))


@query("a1_read_docs", _M1_ROWS)
def a1(spark, sf):
    p = _dir(spark, sf, "a1")
    WR.write_doc_arrays(_m1(spark, sf).drop("doc_id"), p)
    return _contents(RD.read_docs(spark, p))


@query("a2_read_split_docs", with_ctes(f"""
SELECT CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'dev' ELSE 'test' END AS split,
       orig_id, text, entities, relations FROM ({_M1_SQL})""", "sents", "gold", "gold_rel"))
def a2(spark, sf):
    p = _dir(spark, sf, "a2")
    d = _m1(spark, sf)
    split = F.when(F.col("doc_id") % 10 < 8, "train").when(F.col("doc_id") % 10 == 8, "dev").otherwise("test")
    docs = F.struct("tokens", "entities", "relations", "orig_id")
    WR.write_bundles(d.select(split.alias("kind"), F.to_json(docs).alias("value")), p, ("train", "dev", "test"))
    return _contents(RD.read_split_docs(spark, p), "split")


@query("a3_read_untagged", with_ctes("""
SELECT CASE WHEN (doc_id + sent_no) % 3 = 0 THEN 'list' WHEN (doc_id + sent_no) % 3 = 1 THEN 'object' ELSE 'text' END AS kind,
       CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS text FROM sents""", "sents"))
def a3(spark, sf):
    p = _dir(spark, sf, "a3")
    s = FX.sentences(spark, sf)
    k = (F.col("doc_id") + F.col("sent_no")) % 3
    line = (F.when(k == 0, F.to_json("tokens")).when(k == 1, F.to_json(F.struct("tokens")))
             .otherwise(F.to_json(F.array(F.array_join("tokens", " ")))))
    # plain-text records are JSON strings: strip the one-element array brackets
    line = F.when(k == 2, F.regexp_replace(F.regexp_replace(line, r"^\[", ""), r"\]$", "")).otherwise(line)
    s.select(line.alias("value")).write.mode("overwrite").text(p)
    r = RD.read_untagged(spark, p)
    return r.select("kind", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("text"))


@query("a4_read_jsonl", "SELECT event_id, user_id, event_type FROM events")
def a4(spark, sf):
    p = _dir(spark, sf, "a4")
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    js = F.to_json(F.struct("event_id", "user_id", "event_type"))
    # a blank line after every record
    ev.select(F.concat(js, F.lit("\n")).alias("value")).write.mode("overwrite").text(p)
    return RD.read_jsonl(spark, p, "event_id long, user_id long, event_type string")


@query("a6_read_pipe_relations", with_ctes("""
SELECT CAST(doc_id AS VARCHAR) AS doc, sentence, trim(eff) AS effect,
       CAST(hs AS INTEGER) AS e_start, CAST(he AS INTEGER) AS e_end, trim(drg) AS drug,
       CAST(ts_ AS INTEGER) AS d_start, CAST(te AS INTEGER) AS d_end FROM (
  SELECT r.doc_id, s.sentence, r.hs, r.he, r.ts_, r.te, replace(hp, '|', '/') AS eff, replace(tp, '|', '/') AS drg
  FROM gold_relx r JOIN (SELECT doc_id, sent_no, replace(array_to_string(tokens, ' '), '|', '/') AS sentence FROM sents) s
    ON s.doc_id = r.doc_id AND s.sent_no = r.sent_no)""", "gold_relx", "sents"))
def a6(spark, sf):
    p = _dir(spark, sf, "a6")
    # a document holds its sentence, and the others of its key where that comes again; only then are there rows a relation, whose
    # sentence repeats in the (compressed) lines
    d = S.gathered(FX.gold_docs(spark, sf), DOC, "entities", "relations", "tokens")
    d = d.select(*DOC, "tokens", F.explode(F.arrays_zip("entities", "relations")).alias("d")).select(*DOC, "d.*", F.explode("tokens").alias("tokens"))
    d = d.withColumn("sentence", F.replace(F.array_join("tokens", " "), F.lit("|"), F.lit("/")))
    r = S.relations_with_spans(d, DOC, ["tokens", "sentence"])
    def ph(s, e):   # the pipe is the field separator: it cannot occur inside a field
        return F.replace(F.array_join(F.slice("tokens", F.col(s) + 1, F.col(e) - F.col(s)), " "), F.lit("|"), F.lit("/"))
    line = F.concat_ws("|", F.col("doc_id").cast("string"), "sentence",
                       ph("hs", "he"),
                       F.concat(F.lit(" "), F.col("hs").cast("string")), F.col("he").cast("string"), ph("ts_", "te"),
                       F.col("ts_").cast("string"), F.concat(F.col("te").cast("string"), F.lit(" ")))
    r.select(line.alias("value")).write.mode("overwrite").option("compression", "gzip").text(p)
    out = RD.read_pipe_relations(spark, p)
    return out.select("doc", "sentence", F.trim("effect").alias("effect"), "e_start", "e_end",
                      F.trim("drug").alias("drug"), "d_start", "d_end")


@query("a7_filter_by_index", with_ctes("SELECT doc_id, sent_no FROM sents WHERE doc_id % 3 = 0", "sents"))
def a7(spark, sf):
    p = _dir(spark, sf, "a7")
    docs = table(spark, sf, "documents").filter(F.col("doc_id") % 3 == 0)
    docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(":doc")).alias("value")).write.mode("overwrite").text(p)
    return RD.filter_by_index(FX.sentences(spark, sf).select(*DOC), spark.read.text(p), "doc_id")


@query("a8_read_labels", """
SELECT CAST(user_id AS VARCHAR) AS PTID, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS EXAMDATE, event_type AS DX FROM events""")
def a8(spark, sf):
    p = _dir(spark, sf, "a8")
    ev = table(spark, sf, "events").select(F.col("user_id").alias("PTID"),
                                           F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd").alias("EXAMDATE"),
                                           F.col("event_type").alias("DX_bl"), F.col("value").alias("OTHER"))
    WR.write_csv(ev, p)
    return RD.read_labels(spark, p)


@query("a9_read_series", """
SELECT label, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS s FROM embeddings""")
def a9(spark, sf):
    p = _dir(spark, sf, "a9")
    e = table(spark, sf, "embeddings")
    cols = [F.element_at(F.col("embedding").cast("array<double>"), i + 1).alias(f"c{i}") for i in range(64)]
    WR.write_csv(e.select(*cols, "label"), p, header=False)
    r = RD.read_series(spark, p)
    return r.select("label", F.size("series").alias("n"),
                    F.round(F.aggregate("series", F.lit(0.0), lambda a, x: a + x), 4).alias("s"))


def _graph_files(spark, sf):
    """The graph collection as text files: graphs numbered from 1 by their id, nodes from 1 through all graphs."""
    from tessera.operators.splits import global_rank
    nodes, edges, graphs = FX.graph_tables(spark, sf)
    g = global_rank(graphs, [F.col("graph_id")], "g").withColumn("g", F.col("g") + 1)
    n = global_rank(nodes.select("graph_id", "node"), [F.col("graph_id"), F.col("node")], "n").withColumn("n", F.col("n") + 1)
    # nodes of a graph are numbered from 0 and follow one another: the number of its first gives those of both ends of an edge
    first = n.filter(F.col("node") == 0).select("graph_id", F.col("n").alias("first"))
    e = edges.join(first, "graph_id").select((F.col("first") + F.col("src")).alias("i"), (F.col("first") + F.col("dst")).alias("j"))
    folder = _dir(spark, sf, "a12")
    paths = {k: f"{folder}/{k}" for k in ("edges", "indicator", "labels", "attributes")}
    write = lambda df, k: df.write.option("compression", "gzip").text(paths[k])
    write(e.select(F.concat_ws(", ", "i", "j").alias("value")), "edges")
    of = n.join(g.select("graph_id", "g"), "graph_id")
    write(of.orderBy("n").select(F.col("g").cast("string").alias("value")), "indicator")
    write(nodes.orderBy("graph_id", "node").select(F.array_join(F.transform("x", lambda v: v.cast("string")), ", ").alias("value")), "attributes")
    write(g.orderBy("g").select(F.col("label").cast("string").alias("value")), "labels")
    return paths


_GRAPHS_SQL = """, gno AS MATERIALIZED (SELECT graph_id, label, row_number() OVER (ORDER BY graph_id) AS g FROM ggraphs)"""


@query("a12_read_graphs", with_ctes(_GRAPHS_SQL + """
SELECT g.g AS graph_id, g.label, n.node, round(n.x[1], 6) AS x0, round(n.x[2], 6) AS x1, round(n.x[3], 6) AS x2, round(n.x[4], 6) AS x3,
       coalesce(e.out, '') AS out
FROM gno g JOIN gnodes n ON n.graph_id = g.graph_id
LEFT JOIN (SELECT graph_id, src, string_agg(dst, ',' ORDER BY dst) AS out FROM gedges GROUP BY ALL) e ON e.graph_id = n.graph_id AND e.src = n.node""",
    "ggraphs", "gnodes", "gedges").replace("\n, gno", ", gno"))
def a12(spark, sf):
    """Every node of the collection read back, with its graph's label, its features and where its edges lead."""
    nodes, edges, _ = RD.read_graphs(spark, **_graph_files(spark, sf), numbered=True)
    out = edges.groupBy("n").agg(F.sort_array(F.collect_list("dst")).alias("out"))
    j = nodes.join(out, "n", "left")
    return j.select("graph_id", "label", "node", *[F.round(F.element_at("x", i + 1), 6).alias(f"x{i}") for i in range(4)],
                    F.coalesce(F.array_join(F.col("out").cast("array<string>"), ","), F.lit("")).alias("out"))


@query("a12_graph_counts", with_ctes("""
SELECT (SELECT count(*) FROM ggraphs) AS n_graphs, (SELECT count(*) FROM gnodes) AS n_nodes,
       (SELECT count(*) FROM gedges) AS n_edges""", "ggraphs", "gnodes", "gedges"))
def a12_counts(spark, sf):
    return RD.graph_counts(*RD.read_graphs(spark, **_graph_files(spark, sf)))


@query("a13_load_types", with_ctes("""
SELECT kind, name, CAST(idx AS INTEGER) AS idx, "short", "verbose", "symmetric" FROM (
  SELECT 'entities' AS kind, type AS name, row_number() OVER (ORDER BY min(doc_id * 4294967296 + sent_no), type) AS idx,
         upper(substr(type, 1, 3)) AS "short", type AS "verbose", false AS "symmetric" FROM gold GROUP BY type
  UNION ALL SELECT 'relations', type, row_number() OVER (ORDER BY min(doc_id * 4294967296 + sent_no), type),
         upper(substr(type, 1, 3)), type, type = 'associated_with' FROM gold_rel GROUP BY type
  UNION ALL SELECT 'entities', 'None', 0, 'None', 'No Entity', false UNION ALL SELECT 'relations', 'None', 0, 'None', 'No Relation', false)""", "gold", "gold_rel"))
def a13(spark, sf):
    from pyspark.sql import Window
    p = _dir(spark, sf, "a13")
    d = FX.gold_docs(spark, sf)
    key = F.col("doc_id") * 4294967296 + F.col("sent_no")
    ents = S.to_mentions(d, DOC).groupBy("type").agg(F.min(key).alias("first"))
    rels = S.to_relations(d, DOC).groupBy("type").agg(F.min(key).alias("first"))
    w = Window.orderBy("first", "type")   # one row per type: a handful

    def reg(df, sym):
        r = df.withColumn("pos", F.row_number().over(w))
        v = F.struct(F.upper(F.substring("type", 1, 3)).alias("short"), F.col("type").alias("verbose"),
                     *([F.col("type").isin(*FX.SYMMETRIC_RELATIONS).alias("symmetric")] if sym else []))
        return r.agg(F.sort_array(F.collect_list(F.struct("pos", "type", v.alias("v")))).alias("a"))

    # the registry file keeps key order: build the JSON object text in position order
    def obj(a):
        return F.concat(F.lit("{"), F.array_join(F.transform(a, lambda z: F.concat(
            F.lit('"'), z["type"], F.lit('":'), F.to_json(z["v"]))), ","), F.lit("}"))

    e, r = reg(ents, False), reg(rels, True)
    eo = e.select(obj(F.col("a"))).first()[0]     # registry text: one entry per type
    ro = r.select(obj(F.col("a"))).first()[0]
    spark.createDataFrame([('{"entities":' + eo + ',"relations":' + ro + "}",)], "value string") \
        .coalesce(1).write.mode("overwrite").text(p)
    return RD.load_types(spark, p)


@query("a14_read_parallel", """
SELECT 'BOS ' || CAST(event_id % 100 AS VARCHAR) || ' EOS' AS inp_expression,
       CAST(event_id % 100 * 2 AS VARCHAR) AS out_expression FROM events""")
def a14(spark, sf):
    p = _dir(spark, sf, "a14")
    ev = table(spark, sf, "events").select(
        F.concat(F.lit("BOS "), (F.col("event_id") % 100).cast("string"), F.lit(" EOS")).alias("i"),
        (F.col("event_id") % 100 * 2).cast("string").alias("o"), "event_id")
    ev = ev.withColumn("_b", WR.file_of(F.col("event_id"), WR.files_of(ev, F.concat("i", F.lit('"",'), "o", F.lit('"",')))))
    g = ev.groupBy("_b").agg(F.collect_list(F.struct("i", "o")).alias("z"))
    g.select("_b", F.to_json(F.struct(F.transform("z", lambda x: x["i"]).alias("inp_expression"),
                                      F.transform("z", lambda x: x["o"]).alias("out_expression"))).alias("value")) \
        .write.mode("overwrite").partitionBy("_b").text(p)
    return RD.read_parallel(spark, p)


@query("a15_write_docs", _M1_ROWS)
def a15(spark, sf):
    p = _dir(spark, sf, "a15")
    WR.write_docs(_m1(spark, sf).drop("doc_id"), p)
    return _contents(RD.read_jsonl(spark, p, RD.DOC_SCHEMA))


@query("a16_write_csv", with_ctes("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(sent_no AS VARCHAR) AS sent_no, array_to_string(tokens, ' ') AS text FROM sents""",
    "sents"))
def a16(spark, sf):
    p = _dir(spark, sf, "a16")
    s = FX.sentences(spark, sf).select("doc_id", "sent_no", F.array_join("tokens", " ").alias("text"))
    WR.write_csv(s, p, sep="\t")
    return spark.read.option("sep", "\t").option("header", True).csv(p)


@query("a17_append_metrics", """
SELECT event_type AS label, CAST(day(ts) AS INTEGER) AS epoch, round(avg(value), 6) AS metric, 'run1' AS run FROM events GROUP BY ALL
UNION ALL SELECT event_type, CAST(day(ts) AS INTEGER), round(avg(value), 6), 'run2' FROM events GROUP BY ALL""")
def a17(spark, sf):
    p = _dir(spark, sf, "a17")
    ev = table(spark, sf, "events")
    h = ev.groupBy(F.col("event_type").alias("label"), F.dayofmonth("ts").alias("epoch")).agg(
        F.round(F.avg("value"), 6).alias("metric"))
    WR.append_metrics(h.withColumn("run", F.lit("run1")), p)
    WR.append_metrics(h.withColumn("run", F.lit("run2")), p)
    return spark.read.parquet(p).select("label", "epoch", "metric", "run")


_TAGS = ["click", "error", "purchase", "signup", "view"]


@query("a18_pivot_history", f"""
SELECT epoch, {', '.join(f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in _TAGS)}
FROM (SELECT CAST(day(ts) AS INTEGER) AS epoch, event_type, value FROM events) GROUP BY epoch""")
def a18(spark, sf):
    ev = table(spark, sf, "events")
    h = ev.groupBy(F.dayofmonth("ts").alias("epoch"), "event_type").agg(F.round(F.avg("value"), 6).alias("metric"))
    return WR.pivot_history(h, "epoch", "event_type", "metric", _TAGS)


@query("a10_list_files", with_ctes("""
SELECT ptid, date, tag, first(name ORDER BY suffix(name, '.gz') DESC, name DESC) AS name FROM (
  SELECT regexp_extract(name, '^(\\d+_S_\\d+)__', 1) AS ptid, regexp_extract(name, '__(\\d{4}-\\d{2}-\\d{2})__', 1) AS date,
         regexp_extract(name, '^\\d+_S_\\d+__\\d{4}-\\d{2}-\\d{2}__(.+?)\\.csv(?:\\.gz)?$', 1) AS tag, name
  FROM (SELECT path AS name FROM scan_left UNION ALL SELECT path || '.gz' FROM scan_left WHERE event_id % 5 = 0))
GROUP BY ALL""", "scan_left"))
def a10(spark, sf):
    """The scan files in a folder tree, by their names; the '.gz' file wins for the same key. The tree holds
    real files, one for each scan, in a folder for each site, and others that do not match."""
    from tessera.functions import text as X
    from tessera.operators.joins import latest_per_key
    p = _dir(spark, sf, "a10")
    n = FX.scan_names(spark, sf, "view")
    gz = n.filter(F.col("event_id") % 5 == 0).select("event_id", F.concat("path", F.lit(".gz")).alias("path"))
    site = F.concat(F.lit("site"), F.split_part("path", F.lit("_"), F.lit(1)).cast("int") % 10, F.lit("/left/"))
    names = n.unionByName(gz).select(F.concat(site, "path").alias("name")).distinct()
    other = n.filter(F.col("event_id") % 50 == 0).select(F.concat(site, F.lit("notes "), F.col("event_id").cast("string"), F.lit(".csv")).alias("name"))
    other = other.unionByName(n.filter(F.col("event_id") % 50 == 1).select(F.concat(site, "path", F.lit(".txt")).alias("name")))
    WR.write_named_files(names.unionByName(other.distinct()).withColumn("value", F.lit("0 0\n")), p)
    files = RD.list_files(spark, p, "*.{csv,csv.gz}")
    parsed = files.select("name", X.parse_filename("name").alias("x")).filter(F.col("x").isNotNull())
    keyed = parsed.select("x.ptid", "x.date", "x.tag", "name")
    return latest_per_key(keyed, ["ptid", "date", "tag"], "name")


@query("a11_read_matrix", """
SELECT vec_id, CAST(r AS INTEGER) AS "row", round(list_sum(CAST(embedding AS DOUBLE[])[r * 8 + 1:r * 8 + 8]), 4) AS s,
       round(CAST(embedding[r * 8 + 3] AS DOUBLE), 6) AS v
FROM embeddings, (SELECT unnest(generate_series(0, 7)) AS r) rr""")
def a11(spark, sf):
    """One whitespace-separated 8x8 matrix per vector, many to a (compressed) file, read back as (name, row, values)."""
    p = _dir(spark, sf, "a11")
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.array_join(
        F.transform(F.slice("x", r * 8 + 1, 8), lambda v: F.format_string("%.9g", v)), "  "))
    text = F.concat(F.lit(RD.MATRIX_MARK), F.col("vec_id").cast("string"), F.lit("\n"), F.array_join(rows, "\n"), F.lit("\n"))
    e = e.select("vec_id", text.alias("value"))
    files = WR.files_of(e, F.col("value"))
    e.repartition(files, "vec_id").select("value").write.option("compression", "gzip").text(p)
    m = RD.read_matrix(spark, p)
    return m.select(F.col("name").cast("long").alias("vec_id"), F.col("row").cast("int").alias("row"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, v: a + v), 4).alias("s"), F.round(F.element_at("values", 3).cast("float").cast("double"), 6).alias("v"))


def _conll_files(spark, sf, p):
    """Column-corpus files: 8 parts of as many bounded files as the data needs;
    in each part, the last document lacks its closing blank line (so the
    reader must drop it)."""
    d = FX.gold_docs(spark, sf)
    oid = (F.col("doc_id") * 4294967296 + F.col("sent_no"))
    single = F.filter("entities", lambda e: e["end"] - e["start"] == 1)
    # the type of each token: runs of O between the single-token entities, which are sorted and do not overlap
    ends = F.transform(single, lambda e: e["end"])
    before = F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(single))
    runs = F.transform(F.arrays_zip(single.alias("e"), before.alias("b")), lambda z: F.concat(
        F.array_repeat(F.lit("O"), z["e"]["start"] - z["b"]), F.array(z["e"]["type"])))
    rest = F.array_repeat(F.lit("O"), F.size("tokens") - F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)))
    tok_type = F.concat(F.flatten(runs), rest)
    safe = F.transform("tokens", lambda t: F.replace(t, F.lit("|"), F.lit("!")))
    d = d.select(oid.alias("oid"), safe.alias("tokens"), tok_type.alias("tt"), "entities", "relations")
    tline = F.transform(F.arrays_zip(F.col("tokens").alias("t"), F.col("tt").alias("y")), lambda z, i: F.concat_ws(
        "\t", F.col("oid").cast("string"), z["y"], i.cast("string"), F.lit("O"), F.lit("X"), z["t"], F.lit("O"),
        F.lit("O"), F.lit("O")))
    ents = F.col("entities")
    rl = F.filter(F.transform("relations", lambda r: F.when(
        (F.element_at(ents, r["head"] + 1)["end"] - F.element_at(ents, r["head"] + 1)["start"] == 1)
        & (F.element_at(ents, r["tail"] + 1)["end"] - F.element_at(ents, r["tail"] + 1)["start"] == 1),
        F.concat_ws("\t", F.element_at(ents, r["head"] + 1)["start"].cast("string"),
                    F.element_at(ents, r["tail"] + 1)["start"].cast("string"), r["type"]))), lambda x: x.isNotNull())
    d = d.select("oid", F.array_join(tline, "\n").alias("tl"), F.array_join(rl, "\n").alias("rl"), F.size(rl).alias("nr"),
                 (F.col("oid") % 8).alias("_b"))
    block = F.concat("tl", F.lit("\n\n"), F.when(F.col("nr") > 0, F.concat("rl", F.lit("\n"))).otherwise(F.lit("")))
    d = d.select("oid", "_b", block.alias("blk"))
    ends = F.broadcast(d.groupBy("_b").agg(F.max("oid").alias("_end")))   # 8 rows
    d = d.join(ends, "_b").withColumn("_c", WR.file_of(F.col("oid"), -(-WR.files_of(d, F.col("blk")) // 8)))
    g = d.groupBy("_b", "_c").agg(F.sort_array(F.collect_list(F.struct("oid", "blk"))).alias("a"),
                                  F.max(F.col("oid") == F.col("_end")).alias("open"))
    body = F.array_join(F.transform("a", lambda z: z["blk"]), "\n")   # every block but the last gets its 2nd blank
    body = F.concat(body, F.when(F.col("open"), "").otherwise("\n"))   # and the last, if it does not end its part
    g.select("_b", "_c", body.alias("value")).write.mode("overwrite").option("compression", "gzip").partitionBy("_b", "_c").text(p)


@query("a5_read_conll", with_ctes("""
, o AS MATERIALIZED (SELECT doc_id, sent_no, doc_id * 4294967296 + sent_no AS o,
    max(doc_id * 4294967296 + sent_no) OVER (PARTITION BY (doc_id * 4294967296 + sent_no) % 8) AS last_o FROM sents),
single AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, sent_no ORDER BY "start") - 1 AS no FROM gold WHERE "end" - "start" = 1),
parts AS MATERIALIZED (SELECT t.doc_id, t.sent_no, t.tok_idx, g.type, g.no, CASE WHEN g.type IS NULL THEN [replace(t.token, '|', '!')] ELSE string_split(replace(t.token, '|', '!'), '/') END AS ps
  FROM toks t LEFT JOIN single g ON g.doc_id = t.doc_id AND g.sent_no = t.sent_no AND g."start" = t.tok_idx),
placed AS MATERIALIZED (SELECT *, list_transform(ps, lambda p: CASE p WHEN 'COMMA' THEN ',' WHEN '-LRB-' THEN '(' WHEN '-RRB-' THEN ')' ELSE p END) AS rs,
  CAST(sum(len(ps)) OVER (PARTITION BY doc_id, sent_no ORDER BY tok_idx) - len(ps) AS INTEGER) AS place FROM parts),
docs AS (SELECT doc_id, sent_no, string_agg(array_to_string(rs, ' '), ' ' ORDER BY tok_idx) AS text,
  coalesce(string_agg(type || ':' || place || ':' || (place + len(ps)), ' ' ORDER BY tok_idx) FILTER (WHERE type IS NOT NULL), '') AS entities FROM placed GROUP BY ALL),
rels AS (SELECT r.doc_id, r.sent_no, string_agg(r.type || ':' || h.no || ':' || t.no, ' ' ORDER BY r.rel_idx) AS relations FROM gold_relx r
  JOIN single h ON h.mkey = (CAST(r.doc_id AS HUGEINT) * 4294967296 + r.sent_no) * 4294967296 + r.head
  JOIN single t ON t.mkey = (CAST(r.doc_id AS HUGEINT) * 4294967296 + r.sent_no) * 4294967296 + r.tail GROUP BY ALL)
SELECT CAST(o.o AS VARCHAR) AS orig_id, d.text, d.entities, coalesce(r.relations, '') AS relations FROM o
JOIN docs d ON d.doc_id = o.doc_id AND d.sent_no = o.sent_no LEFT JOIN rels r ON r.doc_id = o.doc_id AND r.sent_no = o.sent_no
WHERE o.o <> o.last_o""", "sents", "toks", "gold", "gold_relx").replace("\n\n, o AS", ", o AS"))
def a5(spark, sf):
    p = _dir(spark, sf, "a5")
    _conll_files(spark, sf, p)
    return _contents(RD.read_conll(spark, p))
