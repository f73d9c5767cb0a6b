"""Splitting, shuffling, batching, sub-sampling and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import splits as G
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query
from tessera.session import table


def _cuts_sql(fracs, names, cumulative):
    parts, acc_f, acc_sql = [], 0.0, []
    for f, nm in zip(fracs[:-1], names[:-1]):
        if cumulative:
            acc_f += f
            parts.append(f"WHEN r < floor(n * {acc_f!r}) THEN '{nm}'")
        else:
            acc_sql.append(f"floor(n * {f!r})")
            parts.append(f"WHEN r < {' + '.join(acc_sql)} THEN '{nm}'")
    return "CASE " + " ".join(parts) + f" ELSE '{names[-1]}' END"


@query("g1_group_split", f"""
SELECT o.o_orderkey, o.o_custkey, s.split FROM orders o JOIN (
  SELECT o_custkey, {_cuts_sql([0.8, 0.1, 0.1], ['train', 'val', 'test'], True)} AS split FROM (
    SELECT o_custkey, row_number() OVER (ORDER BY md5('g1' || CAST(o_custkey AS VARCHAR)), o_custkey) - 1 AS r,
           count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM orders))) s USING (o_custkey)""")
def g1(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return G.group_split(o, "o_custkey", [0.8, 0.1, 0.1], "g1").select("o_orderkey", "o_custkey", "split")


def _exact_sql(tbl, idc, seed, fracs, names):
    return f"""
SELECT {idc}, {_cuts_sql(fracs, names, False)} AS split FROM (
  SELECT {idc}, row_number() OVER (ORDER BY md5('{seed}' || CAST({idc} AS VARCHAR)), {idc}) - 1 AS r,
         count(*) OVER () AS n FROM {tbl})"""


@query("g2_random_split", _exact_sql("documents", "doc_id", "g2", [0.8, 0.1, 0.1], ["train", "val", "test"]))
def g2(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return G.exact_split(d, "doc_id", [0.8, 0.1, 0.1], "g2")


@query("g3_train_test_split", _exact_sql("events", "event_id", "g3", [0.9, 0.1], ["train", "test"]))
def g3(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    return G.exact_split(e, "event_id", [0.9, 0.1], "g3", names=["train", "test"])


@query("g4_shuffle", """
SELECT doc_id, row_number() OVER (ORDER BY md5('g4' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos FROM documents""")
def g4(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return G.shuffle(d, "doc_id", "g4")


@query("g5_batches", with_ctes("""
SELECT doc_id, sent_no, CAST(r // 32 AS BIGINT) AS batch, CAST(r % 32 AS INTEGER) AS pos_in_batch FROM (
  SELECT doc_id, sent_no, row_number() OVER (ORDER BY doc_id, sent_no) - 1 AS r, count(*) OVER () AS n FROM sents)
WHERE r // 32 < n // 32""", "sents"))
def g5(spark, sf):
    s = FX.sentences(spark, sf).select("doc_id", "sent_no")
    return G.to_batches(s, [F.col("doc_id"), F.col("sent_no")], 32, drop_last=True)


@query("g6_linspace_subset", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
WHERE r IN (SELECT DISTINCT CAST(trunc(i * (n - 1) / 49) AS BIGINT) FROM
            (SELECT unnest(generate_series(0, 49)) AS i), (SELECT count(*) AS n FROM documents))""")
def g6(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return G.linspace_subset(d, [F.col("doc_id")], 50)


@query("g7_take_first", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def g7(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return G.take_first(o, [F.col("o_orderkey")], 100)


@query("g8_sampled_accuracy", with_ctes("""
SELECT round(avg(CAST(y_true = y_pred AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM (
  SELECT * FROM class_preds ORDER BY md5('g8' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 100)""", "class_preds"))
def g8(spark, sf):
    cp = FX.class_preds(spark, sf).withColumn("_all", F.lit(0))
    s = G.sample_per_class(cp, "_all", "vec_id", 100, "g8")   # <= n rows, md5 order
    return s.agg(F.round(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")), 6).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))


@query("g9_sort", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos FROM orders""")
def g9(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    r = G.global_rank(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "pos")
    return r.select("o_orderkey", "pos")
