"""Graph collection operators as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import normalize_features
from tessera.operators import graph as GR
from tessera.plans import fixtures as FX
from tessera.plans.fixtures_sql import with_ctes
from tessera.plans.registry import query

W1 = [[0.5, -0.2, 0.1, 0.3], [0.1, 0.4, -0.3, 0.2]]
W2 = [[1.0, -0.5], [0.3, 0.8]]


def _prep(spark, sf):
    nodes, edges, graphs = FX.graph_tables(spark, sf)
    nodes = nodes.withColumn("x", normalize_features("x"))
    loops = GR.add_self_loops(edges, nodes)
    deg = GR.in_degree(loops, nodes)
    return nodes, edges, graphs, loops, deg


_NORM = """list_transform(x, lambda v: (v - list_min(x)) / greatest(list_sum(list_transform(x, lambda u: u - list_min(x))), 1.0))"""
_SQL_PREP = f"""
nx AS (SELECT graph_id, node, {_NORM} AS x FROM gnodes),
loops AS (SELECT graph_id, src, dst FROM gedges UNION ALL SELECT graph_id, node, node FROM gnodes),
deg AS (SELECT n.graph_id, n.node, count(l.dst) AS deg FROM gnodes n LEFT JOIN loops l
        ON l.graph_id = n.graph_id AND l.dst = n.node GROUP BY ALL),
we AS (SELECT l.graph_id, l.src, l.dst, CASE WHEN a.deg > 0 THEN pow(a.deg, -0.5) ELSE 0 END
                                        * CASE WHEN b.deg > 0 THEN pow(b.deg, -0.5) ELSE 0 END AS w
       FROM loops l JOIN deg a ON a.graph_id = l.graph_id AND a.node = l.src
       JOIN deg b ON b.graph_id = l.graph_id AND b.node = l.dst)"""


def _sql(body, *extra):
    base = with_ctes("SELECT 1", "gnodes", "gedges", "ggraphs")
    return base[:base.rindex("\nSELECT 1")] + ",\n" + _SQL_PREP + (",\n" + ",\n".join(extra) if extra else "") + "\n" + body


@query("d12_gather", _sql("""
SELECT e.graph_id, e.src, e.dst, round(list_sum(n.x), 6) AS fsum FROM gedges e
JOIN nx n ON n.graph_id = e.graph_id AND n.node = e.src"""))
def d12(spark, sf):
    nodes, edges, *_ = _prep(spark, sf)
    g = GR.gather(edges, nodes, "x")
    return g.select("graph_id", "src", "dst", F.round(F.aggregate("x_src", F.lit(0.0), lambda a, v: a + v), 6).alias("fsum"))


@query("f15_graph_stats", _sql("""
SELECT count(*) AS n_graphs, count(DISTINCT label) AS n_classes, 4 AS n_features,
       round(avg(nn), 6) AS mean_nodes, round(avg(coalesce(ne, 0)), 6) AS mean_edges
FROM ggraphs g JOIN (SELECT graph_id, count(*) AS nn FROM gnodes GROUP BY 1) a USING (graph_id)
LEFT JOIN (SELECT graph_id, count(*) AS ne FROM gedges GROUP BY 1) b USING (graph_id)"""))
def f15(spark, sf):
    nodes, edges, graphs = FX.graph_tables(spark, sf)
    s = GR.graph_stats(nodes, edges, graphs)
    return s.select("n_graphs", "n_classes", F.col("n_features").cast("int").alias("n_features"),
                    F.round("mean_nodes", 6).alias("mean_nodes"), F.round("mean_edges", 6).alias("mean_edges"))


@query("h7_add_self_loops", _sql("SELECT graph_id, count(*) AS n_edges FROM loops GROUP BY 1"))
def h7(spark, sf):
    _, _, _, loops, _ = _prep(spark, sf)
    return loops.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n_edges"))


@query("h8_in_degree", _sql("SELECT graph_id, node, deg FROM deg"))
def h8(spark, sf):
    *_, deg = _prep(spark, sf)
    return deg.select("graph_id", "node", "deg")


@query("h9_sym_norm", _sql("SELECT graph_id, src, dst, round(w, 6) AS w FROM we"))
def h9(spark, sf):
    _, _, _, loops, deg = _prep(spark, sf)
    return GR.sym_norm(loops, deg).select("graph_id", "src", "dst", F.round("w", 6).alias("w"))


@query("h12_normalize_features", _sql("""
SELECT graph_id, node, round(x[1], 6) AS f0, round(x[2], 6) AS f1, round(x[3], 6) AS f2, round(x[4], 6) AS f3 FROM nx"""))
def h12(spark, sf):
    nodes, *_ = _prep(spark, sf)
    return nodes.select("graph_id", "node", *[F.round(F.element_at("x", i + 1), 6).alias(f"f{i}") for i in range(4)])


_HOPS = [
    """h1 AS (SELECT graph_id, node, [0.5 * x[1] - 0.2 * x[2] + 0.1 * x[3] + 0.3 * x[4],
                                       0.1 * x[1] + 0.4 * x[2] - 0.3 * x[3] + 0.2 * x[4]] AS h FROM nx)""",
    """x1 AS (SELECT n.graph_id, n.node, [greatest(coalesce(s0, 0.0), 0.0), greatest(coalesce(s1, 0.0), 0.0)] AS x
            FROM gnodes n LEFT JOIN (SELECT e.graph_id, e.dst AS node, sum(e.w * h.h[1]) AS s0, sum(e.w * h.h[2]) AS s1
            FROM we e JOIN h1 h ON h.graph_id = e.graph_id AND h.node = e.src GROUP BY ALL) m USING (graph_id, node))""",
    """h2 AS (SELECT graph_id, node, [1.0 * x[1] - 0.5 * x[2], 0.3 * x[1] + 0.8 * x[2]] AS h FROM x1)""",
    """x2 AS (SELECT n.graph_id, n.node, [greatest(coalesce(s0, 0.0), 0.0), greatest(coalesce(s1, 0.0), 0.0)] AS x
            FROM gnodes n LEFT JOIN (SELECT e.graph_id, e.dst AS node, sum(e.w * h.h[1]) AS s0, sum(e.w * h.h[2]) AS s1
            FROM we e JOIN h2 h ON h.graph_id = e.graph_id AND h.node = e.src GROUP BY ALL) m USING (graph_id, node))"""]


def _two_hops(spark, sf):
    nodes, edges, _ = FX.graph_tables(spark, sf)
    return GR.propagate(nodes.withColumn("x", normalize_features("x")), edges, [W1, W2], "x")


@query("h10_propagate", _sql("SELECT graph_id, node, round(x[1], 6) AS h0, round(x[2], 6) AS h1 FROM x2", *_HOPS))
def h10(spark, sf):
    x2 = _two_hops(spark, sf)
    return x2.select("graph_id", "node", F.round(F.element_at("x", 1), 6).alias("h0"),
                     F.round(F.element_at("x", 2), 6).alias("h1"))


@query("h11_mean_pool", _sql("""
SELECT graph_id, round(avg(x[1]), 6) AS p0, round(avg(x[2]), 6) AS p1 FROM x2 GROUP BY graph_id""", *_HOPS))
def h11(spark, sf):
    p = GR.mean_pool(_two_hops(spark, sf), "x", 2)
    return p.select("graph_id", F.round(F.element_at("x", 1), 6).alias("p0"), F.round(F.element_at("x", 2), 6).alias("p1"))
