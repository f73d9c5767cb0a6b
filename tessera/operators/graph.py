"""Graph-collection operators (D12, F15, H7-H12): edges and nodes are
DataFrames keyed by graph id. Single steps are joins and aggregates on
(graph, node). Propagation over several hops deals a collection by graph once;
all that follows (degrees, lookups of neighbours, sums) finds its rows there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add_self_loops(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """H7."""
    loops = nodes.select("graph_id", F.col("node").alias("src"), F.col("node").alias("dst"))
    return edges.select("graph_id", "src", "dst").unionByName(loops)


def in_degree(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """H8: in-degree per node (edges already hold the self loops); 0 filled."""
    d = edges.groupBy("graph_id", F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("deg"))
    return nodes.select("graph_id", "node").join(d, ["graph_id", "node"], "left").fillna(0, ["deg"])


def sym_norm(edges: DataFrame, deg: DataFrame) -> DataFrame:
    """H9: w = deg(src)^-1/2 * deg(dst)^-1/2, infinities -> 0."""
    ds = deg.select("graph_id", F.col("node").alias("src"), F.col("deg").alias("ds"))
    dd = deg.select("graph_id", F.col("node").alias("dst"), F.col("deg").alias("dd"))
    j = edges.join(ds, ["graph_id", "src"], "left").join(dd, ["graph_id", "dst"], "left")
    inv = lambda c: F.when(F.col(c) > 0, F.pow(F.col(c).cast("double"), -0.5)).otherwise(F.lit(0.0))
    return j.withColumn("w", inv("ds") * inv("dd")).drop("ds", "dd")


def gather(edges: DataFrame, nodes: DataFrame, feat: str = "x") -> DataFrame:
    """Source-node features onto each edge."""
    n = nodes.select("graph_id", F.col("node").alias("src"), F.col(feat).alias("x_src"))
    return edges.join(n, ["graph_id", "src"], "left")


#: Nodes of one graph up to which a collection is dealt by graph; a larger one is dealt by (graph, node) at each step.
LARGEST_GRAPH = 1_000_000


def propagate(nodes: DataFrame, edges: DataFrame, weights: list[list[list[float]]], feat: str = "x", relu: bool = True,
              largest: int = LARGEST_GRAPH) -> DataFrame:
    """``len(weights)`` hops over ``edges`` (graph_id, src, dst) and a loop at each node: x <- relu(A (x W)), A
    normalised by in-degrees on both sides: (graph_id, node, feat). Isolated nodes keep their own loop.

    Nodes and edges are one table, dealt by graph in one exchange. A node's value and degree reach its edges by
    windows over (graph, place), the sums are aggregates over (graph, node): both find their rows where the
    exchange put them, as a partitioning by graph is one of (graph, anything). Only where a graph has more
    than ``largest`` nodes do steps deal by (graph, node) instead, so that no task holds a whole graph."""
    from tessera.functions.arrays import matvec
    most = nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0   # one number
    whole = most <= largest
    none = F.lit(None).cast("array<double>")
    place = F.col("node").cast("long")
    n = nodes.select("graph_id", place.alias("_at"), F.lit(None).cast("long").alias("_to"), F.col(feat).cast("array<double>").alias(feat))
    e = edges.select("graph_id", F.col("src").cast("long").alias("_at"), F.col("dst").cast("long").alias("_to"), none.alias(feat))
    both = n.unionByName(e)
    if whole:
        parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.sparkSession.sparkContext.defaultParallelism)
        both = both.repartition(parts, "graph_id")
    # a node is its value and a loop, an edge itself; each edge knows the in-degree of where it leads
    links = both.select("graph_id", "_at", F.coalesce("_to", "_at").alias("_to"))
    links = links.withColumn("_d", F.count(F.lit(1)).over(Window.partitionBy("graph_id", "_to")))
    x = both.filter(F.col("_to").isNull()).select("graph_id", "_at", feat)
    at = Window.partitionBy("graph_id", "_at")
    for w in weights:
        h = x.select("graph_id", "_at", matvec(w, F.col(feat)).alias("_h"))
        u = h.withColumn("_to", F.lit(None).cast("long")).withColumn("_d", F.lit(None).cast("long")).unionByName(links.withColumn("_h", none))
        u = u.withColumn("_h", F.first("_h", ignorenulls=True).over(at)).withColumn("_ds", F.max(F.when(F.col("_to") == F.col("_at"), F.col("_d"))).over(at))
        u = u.filter(F.col("_to").isNotNull()).withColumn("_w", 1.0 / F.sqrt(F.col("_d") * F.col("_ds")))
        out = u.groupBy("graph_id", F.col("_to").alias("_at")).agg(*[F.sum(F.col("_w") * F.element_at("_h", i + 1)).alias(f"_s{i}") for i in range(len(w))])
        total = [F.greatest(F.col(f"_s{i}"), F.lit(0.0)) if relu else F.col(f"_s{i}") for i in range(len(w))]
        x = out.select("graph_id", "_at", F.array(*total).alias(feat))
    return x.select("graph_id", F.col("_at").cast(nodes.schema["node"].dataType).alias("node"), feat)


def mean_pool(nodes: DataFrame, feat: str, dim: int) -> DataFrame:
    """Mean of node vectors per graph."""
    g = nodes.groupBy("graph_id").agg(*[F.avg(F.element_at(feat, i + 1)).alias(f"_m{i}") for i in range(dim)])
    return g.select("graph_id", F.array(*[F.col(f"_m{i}") for i in range(dim)]).alias(feat))


def graph_stats(nodes: DataFrame, edges: DataFrame, graphs: DataFrame, feat: str = "x") -> DataFrame:
    """graphs, classes, feature width, mean nodes and mean edges per graph."""
    n = nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.max(F.size(feat)).alias("width"))
    e = edges.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n_edges"))
    j = graphs.join(n, "graph_id", "left").join(e, "graph_id", "left").fillna(0, ["n_nodes", "n_edges"])
    return j.agg(F.count(F.lit(1)).alias("n_graphs"), F.count_distinct("label").alias("n_classes"),
                 F.max("width").alias("n_features"), F.avg("n_nodes").alias("mean_nodes"),
                 F.avg("n_edges").alias("mean_edges"))
