"""Vector, attention and pooling operators.

Long form ``(id, d, x)`` keeps very wide vectors as rows so sums and maxima
per dimension are ordinary aggregates; short fixed vectors stay arrays and
use array functions inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship


def to_long(df: DataFrame, keys: list[str], arr: str, d: str = "d", x: str = "x") -> DataFrame:
    return df.select(*keys, F.posexplode(F.col(arr).cast("array<double>")).alias(d, x))


def zscore(df: DataFrame, group: list[str], value: str, out: str = "z") -> DataFrame:
    """H1: per-group z-score with the sample standard deviation (n-1);
    zero or undefined deviation gives null instead of inf/NaN."""
    stats = df.groupBy(*group).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    j = df.join(stats, group)
    return j.withColumn(out, F.try_divide(F.col(value) - F.col("_mu"), F.when(F.col("_sd") != 0, F.col("_sd")))) \
            .drop("_mu", "_sd")


def reshape_grid(df: DataFrame, point: str, channel: str, cols: int) -> DataFrame:
    """H2: (point, channel) -> channel-major (c, r, col) grid of width ``cols``."""
    return df.withColumn("c", F.col(channel)).withColumn("r", F.floor(F.col(point) / cols).cast("int")) \
             .withColumn("col", (F.col(point) % cols).cast("int"))


#: Queries that one stream of keys serves at a time, and what a masked score becomes (fixed value).
QUERY_BLOCK, MASKED = 512, -1e9


def _softmax_stream(rows, types, causal: bool):
    """Rows (group, block, kind, pos, vec, val) sorted so, queries (kind 0) of a block before all keys of its group
    (kind 1) -> (group, pos, out, p_sum). A block's queries keep the largest score so far, the sum of
    exp(score - largest) and the values weighted alike; each run of keys is scored against them and merged
    in, whatever the number of keys."""
    import numpy as np
    import pyarrow as pa
    at, queries, state = None, None, None

    def done():
        pos, q, (m, s, o, p) = queries[0], queries[1], state
        out = o / s[:, None]
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(pos), types[0].type), pa.array(pos, types[1].type),
                                           pa.array(list(out), pa.list_(pa.float64())), pa.array(p / s)], ["_g", "_p", "out", "p_sum"])

    def vectors(col):
        flat = col.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)

    for batch in rows:
        g, b, kind = (batch.column(c).to_pylist() for c in ("_g", "_b", "_kind"))
        cut = [i for i in range(1, len(g)) if (g[i], b[i], kind[i]) != (g[i - 1], b[i - 1], kind[i - 1])]
        for lo, hi in zip([0, *cut], [*cut, len(g)]):
            part = batch.slice(lo, hi - lo)
            pos, vec = part.column("_p").to_numpy(zero_copy_only=False), vectors(part.column("_v"))
            if at != (g[lo], b[lo]):
                if state is not None:
                    yield done()
                at, queries, state = (g[lo], b[lo]), None, None
            if kind[lo] == 0:
                queries = (pos, vec) if queries is None else (np.concatenate([queries[0], pos]), np.concatenate([queries[1], vec]))
                continue
            val = vectors(part.column("_w"))
            if state is None:
                n = len(queries[0])
                state = np.full(n, -np.inf), np.zeros(n), np.zeros((n, val.shape[1])), np.zeros(n)
            m, s, o, p = state
            score = queries[1] @ vec.T / np.sqrt(queries[1].shape[1])
            if causal:
                score = np.where(pos[None, :] > queries[0][:, None], MASKED, score)
            top = np.maximum(m, score.max(axis=1))
            old, e = np.exp(m - top), np.exp(score - top[:, None])
            state = top, s * old + e.sum(axis=1), o * old[:, None] + e @ val, p * old + e.sum(axis=1)
    if state is not None:
        yield done()


def attention(q: DataFrame, k: DataFrame, v: DataFrame, group: str, pos: str, vec: str, causal: bool = False, block: int = QUERY_BLOCK) -> DataFrame:
    """H5 (+C28): scaled dot-product attention inside each group: scores q.k / sqrt(M), optional causal mask
    (key position > query position gets -1e9), softmax over keys, weighted sum of values: (group, pos, out, p_sum).

    A streaming softmax: queries of a group are taken in blocks of ``block``; the keys and values of the group
    pass by each block once, in order, and only the block's running state is held. No row or table of
    queries x keys is made; blocks of one long group are spread over tasks. Keys that a causal mask hides
    from a whole block are not sent to it. Vectors may have any length; ``group`` may be a struct."""
    b = F.floor(F.col(pos) / block).cast("long")
    qq = q.select(F.col(group).alias("_g"), b.alias("_b"), F.lit(0).alias("_kind"), F.col(pos).cast("long").alias("_p"), F.col(vec).cast("array<double>").alias("_v"))
    none = F.lit(None).cast("array<double>")
    kk = k.select(F.col(group).alias("_g"), F.col(pos).cast("long").alias("_p"), F.col(vec).cast("array<double>").alias("_v"))
    vv = v.select(F.col(group).alias("_g"), F.col(pos).cast("long").alias("_p"), F.col(vec).cast("array<double>").alias("_w"))
    kv = kk.join(vv, ["_g", "_p"])
    blocks = qq.select("_g", "_b").distinct()
    kv = kv.join(blocks, "_g")
    if causal:
        kv = kv.filter(F.col("_p") < (F.col("_b") + 1) * block)
    rows = qq.withColumn("_w", none).unionByName(kv.withColumn("_kind", F.lit(1)))
    rows = rows.repartition("_g", "_b").sortWithinPartitions("_g", "_b", "_kind", "_p")
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    gt, pt = q.schema[group].dataType, q.schema[pos].dataType
    types = [pa.field("_g", to_arrow_type(gt)), pa.field("_p", pa.int64())]
    out = ship(rows).select("_g", "_b", "_kind", "_p", "_v", "_w").mapInArrow(
        lambda it: _softmax_stream(it, types, causal), f"_g {gt.simpleString()}, _p long, out array<double>, p_sum double")
    return out.select(F.col("_g").alias(group), F.col("_p").cast(pt).alias(pos), "out", "p_sum")


def project(arr, weights: list[list[float]]):
    """H4 for wide vectors: W x with W as one literal (rows of W), applied by array functions."""
    from tessera.functions.arrays import dot
    return F.transform(F.lit(weights), lambda row: dot(row, arr))


def multi_head(seq: DataFrame, group: str, pos: str, vec: str, heads: list[tuple], out: list[list[float]], causal: bool = False) -> DataFrame:
    """H6: ``heads`` is a list of weight matrices (query, key, value); each head is attention over its projections,
    the heads' outputs are concatenated and projected by ``out``: (group, pos, y). All heads go
    through one pass of ``attention``, the head being part of the group."""
    def side(i):
        per = F.array(*[F.struct(F.lit(h).alias("h"), project(F.col(vec), w[i]).alias("x")) for h, w in enumerate(heads)])
        d = seq.select(F.col(group).alias("_grp"), F.col(pos).alias("_pos"), F.explode(per).alias("z"))
        return d.select(F.struct(F.col("_grp").alias("g"), F.col("z.h").alias("h")).alias("_gh"), "_pos", F.col("z.x").alias("x"))
    a = attention(side(0), side(1), side(2), "_gh", "_pos", "x", causal)
    a = a.groupBy(F.col("_gh.g").alias(group), F.col("_pos").alias(pos)).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(F.col("_gh.h").alias("h"), "out"))), lambda z: z["out"])).alias("_o"))
    return a.select(group, pos, project(F.col("_o"), out).alias("y"))


def linear(arr, weights: list[list[float]], bias: list[float] | None = None, relu: bool = False):
    """H4: W x + b (optionally ReLU) with a small literal weight matrix."""
    from tessera.functions.arrays import matvec
    y = matvec(weights, arr, bias)
    return F.transform(y, lambda t: F.greatest(t, F.lit(0.0))) if relu else y


def pool(df: DataFrame, group: list[str], arr: str) -> DataFrame:
    """Element-wise max and mean of the vectors of each group, of any length, one row a dimension:
    (group, d, max, mean)."""
    x = df.select(*group, F.posexplode(F.col(arr).cast("array<double>")).alias("d", "_x"))
    return x.groupBy(*group, "d").agg(F.max("_x").alias("max"), F.avg("_x").alias("mean"))


def pick_token(vectors: DataFrame, ids: DataFrame, keys: list[str], id_col: str, token: int) -> DataFrame:
    """The vectors at all places whose token id is ``token`` (such as the first mark of a sequence):
    ``vectors`` (keys, vec) and ``ids`` (keys, id_col) share the place as ``keys``."""
    return vectors.join(ids.filter(F.col(id_col) == token).select(*keys), keys)


def embed(ids: DataFrame, table: DataFrame, id_col: str, pos_col: str | None = None,
          pos_table: DataFrame | None = None) -> DataFrame:
    """Lookup-table embedding (id -> vector), plus a position vector.
    The tables are model-sized (vocabulary x dim); the optimizer broadcasts them while they are small."""
    j = ids.join(table.withColumnRenamed("vec", "_e"), id_col, "left")
    if pos_table is not None:
        j = j.join(pos_table.withColumnRenamed("vec", "_p"), pos_col, "left")
        j = j.withColumn("_e", F.zip_with("_e", "_p", lambda a, b: a + b)).drop("_p")
    return j.withColumnRenamed("_e", "vec")
