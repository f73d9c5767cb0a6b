"""Ordering, ranking, splitting, sampling and batching (G1-G9) plus the
scalable global rank / cumulative sum they rest on.

A window without PARTITION BY runs in one task. Instead, rows are dealt by
range of the order (Spark's own sampler sets the bounds, the session the
number of partitions) and sorted within partitions; a row's position in its
partition, plus the count of rows in earlier partitions (a table of one row a
partition, hence the broadcast), is its global rank. The input is read once
for the bounds and once for the rows; the sorted rows are written to the
shared folder, so counts and positions come from the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def md5_order(seed: str, key: Column) -> Column:
    """Deterministic pseudo-random order key: md5(seed || key) (DuckDB gives
    the same hex string)."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def _ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in range partitions of ``order``, with ``_part`` (the partition) and
    ``_at`` (the position in it, from 0)."""
    d = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The low 33 bits of the id count the rows of a partition.
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut_lineage(d.withColumns({"_part": F.spark_partition_id(), "_at": at}), name, "zstd")


def _before(per_part: DataFrame, sums: dict[str, str], totals: dict[str, str]) -> DataFrame:
    """Per partition (one row each): sums over earlier partitions, and totals."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_part.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n) for n, c in sums.items()],
                           *[F.sum(c).over(every).alias(n) for n, c in totals.items()])


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                count_col: str | None = None) -> DataFrame:
    """0-based rank by ``order`` (a total order on the rows); ``count_col``, if
    named, holds the number of all rows."""
    d = _ranged(df, order, "rank")
    parts = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offs = _before(parts, {"_off": "_n"}, {count_col: "_n"} if count_col else {})
    # one row per partition: a bounded, broadcastable table
    return d.join(F.broadcast(offs), "_part").withColumn(rank_col, F.col("_off") + F.col("_at")).drop("_part", "_at", "_off")


def global_cumsum(df: DataFrame, order_col: str, value_cols: list[str], prefix: str = "cum_",
                  total_prefix: str = "total_") -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_col`` order (unique,
    e.g. distinct scores), and their totals."""
    d = _ranged(df, [F.col(order_col)], "cumsum")
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    parts = d.groupBy("_part").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    offs = _before(parts, {f"_o_{v}": f"_t_{v}" for v in value_cols}, {f"{total_prefix}{v}": f"_t_{v}" for v in value_cols})
    d = d.withColumns({f"_l_{v}": F.sum(v).over(w) for v in value_cols}).join(F.broadcast(offs), "_part")
    d = d.withColumns({f"{prefix}{v}": F.col(f"_o_{v}") + F.col(f"_l_{v}") for v in value_cols})
    return d.drop("_part", "_at", *[f"_l_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])


# ---- G1: group split -----------------------------------------------------------------------

def group_split(df: DataFrame, key: str, fracs: list[float], seed: str, names=None) -> DataFrame:
    """G1: split by groups (subjects): distinct keys ranked by md5(seed||key),
    cut by fraction of *groups*; no group in two splits. Adds ``split``."""
    names = names or ["train", "val", "test"][:len(fracs)]
    g = df.select(key).distinct().withColumn("_h", md5_order(seed, F.col(key)))
    g = global_rank(g, [F.col("_h"), F.col(key)], "_r", "n")
    cuts, acc = [], 0.0
    for f in fracs[:-1]:
        acc += f
        cuts.append(acc)
    split = None
    for i, c in enumerate(cuts):
        cond = F.col("_r") < F.floor(F.col("n") * c)
        split = F.when(cond, names[i]) if split is None else split.when(cond, names[i])
    split = (split.otherwise(names[-1]) if split is not None else F.lit(names[0]))
    g = g.select(key, split.alias("split"))
    return df.join(g, key)


def exact_split(df: DataFrame, id_col: str, sizes_frac: list[float], seed: str, names=None) -> DataFrame:
    """Random split with sizes int(f1*n), int(f2*n), rest; order by
    md5(seed||id). Adds ``split``."""
    names = names or ["train", "val", "test"][:len(sizes_frac)]
    d = df.withColumn("_h", md5_order(seed, F.col(id_col)))
    d = global_rank(d, [F.col("_h"), F.col(id_col)], "_r", "_n")
    split, acc = None, F.lit(0)
    for i, f in enumerate(sizes_frac[:-1]):
        acc = acc + F.floor(F.col("_n") * f)
        cond = F.col("_r") < acc
        split = F.when(cond, names[i]) if split is None else split.when(cond, names[i])
    split = split.otherwise(names[-1]) if split is not None else F.lit(names[0])
    return d.withColumn("split", split).drop("_h", "_r", "_n")


def shuffle(df: DataFrame, id_col: str, seed: str, pos_col: str = "pos") -> DataFrame:
    """Deterministic shuffle: ``pos_col`` is the place of each row in the
    order of md5(seed||id)."""
    d = df.withColumn("_h", md5_order(seed, F.col(id_col)))
    return global_rank(d, [F.col("_h"), F.col(id_col)], pos_col).drop("_h")


def to_batches(df: DataFrame, order: list[Column], size: int, drop_last: bool = False) -> DataFrame:
    """batch = floor(rank / size); optionally drop the last partial batch."""
    d = global_rank(df, order, "_r", "_n")
    d = d.withColumn("batch", F.floor(F.col("_r") / size).cast("long")).withColumn(
        "pos_in_batch", (F.col("_r") % size).cast("int"))
    if drop_last:
        d = d.filter(F.col("batch") < F.floor(F.col("_n") / size))
    return d.drop("_r", "_n")


def linspace_subset(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Rows at positions trunc(linspace(0, n-1, k)) (duplicates collapse)."""
    d = global_rank(df, order, "_r", "_n")
    # Position i of k is trunc(i (n-1) / (k-1)); only the i next to r (k-1) / (n-1) can give rank r.
    i = F.floor(F.col("_r") * F.lit(max(k - 1, 1)) / F.greatest(F.col("_n") - 1, F.lit(1)))
    hit = F.lit(False)
    for j in (i - 1, i, i + 1):
        hit = hit | (j.between(0, k - 1) & (F.floor(j * (F.col("_n") - 1) / F.lit(max(k - 1, 1))) == F.col("_r")))
    return d.filter(hit).drop("_r", "_n")


def take_first(df: DataFrame, order: list[Column], num: int) -> DataFrame:
    """First ``num`` rows in order (a top-k; the limit is the feature)."""
    if num <= 0:
        raise ValueError("num must be positive")
    return df.orderBy(*order).limit(num)


def sample_per_class(df: DataFrame, cls: str, id_col: str, k: int, seed: str) -> DataFrame:
    """At most k rows per class by md5 order."""
    w = Window.partitionBy(cls).orderBy(md5_order(seed, F.col(id_col)), F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
