"""Operator 7 - approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more dimension that makes them unit vectors, so
that the largest inner product is the smallest distance. A table hashes a vector by several Gaussian
projections, each cut into intervals of one width (2-stable hashing). A query visits its own bucket
and those next to it in the order of estimated success: the sum of squared distances to the borders
that must be crossed. What the tables find is merged and ranked by exact inner products.

The buckets that the queries are in themselves come first: the score of the k-th best found there is
the least that any other bucket has to offer, so what all buckets report stays in proportion to the
queries. Buckets are dealt to cells of bounded size (blocks of their vectors by blocks of the queries that
visit them), so neither a common vector nor a common query fills a task. Queries that found fewer than
asked for are compared with every bucket of one table, block by block.

Defined results: vectors that are null, zero or hold a null or non-finite component take no part,
nor do those of another length than most and rows without an id; a query's own row is every row
with its id; equal scores rank by the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, materialize, rows_per_split

#: Vectors and queries in a cell, rows of cells in a task.
BLOCK, QUERY_BLOCK, TASK_ROWS = 4096, 2048, 20_000


@dataclass(frozen=True)
class Hashing:
    """``tables`` times ``functions`` projections of width ``width``; ``probes`` buckets of each table."""

    tables: int = 6
    functions: int = 8
    width: float = 2.5
    probes: int = 60
    seed: int = 7

    def projections(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return (rng.standard_normal((self.tables, dims + 1, self.functions)),
                rng.uniform(0, self.width, (self.tables, 1, self.functions)))

    def positions(self, unit: np.ndarray) -> np.ndarray:
        """(tables, n, functions): place of each vector on each projection, in intervals."""
        a, b = self.projections(unit.shape[1] - 1)
        return (unit @ a + b) / self.width


def bucket_keys(table: int, intervals: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row of interval numbers."""
    key = np.full(intervals.shape[:-1], table + 1, dtype=np.uint64)
    for j in range(intervals.shape[-1]):
        key = (key ^ (intervals[..., j].astype(np.int64).view(np.uint64) + np.uint64(j + 1))) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def probe_order(place: np.ndarray, probes: int) -> np.ndarray:
    """Interval numbers of the ``probes`` most promising buckets for one query, best first."""
    own = np.floor(place)
    inside = place - own
    steps, cost = np.zeros((1, 0), dtype=np.int64), np.zeros(1)
    for x in inside:
        more = np.concatenate([cost, cost + x * x, cost + (1 - x) ** 2])
        pick = np.argsort(more, kind="stable")[:probes]
        moved = np.repeat([0, -1, 1], len(cost))[pick]
        steps = np.hstack([steps[pick % len(cost)], moved[:, None]])
        cost = more[pick]
    return own.astype(np.int64) + steps


def _unit(v: np.ndarray, largest: float) -> np.ndarray:
    v = v / largest
    return np.hstack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1, keepdims=True)))])


def usable(vectors: DataFrame) -> tuple[DataFrame, int, float]:
    """(vec_id, v: doubles as bytes) of the vectors that take part, their length and largest norm."""
    rows = columns(vectors, vec_id="long", embedding="array<double>").filter("vec_id is not null and size(embedding) > 0")
    rows = rows.withColumn("square", F.expr("aggregate(embedding, 0D, (s, x) -> s + x * x)"))
    rows = rows.filter("square > 0 and square < double('infinity')").withColumn("dims", F.size("embedding"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.max("square").alias("square")).orderBy(F.desc("n"), "dims").first()
    if sizes is None:
        return rows.select("vec_id", "embedding"), 0, 1.0
    return rows.filter(F.col("dims") == sizes["dims"]).select("vec_id", "embedding"), sizes["dims"], float(np.sqrt(sizes["square"]))


def _index(rows: DataFrame, hashing: Hashing, largest: float) -> DataFrame:
    """(bucket, vec_id, v): every vector in its bucket of each table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = np.array(batch["embedding"].tolist(), dtype=np.float64)
                raw = [x.tobytes() for x in v]
                place = np.floor(hashing.positions(_unit(v, largest)))
                for t in range(hashing.tables):
                    yield pd.DataFrame({"tab": t, "bucket": bucket_keys(t, place[t]), "vec_id": batch["vec_id"].to_numpy(), "v": raw})

    return rows.mapInPandas(run, "tab int, bucket long, vec_id long, v binary")


def _probes(rows: DataFrame, hashing: Hashing) -> DataFrame:
    """(bucket, query_id, v, own): every bucket that each query visits, first (own) the one it is in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                v = np.array(part["embedding"].tolist(), dtype=np.float64)
                # Only a query's direction counts: scaled to a unit vector it has no further dimension.
                place = hashing.positions(_unit(v / np.sqrt((v * v).sum(axis=1, keepdims=True)), 1.0))
                for t in range(hashing.tables):
                    keys = [bucket_keys(t, probe_order(p, hashing.probes)) for p in place[t]]
                    often = [len(k) for k in keys]
                    yield pd.DataFrame({"bucket": np.concatenate(keys), "query_id": np.repeat(part["vec_id"].to_numpy(), often),
                                        "v": np.repeat(np.array([x.tobytes() for x in v], dtype=object), often), "own": np.concatenate([np.arange(n) == 0 for n in often])})

    return rows.mapInPandas(run, "bucket long, query_id long, v binary, own boolean")


def best(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best ids and scores; ``rough`` scores pick them, and sums in one order for all rows rank
    them, so that equal vectors have equal scores."""
    if len(rough) > k:
        least = np.partition(rough, -k)[-k]
        keep = np.flatnonzero(rough >= least - 1e-9 * max(1.0, abs(least)))
        ids, vectors = ids[keep], vectors[keep]
    exact = (vectors * query).sum(axis=1)
    order = np.lexsort((ids, -exact))[:k]
    return ids[order], exact[order]


def _compared(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): in each task, the k best of at least score ``least`` for each of its
    queries (bucket, query_id, v, least)."""
    spark = index.sparkSession
    sizes = index.groupBy("bucket").agg(F.expr(f"cast((count(*) + {BLOCK - 1}) div {BLOCK} as int)").alias("blocks"))
    asked = probes.groupBy("bucket").agg(F.expr(f"cast((count(*) + {QUERY_BLOCK - 1}) div {QUERY_BLOCK} as int)").alias("qblocks"))
    sizes = materialize(sizes.join(asked, "bucket"), "near-cells")
    left = index.join(sizes, "bucket").select("bucket", "vec_id", "v", F.expr("pmod(xxhash64(vec_id, v), blocks)").alias("block"), F.explode(F.expr("sequence(0, qblocks - 1)")).alias("qblock"))
    right = probes.join(sizes, "bucket").select("bucket", "query_id", "v", "least", F.expr("pmod(xxhash64(query_id), qblocks)").alias("qblock"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    tasks = rows_per_split(spark, index.count() + probes.count(), TASK_ROWS)
    cell = F.xxhash64("bucket", F.col("block").cast("long"), F.col("qblock").cast("long")).alias("cell")
    left = left.select(cell, "vec_id", "v").withColumn("task", F.pmod("cell", F.lit(tasks)))
    right = right.select(cell, "query_id", "v", "least").withColumn("task", F.pmod("cell", F.lit(tasks)))

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if vectors.empty or queries.empty:
            return empty
        width = len(vectors["v"].iloc[0])
        v = np.frombuffer(b"".join(vectors["v"]), np.float64).reshape(-1, width // 8)
        q = np.frombuffer(b"".join(queries["v"]), np.float64).reshape(-1, width // 8)
        ids, qids, least = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy(), queries["least"].to_numpy() - 1e-9
        of = queries.groupby("cell").indices
        found: dict[int, list] = {}
        for cell_, here in vectors.groupby("cell").indices.items():
            if cell_ not in of:
                continue
            own, own_ids, asking = v[here], ids[here], of[cell_]
            rough = q[asking] @ own.T
            for i, r in zip(asking, rough, strict=True):
                good = np.flatnonzero((r >= least[i]) & (own_ids != qids[i]))
                if len(good):
                    found.setdefault(qids[i], []).append(best(q[i], own[good], own_ids[good], r[good], k))
        out = []
        for query_id, parts in found.items():
            a, s = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            a, first = np.unique(a, return_index=True)
            s = s[first]
            top = np.lexsort((a, -s))[:k]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": a[top], "score": s[top]}))
        return pd.concat(out, ignore_index=True) if out else empty

    return left.groupBy("task").cogroup(right.groupBy("task")).applyInPandas(run, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # A vector that several tables found has one score.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, every: int, k: int, hashing: Hashing | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each vector whose id ``every`` divides."""
    hashing = hashing or Hashing()
    rows, dims, largest = usable(vectors)
    if not dims:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).filter("false")
    index = materialize(_index(rows, hashing, largest), "near-index")
    queries = rows.filter(F.col("vec_id") % every == 0)
    probes = materialize(_probes(queries, hashing), "near-probes")
    nothing = F.lit(float("-inf"))
    first = materialize(_ranked(_compared(index, probes.filter("own").withColumn("least", nothing), k), k), "near-first")
    least = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    others = probes.filter("not own").join(least, "query_id", "left").withColumn("least", F.coalesce("bound", nothing))
    more = _compared(index, others, k).unionByName(first.drop("rank"))
    found = materialize(_ranked(more, k), "near-found")
    ids = index.filter("tab = 0").select("vec_id").distinct().count()
    full = found.groupBy("query_id").count().filter(F.col("count") >= min(k, ids - 1)).select(F.col("query_id").alias("vec_id"))
    short = materialize(queries.join(full, "vec_id", "left_anti"), "near-short")
    if ids < 2 or short.isEmpty():
        return found
    # The few that found too little meet all vectors, by the buckets of the first table.
    one = index.filter("tab = 0")
    raw = one.join(short.select("vec_id").distinct(), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "v", nothing.alias("least"))
    tasks = rows_per_split(index.sparkSession, ids, BLOCK)
    one = one.withColumn("bucket", F.expr(f"pmod(xxhash64(vec_id), {tasks})"))
    raw = raw.withColumn("bucket", F.explode(F.expr(f"sequence(0L, {tasks - 1}L)")))
    more = _ranked(_compared(one, raw, k), k)
    return found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(more)
