"""Operator 10 - sharding by Karmarkar-Karp differencing.

Indivisible groups (equal texts) are dealt to shards of near-equal bytes. Differencing keeps a
heap of partial partitions (a sum for each shard), takes the two with the largest spread and adds
them in opposite order until one is left. It runs as a tree of Spark groups: random blocks of at
most ``BLOCK`` groups are each differenced into ``BUNDLES`` bundles, the bundles are the indivisible
items of the next level, and once at most ``BLOCK`` items are left they are differenced into the
shards. Items larger than a bundle stay alone in theirs, so a later level can still level them out.

Defined results: a null text counts as an empty one for grouping and its crc32, but has no bytes
(both have size 1); repeated rows are separate rows of one group; a null doc_id is carried;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, empty_text, materialize, rows_per_split

#: Items differenced in one task, and the bundles that a block below the last level gives.
BLOCK, BUNDLES = 2048, 64
#: Rows numbered in one window partition.
SLOT_ROWS = 20_000


def difference(sizes: np.ndarray, ways: int) -> np.ndarray:
    """Karmarkar-Karp differencing: the part (0 to ways-1) of each item."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    # A node is a partial partition: sums in descending order, and which part of each child went where.
    sums = [np.zeros(ways, dtype=np.int64) for _ in range(n)]
    for i, s in enumerate(sizes):
        sums[i][0] = s
    made: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(sizes[i]), int(i)) for i in order]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        rank = np.argsort(-both, kind="stable")
        sums.append(both[rank])
        made.append((a, b, rank))
        sums[a] = sums[b] = None
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    where: list = [None] * len(sums)
    where[-1] = np.arange(ways)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, rank = made[node - n]
        at = np.empty(ways, dtype=np.int64)
        at[rank] = where[node]
        where[a], where[b], where[node] = at, at[::-1], None
    return np.array([w[0] for w in where[:n]], dtype=np.int64)


def _deal(items: DataFrame, block: str, ways: int) -> DataFrame:
    """Rows (item, bytes) with a column ``part``: the bundle in the block, or the shard."""

    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "item"], ascending=[False, True], kind="stable")
        return pd.DataFrame({"item": pdf["item"], "bytes": pdf["bytes"], "part": pdf["block"] * ways + difference(pdf["bytes"].to_numpy(), ways)})

    kind = items.schema["item"].dataType.simpleString()
    return items.withColumn("block", F.expr(block)).groupBy("block").applyInPandas(parts, f"item {kind}, bytes long, part long")


def shard_groups(groups: DataFrame, shards: int, block: int = BLOCK, bundles: int = BUNDLES) -> DataFrame:
    """``groups`` (item, bytes), one row for each indivisible item -> (item, shard)."""
    left = materialize(groups, "shard-groups")
    levels, n = [], left.count()
    while n > block:
        dealt = materialize(_deal(left, f"pmod(xxhash64(item), {rows_per_split(left.sparkSession, n, block // 2)})", bundles), "shard-level")
        levels.append(dealt.select("item", "part"))
        left = materialize(dealt.groupBy(F.col("part").alias("item")).agg(F.sum("bytes").alias("bytes")), "shard-bundles")
        fewer = left.count()
        if fewer >= n:
            raise ValueError(f"{bundles} bundles do not reduce blocks of {block} items")
        n = fewer
    found = _deal(left, "0L", shards).select("item", F.col("part").cast("int").alias("shard"))
    for level in reversed(levels):
        found = level.join(found.withColumnRenamed("item", "part"), "part").select("item", "shard")
    return found


def number_within(rows: DataFrame, key: str, order: str, name: str, splits: int) -> DataFrame:
    """A gapless number from 0 within each ``key``, by random splits: a split is numbered by itself
    and starts after the counts of the splits before it, so no key is sorted in one task."""
    rows = rows.withColumn("_split", F.expr(f"pmod(xxhash64({order}), {splits})").cast("int"))
    starts = rows.groupBy(key, "_split").count()
    before = F.sum("count").over(Window.partitionBy(key).orderBy("_split")) - F.col("count")
    starts = starts.select(F.col(key).alias("_key"), F.col("_split").alias("_at"), before.alias("_before"))
    own = F.row_number().over(Window.partitionBy(key, "_split").orderBy(order)) - 1
    return (rows.withColumn("_own", own)
            .join(starts, (F.col(key) == F.col("_key")) & (F.col("_split") == F.col("_at")))
            .withColumn(name, F.col("_own") + F.col("_before"))
            .drop("_split", "_key", "_at", "_own", "_before"))


def shard(docs: DataFrame, shards: int = 16, block: int = BLOCK, bundles: int = BUNDLES) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for every row of ``docs`` (doc_id, text)."""
    rows = columns(docs, doc_id="long", text="string").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(empty_text()).alias("text_crc32"), F.unhex(F.sha2(empty_text(), 256)).alias("digest"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    n = rows.count()
    groups = rows.groupBy(F.col("digest").alias("item")).agg(F.sum("size").alias("bytes"))
    found = shard_groups(groups, shards, block, bundles)
    rows = materialize(rows.join(found.withColumnRenamed("item", "digest"), "digest"), "shard-found")
    return number_within(rows, "shard", "row", "slot", rows_per_split(rows.sparkSession, n, shards * SLOT_ROWS)).drop("row")
