"""Operator 11 - runs: stretches of words that repeat with a period, by suffix trees.

Words of a whole text are numbered. Ukkonen's algorithm builds the suffix tree of a stretch of words and that of its
reversal; a tour of each tree lists its leaves with the depth of the branching between neighbours, over which a
sparse table gives the depth of the lowest common ancestor of any two leaves in constant time: the longest common
extension to the right (tree) or to the left (tree of the reversal). Leaf order gives, for either order of the
alphabet, the longest Lyndon word at each place; every run has such a word as a root, so extending each candidate
both ways finds all runs.

Trees are built only where a run can be. In a run of period q, with m <= q < 2m, every window of m words beyond the
first q words has an equal one at most q words before. Documents are searched, for m = 1, 2, 4, ..., for stretches in which
every window has an equal one less than 2m words before, long enough for ``REPEATS`` periods; such a stretch with what
its run can hold on either side goes to the trees. Windows are compared by hashes, whose errors could only add
stretches. A run lies in one stretch as a whole, so runs are those of the whole text.

A stretch takes a few hundred bytes a word in its task; a document is one row and is never cut.

Defined results: null, empty and blank texts have no words and no runs, their collapsed text is empty; each repeated
row is handled alike; a null doc_id is left null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns
from tessera.llm.words import joined, parts, word_hashes

#: A run has at least LEAST words and REPEATS periods.
LEAST, REPEATS = 6, 4


def suffix_tree(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: children by ``node * width + symbol``, where the
    label of the edge into each node begins and ends (None: at the end of ``s``), and the width."""
    width = max(s) + 1
    child: dict[int, int] = {}
    begin, end, link = [0], [0], [0]
    node = at = length = waiting = 0
    for i, symbol in enumerate(s):
        fresh = 0
        waiting += 1
        while waiting:
            if not length:
                at = i
            key = node * width + s[at]
            below = child.get(key)
            if below is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(None)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                first = begin[below]
                label = (i + 1 if end[below] is None else end[below]) - first
                if length >= label:
                    at += label
                    length -= label
                    node = below
                    continue
                if s[first + length] == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(begin)
                child[key] = inner
                child[inner * width + s[first + length]] = below
                child[inner * width + symbol] = inner + 1
                begin += (first, i)
                end += (first + length, None)
                link += (0, 0)
                begin[below] = first + length
                if fresh:
                    link[fresh] = inner
                fresh = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - waiting + 1
    return child, begin, end, width


class Extensions:
    """Longest common extensions to the right of any two places of ``symbols`` (from 1 on)."""

    def __init__(self, symbols: np.ndarray):
        s = [*symbols.tolist(), 0]
        n = len(s)
        child, begin, end, width = suffix_tree(s)
        below: list[list[int]] = [[] for _ in begin]
        for key in sorted(child):
            below[key // width].append(child[key])
        # The tour: leaves in order of their suffixes, and the depth of the node where each parts from the one before.
        order, depths = [], []
        parting, todo = 0, [(0, 0, 0)]
        while todo:
            node, depth, above = todo.pop()
            if above >= 0:
                parting = above
            if end[node] is None:
                order.append(begin[node] - depth)
                depths.append(parting)
                continue
            if node:
                depth += end[node] - begin[node]
            kids = below[node]
            todo += [(k, depth, depth) for k in kids[:0:-1]]
            todo.append((kids[0], depth, -1))
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = np.arange(n)
        level = np.array(depths, dtype=np.int32)
        self.least = [level]
        step = 1
        while 2 * step <= n:
            level = np.minimum(level[:-step], level[step:])
            self.least.append(level)
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of places i and j, i != j."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            on, least = level == k, self.least[k]
            out[on] = np.minimum(least[lo[on]], least[hi[on] - (1 << int(k))])
        return out


def _next(ranks: list[int], sign: int) -> np.ndarray:
    """For each place the next one whose rank is smaller (sign 1) or larger (sign -1); itself if there is none."""
    out, open_ = list(range(len(ranks))), []
    for i, r in enumerate(ranks):
        r *= sign
        while open_ and open_[-1][0] > r:
            out[open_.pop()[1]] = i
        open_.append((r, i))
    return np.array(out, dtype=np.int64)


def runs_of(ids: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of all runs of ``ids``, at least ``least`` long and ``repeats`` (two or more) periods, by start, then period."""
    n = len(ids)
    symbols = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    right, left = Extensions(symbols), Extensions(symbols[::-1])
    ranks = right.rank.tolist()
    i = np.concatenate([np.arange(n + 1)] * 2)
    j = np.concatenate([_next(ranks, 1), _next(ranks, -1)])
    i, j = i[i < j], j[i < j]
    ahead = right(i, j)
    behind = np.zeros(len(i), dtype=np.int64)
    on = i > 0  # the word before place x is place n - x of the reversal
    behind[on] = left(n - i[on], n - j[on])
    start, period = i - behind, j - i
    length = j + ahead - start
    good = (length >= least) & (length >= repeats * period)
    found = np.stack([start[good], length[good], period[good]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(ids: np.ndarray, begins: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """(first, beyond) of disjoint stretches, none over two documents, outside which no run can lie."""
    n = len(ids)
    h, where = word_hashes(ids, begins), np.arange(n)
    until = np.repeat(begins[1:], np.diff(begins))
    found, m = [np.zeros((0, 2), dtype=np.int64)], 1
    while len(where):
        order = np.lexsort((where, h)) if m > 1 else np.argsort(h, kind="stable")
        hs, ws = h[order], where[order]
        same = hs[1:] == hs[:-1]
        # Windows with an equal one shortly before, in stretches without a break.
        near = np.sort(ws[1:][same & (np.diff(ws) < 2 * m)])
        cut = np.flatnonzero(np.diff(near) > 1)
        first, last = np.concatenate([near[:1], near[cut + 1]]), np.concatenate([near[cut], near[-1:]])
        # A run of period q and length l has l - q - m + 1 such windows, and before the first at most q words.
        periods = range(m, min(2 * m, max(m + 1, least // repeats + 2)))
        fewest = min(max(repeats * q, least) - q for q in periods) - m + 1
        long = last - first + 1 >= fewest
        first, last = first[long], last[long]
        own = begins[np.searchsorted(begins, first, "right") - 1]
        found.append(np.stack([np.maximum(first - 2 * m + 1, own), last + m], axis=1))
        # Of windows twice as long only those count whose halves recur.
        recur = np.zeros(len(hs), dtype=bool)
        recur[1:] |= same
        recur[:-1] |= same
        alive = np.zeros(n, dtype=bool)
        alive[ws[recur]] = True
        full = np.empty(n, dtype=np.uint64)
        full[ws] = hs
        where = np.flatnonzero(alive)
        where = where[where + 2 * m <= until[where]]
        where = where[alive[where + m]]
        h = joined(full[where], full[where + m])
        m *= 2
    found = np.concatenate(found)
    if not len(found):
        return found
    found = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(found[:, 1])
    new = np.flatnonzero(np.concatenate([[True], found[1:, 0] >= reach[:-1]]))
    return np.stack([found[new, 0], reach[np.concatenate([new[1:] - 1, [len(found) - 1]])]], axis=1)


def document_runs(ids: np.ndarray, begins: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each document of a part, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in begins[1:]]
    for first, beyond in stretches(ids, begins, least, repeats).tolist():
        doc = int(np.searchsorted(begins, first, "right")) - 1
        start = first - int(begins[doc])
        out[doc] += [(start + s, l, p) for s, l, p in runs_of(ids[first:beyond], least, repeats).tolist()]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words), dtype=bool)
        for start, length, period in runs:
            gone[start + period:start + length] = True
        words = [words[i] for i in np.flatnonzero(~gone)]
    return b" ".join(words)


RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, least: int = LEAST,
                  repeats: int = REPEATS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text): its runs by start, then period, and the text
    with each run cut to its first period. ``change`` is applied to the words of a document beforehand."""

    def words(batch: pa.RecordBatch) -> Iterator[tuple[int | None, list[bytes]]]:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            own = (text.as_py() or b"").split()
            yield key, change(key, own) if change else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, ids, begins in parts(words(batch)):
                found = document_runs(ids, begins, least, repeats)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _ in held], pa.int64()), pa.array(np.diff(begins)),
                    pa.array([[{"start": s, "length": l, "period": p} for s, l, p in r] for r in found], pa.list_(_RUN)),
                    pa.array([collapse(w, r) for (_, w), r in zip(held, found)], pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = columns(docs, doc_id="long", text="string").withColumn("text", F.col("text").cast("binary"))
    found = rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """Of sorted runs the first with the greatest length / period, compared exactly."""
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, r: F.when(more(best, r), r).otherwise(best))
