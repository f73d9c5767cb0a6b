"""Operator 6 - near-duplicates by a multi-index Hamming join of MinHash signatures.

A document is its set of distinct 5-word shingles (64-bit hashes); equal sets form one class. A class
has a signature of ``CHUNKS * CHUNK`` MinHash values of 16 bits. The signature is split into chunks and
each chunk is entered once for each value that may differ (the other values as the key), so by
pigeonhole all pairs with fewer than ``2 * CHUNKS`` differing values share a bucket: of a chunk's values
at most one differs. At similarity 0.75 a chunk qualifies with probability 0.63, all 12 fail for
one pair in 160,000.

Buckets are not expanded into pairs. In a round of stars every member is paired with one member of its bucket
(another one in each bucket); the partner met most often, the smallest and the largest are confirmed on full sets,
and components are taken. While hot buckets still hold several components, further rounds pair members with one of another
component. Then whatever pairs of *different* components still share a bucket are compared: bucket members in
blocks, inside tasks, by signature (pairs within ``FAR`` differing values) and then by their sets. Of sets up to ``FULL``
shingles a task has all hashes (32 bits of each: an error could only make a pair look more alike) and reports one link for
two components, not all; of larger sets it has a sketch (the least hash of each of ``BINS`` ranges) and reports
every pair with enough alike bins (5 sigma beyond the expected number at 0.75). What is reported is confirmed on full
sets too. Links inside a component cannot change it.

Defined results: null and empty texts have no shingles and are linked with nothing; repeated rows and
equal texts are one class; in a component whose doc_ids are all null, component_id is null and one row
is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, empty_text, few, materialize, rows_per_split
from tessera.llm.components import components

WORDS, PERCENT = 5, 75
#: Chunks of a signature, values of a chunk, differing values beyond which a pair is not confirmed.
CHUNKS, CHUNK = 12, 5
VALUES, FAR = CHUNKS * CHUNK, 32
#: Shingles up to which a task compares whole sets; beyond, ranges of hashes in a sketch, and sigmas short of the expected
#: number of alike ones at which a pair is not confirmed.
FULL, BINS, SIGMAS = 512, 2048, 5
#: Bucket members compared at a time, and rows in a task that compares them.
BLOCK, TASK_ROWS = 2048, 20_000
#: Pairs that one task confirms.
PAIRS = 4000
#: A further round of stars is made while blocks of hot buckets would copy their members more than this many times.
COPIES = 2.0

_RNG = np.random.default_rng(20240517)
_PLACE = _RNG.integers(1 << 62, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(1 << 62, size=VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1 << 63, size=VALUES, dtype=np.uint64)
_C = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of the whole text, A-Z in lower case; of fewer
    words, their whole sequence; none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < WORDS:
        return _mixed(np.array([(h * _PLACE[:n]).sum() + np.uint64(n)], dtype=np.uint64))
    total = np.zeros(n - WORDS + 1, dtype=np.uint64)
    for j in range(WORDS):
        total += h[j:n - WORDS + 1 + j] * _PLACE[j]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set, 16 bits each."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[at:at + 2048, None] * _A + _B).min(axis=0), out=least)
    return (_mixed(least) >> np.uint64(48)).astype("<u2")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Of each range of hashes the least of the sorted set, as a byte; 0 where the set has none."""
    own = (hashes >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.zeros(BINS, dtype=np.uint8)
    out[own[first]] = (_mixed(hashes[first]) >> np.uint64(40)) % np.uint64(255) + np.uint64(1)
    return out


def may_link(x: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which ``others`` (sketches of sets of ``sizes``) may be similar enough to the set of sketch ``x`` and size
    ``n``. Each range that either has shows an even draw from the union, without replacement: the more of the union it
    shows, the smaller the error."""
    p = PERCENT / 100
    alike = ((others == x) & (x > 0)).sum(axis=1)
    shown = ((others > 0) | (x > 0)).sum(axis=1)
    unseen = np.maximum(1 - shown * (1 + p) / (sizes + n), 0.1)
    return alike >= p * shown - 1 - SIGMAS * np.sqrt(p * (1 - p) * shown * unseen)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, VALUES) -> (n, VALUES) bucket keys: of each chunk, without each of its values in turn."""
    place = (np.arange(VALUES, dtype=np.uint64) + np.uint64(1)) * _C
    terms = _mixed((signatures.astype(np.uint64) + np.uint64(1)) * _C + place).reshape(-1, CHUNKS, CHUNK)
    keys = terms.sum(axis=2, keepdims=True) - terms + _mixed(place).reshape(CHUNKS, CHUNK)
    return _mixed(keys).reshape(-1, VALUES).view(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, n_shingles, digest, signature) of every row; digest and signature are null
    without shingles. tkey is a hash of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            sets = ((shingles(t, known)) for t in batch["text"])
            rows = [(len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s).tobytes()) if len(s) else (0, None, None) for s in sets]
            out = pd.DataFrame(rows, columns=["n_shingles", "digest", "signature"])
            yield pd.concat([batch[["doc_id", "tkey"]].astype({"doc_id": "Int64"}).reset_index(drop=True), out], axis=1)

    rows = columns(docs, doc_id="long", text="string").withColumn("tkey", F.unhex(F.md5(empty_text())))
    return rows.mapInPandas(run, "doc_id long, tkey binary, n_shingles long, digest binary, signature binary")


def _entered(classes: DataFrame) -> DataFrame:
    """(key, node): every bucket that each class is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                s = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)
                node = np.repeat(part.column("node").to_numpy(), VALUES)
                yield pa.RecordBatch.from_arrays([pa.array(chunk_keys(s).ravel()), pa.array(node)], ["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key long, node long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The written ``pairs`` (a, b) whose full sets are similar enough."""
    rows = pairs.count()
    both = few(pairs.join(texts.withColumnsRenamed({"node": "a", "text": "ta"}), "a"), rows, PAIRS)
    both = few(both.join(texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b"), rows, PAIRS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            linked = []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                if len(sets) > 2000:
                    sets.clear()
                x = sets[a] if a in sets else sets.setdefault(a, shingles(ta, known))
                y = sets[b] if b in sets else sets.setdefault(b, shingles(tb, known))
                both_in = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both_in >= PERCENT * (len(x) + len(y) - both_in))
            yield batch.loc[linked, ["a", "b"]]

    return both.select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def shown(hashes: np.ndarray) -> bytes:
    """What a task is given of a set: 32 bits of each hash of a small one, the sketch of a large one."""
    return np.unique(hashes >> np.uint64(32)).astype("<u4").tobytes() if len(hashes) <= FULL else sketch(hashes).tobytes()


def _shown(texts: DataFrame) -> DataFrame:
    """(node, n, sketch) of ``texts`` (node, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            sets = (shingles(t, known) for t in batch["text"])
            rows = [(len(s), shown(s)) for s in sets]
            yield pd.DataFrame(rows, columns=["n", "sketch"]).assign(node=batch["node"].to_numpy())[["node", "n", "sketch"]]

    return texts.select("node", "text").mapInPandas(run, "node long, n long, sketch binary")


class Linker:
    """Whether members of a block, known by what is shown of their sets, may be linked."""

    def __init__(self, n: np.ndarray, shown_sets: list[bytes]):
        self.n, self.raw, self.sets = n, shown_sets, {}

    def _set(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = np.frombuffer(self.raw[i], "<u4" if self.n[i] <= FULL else np.uint8)
        return self.sets[i]

    def small(self, i: int) -> bool:
        return self.n[i] <= FULL

    def whole(self, x: int, y: np.ndarray) -> np.ndarray:
        """Of small sets ``y`` those that share enough with small ``x``. Hashes alike by accident only raise the number in common."""
        a, nx = self._set(x), int(self.n[x])
        out = (100 * self.n[y] >= PERCENT * nx) & (100 * nx >= PERCENT * self.n[y])
        near = np.flatnonzero(out)
        if len(near):
            sets = [self._set(j) for j in y[near]]
            sizes = np.array([len(b) for b in sets])
            flat = np.concatenate(sets)
            hit = a[np.minimum(np.searchsorted(a, flat), len(a) - 1)] == flat
            common = np.add.reduceat(hit, np.cumsum(sizes) - sizes, dtype=np.int64) + (nx - len(a)) + (self.n[y[near]] - sizes)
            out[near] = 100 * common >= PERCENT * (nx + self.n[y[near]] - common)
        return out

    def sketched(self, x: int, y: np.ndarray) -> np.ndarray:
        """Of large sets ``y`` those that may link with large ``x``; a small and a large set too, by their sizes alone."""
        if self.small(x):
            return 100 * self.n[x] >= PERCENT * self.n[y]
        out = 100 * self.n[y] >= PERCENT * self.n[x]
        large = np.flatnonzero(out & (self.n[y] > FULL))
        if len(large):
            out[large] = may_link(self._set(x), int(self.n[x]), np.stack([self._set(j) for j in y[large]]), self.n[y[large]])
        return out


def block_links(key: int, node, comp, n, signatures: np.ndarray, shown_sets: list[bytes], left, right, spanning: bool = True) -> list[tuple[int, int]]:
    """Pairs of members of ``left`` and ``right`` (places) of bucket ``key`` in different components that may be linked; a pair is
    looked at in the first bucket that it shares. With ``spanning``, pairs of small sets that join components
    already joined here are left out."""
    linker, found = Linker(n, shown_sets), []
    keys = chunk_keys(signatures)
    place = int((keys[0] == key).argmax())
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            parent[c] = c = parent.get(parent[c], parent[c])
        return c

    for x in left:
        y = right[(comp[right] != comp[x]) & (node[right] != node[x])]
        differ = (signatures[y] != signatures[x]).sum(axis=1)
        y = y[differ <= FAR][np.argsort(differ[differ <= FAR], kind="stable")]
        y = y[(keys[y] == keys[x]).argmax(axis=1) == place]
        both = (n[y] <= FULL) if n[x] <= FULL else np.zeros(len(y), dtype=bool)
        own, small, at = int(comp[x]), y[both], 0
        while at < len(small):  # the closest first, then more at a time
            some = small[at:at + (4 if at == 0 else 64)]
            at += len(some)
            if spanning:
                some = some[[root(own) != root(int(c)) for c in comp[some]]]
            for j in some[linker.whole(x, some)] if len(some) else ():
                if not spanning or root(own) != root(int(comp[j])):
                    found.append((x, j))
                    parent[root(own)] = root(int(comp[j]))
        rest = y[~both]
        if len(rest):
            found += [(x, j) for j in rest[linker.sketched(x, rest)]]
    return [(min(int(node[x]), int(node[j])), max(int(node[x]), int(node[j]))) for x, j in found]


def _unsettled(members: DataFrame, component: DataFrame, rows: int) -> DataFrame:
    """(key, node, component, n) of the buckets that hold several components."""
    known = few(members.select("key", "node").join(component, "node", "left"), rows).withColumn("component", F.coalesce("component", "node"))
    of = Window.partitionBy("key")
    known = known.withColumn("n", F.count("*").over(of)).withColumn("lo", F.min("component").over(of)).withColumn("hi", F.max("component").over(of))
    return materialize(few(known.filter("lo != hi").select("key", "node", "component", "n"), rows), "near-mixed")


def _crossing(mixed: DataFrame, classes: DataFrame, texts: DataFrame, spanning: bool = True) -> DataFrame:
    """Pairs of different components that share a bucket and may be linked (``block_links``). The members of a bucket are dealt to
    blocks and each two blocks of a bucket are compared in a task."""
    spark = mixed.sparkSession
    entries = mixed.count()
    wanted = materialize(few(mixed.select("node").distinct(), entries), "near-wanted")
    shown_of = _shown(few(texts.join(wanted, "node", "left_semi"), entries, TASK_ROWS))
    given = few(classes.select("node", "signature").join(shown_of, "node"), entries, TASK_ROWS)
    blocks = f"cast((n + {BLOCK - 1}) div {BLOCK} as int)"
    rows = mixed.withColumn("block", F.expr(f"cast(pmod(xxhash64(node), {blocks}) as int)")).withColumn("other", F.explode(F.expr(f"sequence(0, {blocks} - 1)")))
    rows = rows.select("key", "node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    tasks = rows_per_split(spark, entries, TASK_ROWS)
    rows = few(rows.join(given, "node"), entries, TASK_ROWS).withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = set()
        for (key, i, j), part in pdf.groupby(["key", "i", "j"], sort=False):
            part = part.sort_values("node")
            s = np.frombuffer(b"".join(part["signature"]), "<u2").reshape(-1, VALUES)
            node, comp, block, n = (part[c].to_numpy() for c in ("node", "component", "block", "n"))
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            found.update(block_links(key, node, comp, n, s, part["sketch"].tolist(), left, right, spanning))
        out = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})

    return few(rows.groupBy("task").applyInPandas(run, "a long, b long"), entries, TASK_ROWS).distinct()


def _tried(pairs: DataFrame, rows: int) -> DataFrame:
    """Of each node's partners (a, b; as often as they meet) the one met most often, the smallest and the largest."""
    pairs = few(pairs.groupBy("a", "b").agg(F.count("*").alias("met")), rows)
    ends = pairs.select(F.explode(F.array(F.struct("a", "b", "met"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "met"))).alias("e")).select("e.*")
    chosen = ends.groupBy("a").agg(F.max(F.struct("met", F.col("b").alias("b")))["b"].alias("most"), F.min("b").alias("lo"), F.max("b").alias("hi"))
    chosen = few(chosen, rows).select("a", F.explode(F.array_distinct(F.array("most", "lo", "hi"))).alias("b"))
    return materialize(few(chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), rows), "near-tried")


def _joined(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after ``links`` (a, b): components met by a link are joined, the rest stay."""
    if component is None:
        return materialize(components(links), "near-components")
    a = component.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = component.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    found = components(between).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    both = component.join(found, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    # a node that no component had yet, and that is linked now, stands in ``found`` under its own number
    new = found.select(F.col("component").alias("node"), F.col("joined").alias("component")).join(component.select("node"), "node", "left_anti")
    return materialize(both.unionByName(new), "near-components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    rows = materialize(sketched(docs).withColumn("row", F.monotonically_increasing_id()), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey", "row"))
    classes = rows.filter("digest is not null").groupBy("digest").agg(first.alias("first"), F.max("signature").alias("signature"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    # Buckets with company: a member's partner is the smallest of its bucket in an order of the bucket's own.
    of = Window.partitionBy("key")
    entered = _entered(classes).withColumn("n", F.count("*").over(of)).withColumn("pivot", F.min(F.col("node").bitwiseXOR(F.col("key"))).over(of))
    entered = few(entered.filter("n > 1").select("key", "node", F.col("pivot").bitwiseXOR(F.col("key")).alias("pivot")), VALUES * classes.count())
    members = materialize(entered, "near-members")
    entries = members.count()

    nodes = few(members.select("node").distinct(), entries).join(classes, "node").select("node", F.col("first.tkey").alias("tkey"), F.col("first.doc_id").alias("_id"))
    wanted = columns(docs, doc_id="long", text="string").withColumn("tkey", F.unhex(F.md5(empty_text())))
    texts = wanted.join(nodes, (wanted["tkey"] == nodes["tkey"]) & wanted["doc_id"].eqNullSafe(nodes["_id"])).select("node", "text")
    texts = materialize(few(texts.dropDuplicates(["node"]), classes.count(), TASK_ROWS), "near-texts")

    stars = members.filter("node != pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    component = _joined(None, _confirmed(_tried(stars, entries), texts))
    mixed = _unsettled(members, component, entries)
    copies = F.sum(F.ceil(F.col("n") / BLOCK))
    count, copied = mixed.agg(F.count("*"), copies).first()
    while count and copied > COPIES * count:  # hot buckets in several components: stars between components, a few pairs a member
        pairs = mixed.withColumn("least", F.min(F.struct(F.xxhash64("component", "key").alias("h"), "component", "node")).over(of)).filter("component != least.component")
        pairs = pairs.select(F.least("node", "least.node").alias("a"), F.greatest("node", "least.node").alias("b"))
        component = _joined(component, _confirmed(_tried(pairs, count), texts))
        before, mixed = count, _unsettled(members, component, entries)
        count, copied = mixed.agg(F.count("*"), copies).first()
        if 2 * count > before:
            break

    if count:
        reported = materialize(_crossing(mixed, classes, texts), "near-reported")
        more = materialize(_confirmed(reported, texts), "near-more")
        if more.count() < reported.count() and _doubted(reported, more, classes, rows):
            more = materialize(_confirmed(materialize(_crossing(mixed, classes, texts, spanning=False), "near-reported"), texts), "near-more")
        component = _joined(component, more)

    found = classes.select("digest", "node", "first").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    chosen = F.min("first").over(Window.partitionBy("component"))
    found = found.withColumn("chosen", chosen).select("digest", F.col("chosen.doc_id").alias("component_id"), F.col("chosen.row").alias("chosen"))
    # Rows without shingles meet no class and stand for themselves.
    own = F.col("digest").isNull()
    return rows.join(found, "digest", "left").select(
        "doc_id", "tkey", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, True).when(F.col("component_id").isNull(), F.col("row") == F.col("chosen")).otherwise(
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).alias("kept"),
        (own | (F.col("row") == F.col("chosen"))).alias("stays"))


def _doubted(reported: DataFrame, confirmed: DataFrame, classes: DataFrame, rows: DataFrame) -> bool:
    """Whether full sets refute a reported pair of two small sets (hashes alike by accident), for which another pair may have been left out."""
    refuted = reported.join(confirmed, ["a", "b"], "left_anti")
    small = classes.join(rows.filter(F.col("n_shingles") <= FULL).select("digest").distinct(), "digest", "left_semi").select("node")
    return not refuted.join(small.withColumnRenamed("node", "a"), "a", "left_semi").join(small.withColumnRenamed("node", "b"), "b", "left_semi").isEmpty()


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group; rows without shingles all stay."""
    found = materialize(near_duplicates(docs).select(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey"), "n_shingles", "stays"), "near-stay")
    stay = found.filter("stays").drop("stays")
    keyed = docs.withColumn("_t", F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")))))
    empty = stay.filter("n_shingles = 0").select("_id", "_tkey").distinct()
    stay = stay.filter("n_shingles > 0").select("_id", "_tkey").unionByName(empty)
    match = keyed["doc_id"].cast("long").eqNullSafe(stay["_id"]) & (keyed["_t"] == stay["_tkey"])
    kept = keyed.join(stay, match, "left_semi")
    twins = found.filter("n_shingles > 0").groupBy("_id", "_tkey").count().filter("count > 1")
    if not twins.isEmpty():  # rows alike in id and text: one of them, if they have words
        words = F.length(F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x09-\x0D]", " "))) > 0
        kept = kept.filter(~words).unionByName(kept.filter(words).dropDuplicates(["doc_id", "_t"]))
    return kept.drop("_t")
