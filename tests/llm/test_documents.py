"""Operators on documents: odd rows and empty tables, held against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mixing(spark, odd, empty):
    from tessera.llm.mixing import mix, taken
    rows = taken(*mix(odd, block=64)).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(WORD.findall(t or "")) for _, t, _, _ in ROWS)
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["sr"]].append(r)
    for own in by.values():
        assert sum(r["taken"] for r in own) == int(own[0]["target"] + 0.5)
    assert sum(r["size"] for r in rows) * 1.5 == pytest.approx(sum(own[0]["target"] for own in by.values()))
    assert taken(*mix(empty)).count() == 0


def test_mixed_documents_keep_columns(odd, empty):
    from tessera.llm.mixing import mixed_documents
    assert mixed_documents(odd).columns == odd.columns
    assert mixed_documents(empty).count() == 0


def test_packing(odd, empty):
    from tokenizers import Tokenizer

    from tessera.llm.packing import pack, pieces, sequences, tokenizer_path
    packed = pack(pieces(odd, tokenizer_path(), with_ids=True))
    got = packed.collect()
    t = Tokenizer.from_file(tokenizer_path())
    want = sorted(np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, x, _, _ in ROWS)
    assert sorted(bytes(r["ids"]) for r in got if r["doc_tokens"] <= 2048) == [w for w in want if len(w) <= 4 * 2048]
    assert sum(r["length"] for r in got) == sum(map(len, want)) // 4
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048
    assert {r["sequence_id"]: len(r["ids"]) // 4 for r in sequences(packed).collect()} == ends
    assert pack(pieces(empty, tokenizer_path())).count() == 0


def test_fingerprints(odd, empty):
    from tessera.llm.fingerprints import fingerprints
    got = fingerprints(odd).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    long = next(r for r in got if r["doc_id"] == 7)
    text, following = ROWS[8][1], ROWS[0][1]  # 5 follows 7
    cut = len(text) // 3
    assert long["n_chars"] == len(text)
    assert long["edited_sha256"] == hashlib.sha256((text[:len(text) - cut] + " \t\n").encode()).hexdigest()
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}) == 1 and following
    assert fingerprints(empty).count() == 0


def test_texts_without_sentence_ends_have_many_digests(spark):
    from tessera.llm.fingerprints import fingerprints
    rng = np.random.default_rng(4)

    def letters(first, many, n):
        return "".join(chr(first + int(i)) for i in rng.integers(0, many, n))

    words = " ".join(letters(97, 26, 6) for _ in range(500))
    code = ";".join(f"{letters(97, 26, 5)}({letters(97, 26, 3)}={i})" for i in range(300))
    stops = "".join(letters(0x4E00, 2000, 20) + "。" for _ in range(60))
    texts = [words, code, stops, letters(0x4E00, 2000, 2000), letters(0x3041, 80, 2000), "same " * 1000, letters(97, 26, 4000)]
    got = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    # What is repeated counts once, so the text of one word has few digests; they are still found.
    assert {r["doc_id"]: r["near_edited"] for r in got if r["near_edited"] < (0.01 if r["doc_id"] == 5 else 0.3)} == {}
    # 6 of 7 next texts are unrelated, as is the last's first.
    assert max(r["near_next"] for r in got) < 0.1
    # A change at the front leaves the rest alike.
    moved = fingerprints(spark.createDataFrame([(1, "new start of " + words), (0, words)], "doc_id long, text string")).collect()
    assert min(r["near_next"] for r in moved) > 0.8


def test_small_sketches_peel_after_retries(spark):
    from tessera.llm.fingerprints import compare
    a, b = [int(x) for x in range(1, 400)], [int(x) for x in range(200, 700)]
    pairs = spark.createDataFrame([(1, a, b), (2, a, a), (3, [], [])], "id int, a array<long>, b array<long>")
    near = {r["id"]: r["near"] for r in compare(pairs, ["id"], load=0.02).collect()}
    assert near == {1: pytest.approx(200 / 699), 2: 1.0, 3: 1.0}


def test_near_duplicates(spark, odd, empty):
    from tessera.llm.near_dedup import keep_one, near_duplicates
    got = near_duplicates(odd).collect()
    of = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in got}
    assert of[(1, 6)] == (1, True) and of[(2, 6)] == (1, False)
    assert of[(3, 0)] == (3, True) and of[(4, 0)] == (4, True) and of[(None, 7)] == (None, True)
    kept = keep_one(odd).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 3, 4, 5, 7, 8, 9]
    assert near_duplicates(empty).count() == 0


def test_language(odd, empty):
    from tessera.llm.language import identify, keep_known
    got = identify(odd).collect()
    assert len(got) == len(ROWS)
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (3, 4, 5, 8))
    assert all(0 <= r["score"] <= 1 for r in got)
    assert keep_known(odd).columns == odd.columns
    assert identify(empty).count() == 0


def test_unlabelled_documents_with_letters_are_kept(odd):
    from tessera.llm.language import keep_known
    kept = keep_known(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for _, t, _, _ in ROWS if t and re.search("[a-z]", t))


def test_quality(spark, odd, empty):
    from tessera.llm.quality import keep_good, score
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1), (9, None), (8, 0)], "doc_id long, quality int")
    got = score(odd, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert keep_good(odd, labels).columns == odd.columns
    assert score(empty, labels).count() == 0
    assert score(odd, labels.limit(0)).count() == len(ROWS)


def test_sharding(odd, empty):
    from tessera.llm.sharding import difference, shard
    got = shard(odd, 4, block=4, bundles=2).collect()
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t, _, _ in ROWS)
    assert len({r["shard"] for r in got if r["doc_id"] in (1, 2)}) == 1
    for k in range(4):
        own = sorted(r["slot"] for r in got if r["shard"] == k)
        assert own == list(range(len(own)))
    assert shard(empty).count() == 0
    sums = np.bincount(difference(np.arange(1, 2001), 16), weights=np.arange(1, 2001))
    assert sums.max() - sums.min() <= 1e-3 * sums.mean()


def test_sketches_keep_every_pair_that_links():
    from tessera.llm.near_dedup import FULL, PERCENT, Linker, may_link, shown, sketch
    rng = np.random.default_rng(9)
    for size in (1, 4, 5, 17, 90, 400, 600, 1500, 6000, 20_000):
        for _ in range(40):
            union = rng.integers(0, 1 << 63, size=size, dtype=np.uint64) * np.uint64(2)
            common = -(-PERCENT * size // 100)
            cut = common + rng.integers(0, size - common + 1)
            a, b = np.sort(union[:cut]), np.sort(np.concatenate([union[:common], union[cut:]]))
            assert may_link(sketch(a), len(a), sketch(b)[None], np.array([len(b)])).all()
            linker = Linker(np.array([len(a), len(b)]), [shown(a), shown(b)])
            if max(len(a), len(b)) <= FULL:
                assert linker.whole(0, np.array([1])).all()
            else:
                assert linker.sketched(0, np.array([1])).all()
    a, b = (np.sort(rng.integers(0, 1 << 63, size=300, dtype=np.uint64)) for _ in range(2))
    assert not may_link(sketch(a), 300, sketch(b)[None], np.array([300])).any()
    assert not Linker(np.array([300, 300]), [shown(a), shown(b)]).whole(0, np.array([1])).any()


def _slow_components(texts):
    """Smallest reachable id by comparing all pairs."""
    sets = []
    for t in texts:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    of = list(range(len(texts)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                of[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def _near_copies(rng, n, words, changed):
    base = [f"w{i}" for i in rng.integers(0, 5000, words)]
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, words, changed):
            own[at] = f"c{rng.integers(0, 10**6)}"
        yield " ".join(own)


def test_near_duplicate_components_against_all_pairs(spark, monkeypatch):
    from tessera.llm import near_dedup
    rng = np.random.default_rng(3)
    common = " ".join(f"p{i}" for i in range(60))
    texts = [*_near_copies(rng, 120, 120, 3), *_near_copies(rng, 60, 40, 1), *_near_copies(rng, 30, 900, 20), None, "", "a b", "a b"]
    texts += [common + " " + " ".join(f"r{i}" for i in rng.integers(0, 10**6, 20)) for _ in range(60)]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _slow_components(texts)
    for block, copies in ((2048, 2.0), (16, 1.0)):  # also with blocks so small that hot buckets take further rounds
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "COPIES", copies)
        got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()}
        assert {i: (c, c == i) for i, c in enumerate(want)} == got


@pytest.mark.parametrize("n", [400, 800])
def test_pairs_to_confirm_follow_the_documents(spark, monkeypatch, n):
    from tessera.llm import near_dedup
    rng = np.random.default_rng(5)
    seen, real = [], near_dedup._confirmed

    def counted(pairs, texts):
        seen.append(pairs.count())
        return real(pairs, texts)

    monkeypatch.setattr(near_dedup, "_confirmed", counted)
    df = spark.createDataFrame(list(enumerate(_near_copies(rng, n, 120, 2))), "doc_id long, text string")
    assert len({r["component_id"] for r in near_dedup.near_duplicates(df).collect()}) >= 1
    assert sum(seen) <= 8 * n


def test_components_against_search(spark):
    from tessera.llm.components import components
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    of = {x: x for e in edges for x in e}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        of[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_of_letters_with_marks_are_the_tokenizers():
    import unicodedata

    from tokenizers import Tokenizer

    from tessera.llm.packing import Encoder, tokenizer_path
    letters = [chr(c) for c in (*range(0x41, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)) if chr(c).isalpha()]
    letters += sorted({unicodedata.normalize("NFD", c) for c in letters if c != unicodedata.normalize("NFD", c)})
    marks = [chr(c) for c in range(0x300, 0x346)]
    # Words of a letter and a mark, alone and within a word, a letter to a text.
    texts = [" ".join(f"{a}{m} x{a}{m}y." for m in marks) for a in letters]
    t = Tokenizer.from_file(tokenizer_path())
    want = [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(b, "<u4").tolist() for b in Encoder(tokenizer_path())(texts)]
    assert [x for x, a, b in zip(texts, got, want, strict=True) if a != b] == []
