"""Findings of round 3 on disk and time: what is ordered, moved and scanned follows the rows asked for."""

import hashlib

from pyspark.sql import functions as F

from tessera.operators import spans as S

SPANS = "array<struct<type:string,start:int,end:int>>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_negative_spans_move_whole_documents_only(spark):
    rows = [(1, list("abcd"), [("x", 0, 2), ("x", 3, 4)]), (1, list("abc"), []), (None, list("ab"), [("x", 0, 1)]), (2, [], [])]
    d = spark.createDataFrame(rows, f"d int, tokens array<string>, entities {SPANS}")
    out = S.negative_spans(d, "d", 3)
    assert "Join" not in _plan(out)   # a join moved one row a token before
    every = lambda n: [(s, s + k) for k in (1, 2, 3) for s in range(n - k + 1)]
    want = [(1, *z) for n in (4, 3) for z in every(n) if z not in ((0, 2), (3, 4))] + [(None, *z) for z in every(2)]   # a key may repeat; null is no key
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(map(tuple, out.select("d", "start", "end").collect()), key=key) == sorted(want, key=key)


def test_a_sample_orders_few_rows_of_a_group(spark, tmp_path, monkeypatch):
    n = 20_000
    rows = spark.range(n).select((F.col("id") % 3).alias("g"), "id").unionByName(spark.createDataFrame([(None, 5), (9, 1), (9, 2)], "g long, id long"))
    kept, real = [], S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df, name: kept.append(real(df, name)) or kept[-1])
    got = sorted(((r.g, r.id) for r in S.sample_per_group(rows, "g", 4, "s", F.col("id")).collect()), key=str)
    first = lambda ids: sorted(ids, key=lambda i: hashlib.md5(f"s{i}".encode()).hexdigest())[:4]
    want = [(g, i) for g in range(3) for i in first(range(g, n, 3))] + [(None, 5), (9, 1), (9, 2)]
    assert got == sorted(want, key=str)
    assert kept and kept[0].count() == len(want)


def test_a_group_of_one_id_is_sampled_whole(spark):
    rows = spark.range(5_000).select(F.lit(1).alias("g"), F.lit(7).alias("id"))   # its hash may lie above any bound
    for seed in "abcdefgh":
        assert S.sample_per_group(rows, "g", 4, seed, F.col("id")).count() == 4


def test_documents_and_phrases_meet_where_they_were_dealt(spark):
    docs = spark.createDataFrame([(1, "a b a b".split()), (2, ["a"]), (None, ["a"])], "d int, tokens array<string>").repartition(5, "d")
    phrases = spark.createDataFrame([(1, 0, 2, "a b"), (1, 1, 1, "b"), (1, 2, 1, "b"), (2, 0, 1, "z"), (None, 0, 1, "a")], "d int, k int, size int, phrase string").repartition(5, "d")
    found = S.find_phrases(docs, phrases, "d")
    assert _plan(found).count("Exchange") == _plan(found).count("REPARTITION_BY_NUM")   # windows were dealt anew before
    assert sorted((r.d, r.k, r.occ) for r in found.collect()) == [(1, 0, 0), (1, 0, 2), (1, 1, 1), (1, 1, 3), (1, 2, 1), (1, 2, 3)]


def test_tokens_are_split_where_they_are(spark, monkeypatch):
    vocab = spark.createDataFrame([("[UNK]", 1), ("ab", 4), ("a", 5), ("##c", 6), ("##b", 7), ("##cb", 8), ("ab", 9), ("##é", 10)], "piece string, idx int")
    tokens = spark.createDataFrame([(1, 0, "abcb"), (1, 1, "x"), (1, 2, ""), (1, 3, None), (2, 0, "abé"), (2, 1, "a" * 101)], "d int, tok_idx int, token string")
    plan = lambda: S.encode_subwords(tokens, vocab, "d")
    assert "Join" not in _plan(plan())
    got = sorted(map(tuple, plan().collect()))
    monkeypatch.setattr(S, "BROADCAST_PIECES", 0)
    assert got == sorted(map(tuple, plan().collect())) and [r[4] for r in got] == [[4, 8], [1], [1], [4, 10], [1]]


def test_sentences_and_predictions_look_arguments_up_at_once(spark):
    n = 3_000
    ner = [[(0, 0, "a"), (1, 1, "b"), (0, 0, "c")], [(k + 2, k + 2, "t") for k in range(n)]]
    rel = [[(0, 0, 1, 1, "r"), (5, 5, 0, 0, "r")], [(k + 2, k + 2, n + 1 - k, n + 1 - k, "r") for k in range(n)]]
    d = spark.createDataFrame([("k", [["x", "y"], ["z"] * n], ner, rel), ("e", [], [], [])], "doc_key string, sentences array<array<string>>, "
                              "ner array<array<struct<s:int,e:int,type:string>>>, relations array<array<struct<hs:int,he:int,ts:int,te:int,type:string>>>")
    out = S.explode_sentences(d)
    assert "arrow" in _plan(out).lower()   # a scan of all entities for each relation before
    got = {r.orig_id: r for r in out.collect()}
    assert [tuple(r) for r in got["k_0"].relations] == [("r", 2, 1), ("r", None, 2)]
    assert [tuple(r) for r in got["k_1"].relations] == [("r", k, n - 1 - k) for k in range(n)] and got["k_1"].entities[0].start == 0
    docs = spark.createDataFrame([(1, [("b", 4, 5), ("a", 0, 1), ("b", 4, 5)], [("r", 2, 1), ("q", 1, 0)]), (2, [], [])],
                                 f"d int, entities {SPANS}, relations array<struct<type:string,head:int,tail:int>>")
    said = {r.d: r for r in S.format_predictions(docs).collect()}
    assert [tuple(r) for r in said[1].relations] == [("q", 0, 1), ("r", 1, 0)] and said[2].relations == []
    assert [e.start for e in said[1].entities] == [0, 4, 4]


def test_a_packing_worker_remembers_a_bounded_number_of_chunks(monkeypatch):
    from tessera.llm import packing
    assert packing.REMEMBERED * 300 * 4 < 200e6   # four workers of an executor; 1,200 MB before
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    own = packing.Encoder(packing.tokenizer_path())
    texts = [" ".join(f"w{k}-{i}!" for i in range(50)) for k in range(40)]
    ids = [own([t])[0] for t in texts]
    assert len(own.known) <= 150 and len(own.stems) <= 300
    assert ids == packing.Encoder(packing.tokenizer_path())(texts)
