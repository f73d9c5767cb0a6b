"""Findings on time and disk of larger tables: rows that are made and moved grow no faster than the input."""

from pyspark.sql import functions as F

from tessera.operators import spans as S

SPANS = "array<struct<type:string,start:int,end:int>>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_positions_move_no_entities(spark):
    ents = [("x", k, k + 1) for k in range(600)]
    d = spark.createDataFrame([(1, ents), (2, ents[:3]), (2, ents[:2]), (3, ents[:1]), (4, []), (5, None), (None, ents[:4])], f"d int, entities {SPANS}")
    out = S.candidate_pairs(d, "d")
    assert "Join" not in _plan(out)   # blocks of entities met one another in joins before
    twice = [0, 1, 2, 0, 1]           # rows of one key are one document
    got = out.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("i") * 1000 + F.col("j")).alias("s"))
    assert sorted(map(tuple, got.collect())) == [(1, 600 * 599, sum(i * 1000 + j for i in range(600) for j in range(600) if i != j)),
                                                 (2, *map(sum, zip(*[(1, i * 1000 + j) for i in twice for j in twice if i != j])))]


def test_a_packing_worker_keeps_chunks_that_come_again(monkeypatch):
    import numpy as np

    from tessera.llm import packing
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    own, asked = packing.Encoder(packing.tokenizer_path()), []
    real = own._encode
    monkeypatch.setattr(own, "_encode", lambda new: asked.extend(new) or real(new))
    odd = "İstanbul straße Σσς ŉa 中文 ཀཱ Ɤa \U00031350b naïve! it's 'll x2y a<|b ͅ ǅ ªb"
    texts = [f"again {' '.join(f'w{k}z{i}' for i in range(40))} {' '.join(map(chr, range(97 + k, 99 + k)))}" for k in range(20)] + [odd, odd + "!"]
    ids = [np.frombuffer(own([t])[0], "<u4").tolist() for t in texts]
    assert asked.count("again") == 1   # all chunks were forgotten at once before
    assert ids == [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_graph_files_rank_narrow_rows(spark, monkeypatch):
    from tessera.operators import splits
    from tessera.plans import q_sources
    ranked, real = [], splits.global_rank
    monkeypatch.setattr(splits, "global_rank", lambda df, *more: ranked.append(df.columns) or real(df, *more))
    paths = q_sources._graph_files(spark, "/root/testdata/sf0.001")
    assert len(ranked) == 2 and not any("x" in columns for columns in ranked)   # the features were ordered and written with the numbers before
    lines = {k: spark.read.text(p).count() for k, p in paths.items()}
    assert lines["indicator"] == lines["attributes"] and lines["edges"] == 2 * (lines["attributes"] - lines["labels"])


def test_graph_nodes_are_ordered_and_counted_in_one_window(spark):
    from tessera.plans import fixtures as FX
    nodes = FX._graph_nodes(spark, "/root/testdata/sf0.001")
    assert nodes._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1   # two before
    sizes = nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n"), F.min("_n").alias("a"), F.max("_n").alias("b"), F.max("node").alias("m"))
    assert sizes.filter("n <> a or n <> b or m <> n - 1").isEmpty() and not sizes.isEmpty()


def test_a_packing_worker_encodes_plain_words_without_the_normalizer(monkeypatch):
    import numpy as np

    from tessera.llm import packing
    own, asked = packing.Encoder(packing.tokenizer_path()), []
    real = own._ids
    monkeypatch.setattr(own, "_ids", lambda text, tokenizer: asked.append((text, tokenizer)) or real(text, tokenizer))
    rng = np.random.default_rng(5)
    ends = ["", "!", ",.", "'s", "é!", "ß?", "İ.", "ɏ,", "ɐ,", "͏.", "8)", "²;", "<|", "<|endoftext|>!", "中!", "\xa0b.", "\x1c,", "\x85!", "...x", "é.", "J̌!", "Σ.", "µ,", "ª!"]
    texts = ["", " ", "\n!\t"] + ["".join(rng.choice(["straße", "Çam", "naïve", "words", "a", "'ll", "ſ", "Dž"]) + rng.choice(ends) + rng.choice([" ", "  ", "\n", "\x0b", "　", ""])
                                          for _ in range(40)) for _ in range(60)]
    assert [np.frombuffer(b, "<u4").tolist() for b in own(texts)] == [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own([]) == [] and own(["", " "]) == [b"", b""]
    # one call of the merges alone for many words, several of the whole tokenizer before
    asked.clear()
    words = [a + b + c for a in "bcdfghjkl" for b in "aeiouäé" for c in "mnprst"]
    assert len(own([" ".join(words)])[0]) > 0
    assert [t is own.plain for _, t in asked] == [True]


def test_packing_calls_part_the_documents():
    from tessera.llm import packing
    size = packing.TOGETHER
    assert packing.calls(["a" * (size // 2)] * 5, 1, 5) == [1, 3, 5]
    assert packing.calls(["a", "b" * (2 * size), "", "c"], 0, 4) == [0, 1, 2, 4]
    assert packing.calls([], 0, 0) == [0]
