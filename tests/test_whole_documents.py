"""Findings of round 4 on memory, disk and time: linear work of a text or document is done where it is, without a row a token that moves."""

import re

from pyspark.sql import functions as F

from tessera.operators import spans as S


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tokens(texts, dot):
    """Tokens of the texts of one key as one stream, by loops."""
    rows, m, e, end = [], None, 0, 0
    pieces = sorted((k, len(p.group(0)), p.group(0).lstrip(" \t\n\x0b\f\r"), cut) for t in texts for cut in [dot and t.endswith(".")]
                    for k, p in enumerate(re.finditer(r"[ \t\n\x0b\f\r]*[^ \t\n\x0b\f\r]+", t[:-1] if cut else t)))
    for k, n, token, cut in pieces:
        end += n
        rows.append((k, token, end - len(token), end))
        m, e = (max(k, m or 0), end) if cut else (m, e)
    return rows + ([(m + 1, ".", e, e + 1)] if m is not None else [])


def test_tokens_are_found_where_their_text_was_dealt(spark, monkeypatch):
    monkeypatch.setattr(S, "TEXT_BYTES", 32)   # several runs of texts, one of a single long text
    texts = {1: ["a b."], 2: [" Grüße,\t中文 \U0001f600x\n."], 3: ["."], 4: [""], 5: [None], 6: ["x..", "x.."], 7: ["a bb", "a bb c ."], 8: ["é\xa0b " * 40], 9: ["y"],
             None: ["n o.", "n o."]}
    lines = spark.createDataFrame([(k, t) for k, own in texts.items() for t in own], "k long, line string")
    for dot in (False, True):
        toks = S.tokenize(lines, "k", "line", detach_final_dot=dot)
        assert "Window" not in _plan(toks)   # token rows were ordered and kept by windows before
        want = sorted(((k or 0, *r) for k, own in texts.items() for r in _tokens([t for t in own if t], dot)))
        assert sorted((r.k or 0, r.tok_idx, r.token, r.char_start, r.char_end) for r in toks.collect()) == want
        listed = S.tokenize(lines, "k", "line", detach_final_dot=dot, listed=True)
        assert sorted((r.k or 0, *z) for r in listed.collect() for z in r.tokens) == want
    assert S.tokenize(lines.limit(0), "k", "line").collect() == []


def _vocab(spark):
    return spark.createDataFrame([("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("ab", 4), ("a", 5), ("##c", 6), ("##b", 7), ("##é", 10)], "piece string, idx int")


def test_documents_are_encoded_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(S, "ENCODED_AT_ONCE", 3)
    docs = [(1, ["abc", "x", "", None, "é"]), (2, ["ab"] * 9), (3, []), (4, ["a"]), (None, ["a"])]
    make = lambda rows: spark.createDataFrame(rows, "d int, tokens array<string>")
    vocab = _vocab(spark)
    rows = lambda e: sorted(map(tuple, e.collect()))
    for more in ([], [(2, ["b", "abé"] * 5), (2, ["abb"])]):
        d = make(docs + more)
        tokens = S.explode_rows(d.filter("d is not null"), ["d"], "tokens", "tok_idx", "token")
        for broadcast in (0, 10**6):
            monkeypatch.setattr(S, "BROADCAST_PIECES", broadcast)
            e = S.encode_subwords(d, vocab, "d")
            if broadcast and not more:
                assert "hashpartitioning" not in _plan(e)   # a row a token was dealt and ordered before
            got = rows(e.select("d", F.explode("encoded").alias("e")).select("d", F.col("e.tok_idx"), F.col("e.ids").alias("ids")))
            want = rows(S.encode_subwords(tokens, vocab, "d").select("d", "tok_idx", "ids"))
            assert got == want
            spans = [(r.d, z.sub_start, z.sub_end, len(z.ids)) for r in e.collect() for z in r.encoded]
            for k in {s[0] for s in spans}:
                own = sorted(s[1:] for s in spans if s[0] == k)
                assert own[0][0] == 1 and all(b - a == n for a, b, n in own) and all(x[1] == y[0] for x, y in zip(own, own[1:]))
            enc = {r.d: r.encoding for r in S.encodings(e, vocab, "d").collect()}
            assert set(enc) == {1, 2, 4} and enc[1] == [2, 4, 6, 1, 1, 1, 3] and enc[4] == [2, 5, 3]


def test_spans_are_decoded_in_their_document(spark):
    d = spark.createDataFrame([(1, [(0, 1, 3), (1, 3, 4), (2, 2, 9), (3, None, 4)], [(0, 1, 3), (1, 3, 4)]), (2, [], [(0, 1, 2)]), (3, [(0, 1, 2)], None)],
                              "d int, mentions array<struct<i:int,sub_start:int,sub_end:int>>, encoded array<struct<tok_idx:int,sub_start:int,sub_end:int>>")
    out = S.decode_spans(d, "encoded", "d")
    assert "hashpartitioning" not in _plan(out)
    got = {(r.d, m.i): (m.start, m.end) for r in out.collect() for m in r.mentions}
    assert got == {(1, 0): (0, 1), (1, 1): (1, 2), (1, 2): (None, None), (1, 3): (None, 2), (3, 0): (None, None)}
    rows = lambda c, *f: d.select("d", F.explode(c).alias("m")).select("d", *[f"m.{x}" for x in f])
    by_rows = S.decode_spans(rows("mentions", "i", "sub_start", "sub_end"), rows("encoded", "tok_idx", "sub_start", "sub_end"), "d")
    assert {(r.d, r.i): (r.start, r.end) for r in by_rows.collect()} == got
    twice = S.met_listed(d, "encoded", "mentions", ("sub_end", "sub_end"), {"i": "i"})
    assert [(m.tok_idx, m.i) for r in twice.filter("d = 1").collect() for m in r.encoded] == [(0, 0), (1, 1), (1, 3)]


def test_documents_are_put_into_compressed_files_where_they_are(spark, tmp_path, monkeypatch):
    from tessera.sources import readers as RD
    from tessera.sources import writers as WR
    monkeypatch.setattr(WR, "FILE_BYTES", 2_000)
    rows = [([f"é{k}", '"|\n'] * 9, [("x", k, k + 1)], [("r", 0, 1)] * (k % 3), f"d{k}") for k in range(100)] + [([], [], [], None)]
    docs = spark.createDataFrame(rows, RD.DOC_SCHEMA).repartition(3)
    assert not {"groupBy", "repartition"} & set(WR.write_doc_arrays.__code__.co_names + WR.write_bundles.__code__.co_names)   # documents were moved twice before
    WR.write_doc_arrays(docs, str(tmp_path / "a"))
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    assert len(files) > 8 and all(f.name.endswith(".gz") for f in files)   # plain text before
    key = lambda r: str(r)
    assert sorted(RD.read_docs(spark, str(tmp_path / "a")).collect(), key=key) == sorted(docs.collect(), key=key)
    kind = F.when(F.col("orig_id").endswith("7"), "dev").otherwise("train")
    WR.write_bundles(docs.select(kind.alias("kind"), F.to_json(F.struct(*docs.columns)).alias("value")), str(tmp_path / "s"), ("train", "dev", "test"))
    got = RD.read_split_docs(spark, str(tmp_path / "s"))
    assert sorted(got.collect(), key=key) == sorted(docs.withColumn("split", kind).collect(), key=key)
    WR.write_doc_arrays(docs.limit(0), str(tmp_path / "none"))
    assert RD.read_docs(spark, str(tmp_path / "none")).count() == 0


def test_pipe_lines_take_the_sentence_of_their_document(spark, tmp_path):
    from tessera.plans import fixtures as FX
    from tessera.plans import q_sources
    text = "abcdefgh x abcdefghij abcdefghi | y abcdefghijk"
    spark.createDataFrame([(1, text), (2, "none"), (3, text), (3, text), (None, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, real = [], S.relations_with_spans
    try:
        S.relations_with_spans = lambda d, *more: seen.append(d) or real(d, *more)
        rows = q_sources.a6(spark, str(tmp_path)).collect()
    finally:
        S.relations_with_spans = real
    assert "SortMergeJoin" not in _plan(seen[0])   # all documents met all sentences in a join before
    n = {d: sum(r.doc == d for r in rows) for d in ("1", "2", "3")}
    rels = FX.gold_docs(spark, str(tmp_path)).filter("doc_id = 1").select(F.size("relations")).first()[0]
    assert rels > 2 and n == {"1": rels, "2": 0, "3": 4 * rels} and len(rows) == 5 * rels
    assert {r.sentence for r in rows} == {text.replace("|", "/")}


def test_spans_are_sampled_in_their_document(spark, monkeypatch):
    spans = "array<struct<type:string,start:int,end:int>>"
    rows = [(1, ["t"] * 400, [("x", 0, 2), ("y", 7, 8)]), (2, ["t"] * 3, [("x", k, k + 1) for k in range(3)]), (2, ["t"] * 4, []), (3, ["t"], [("x", 0, 1)]), (4, [], []),
            (None, ["t"] * 3, [("x", 0, 1)]), (None, ["t"] * 2, []), (5, ["t"] * 50, [])]
    d = spark.createDataFrame(rows, f"d int, tokens array<string>, entities {spans}")
    one = S.negative_spans(d, "d", 3, listed=True)
    flat = one.select("d", F.explode("spans").alias("z")).select("d", F.explode("z.starts").alias("start"), F.col("z.size").alias("size"))
    key = lambda r: [x if x is not None else -1 for x in r]
    every = sorted((tuple(r) for r in flat.select("d", "start", F.expr("start + size"), "size").collect()), key=key)
    assert every == sorted((tuple(r) for r in S.negative_spans(d, "d", 3).select("d", "start", "end", "size").collect()), key=key)
    want = sorted((tuple(r) for r in S.sample_per_group(S.negative_spans(d, "d", 3), "d", 4, "s", F.concat_ws(":", "start", "end")).select("d", "start", "end").collect()), key=key)
    for most in (1, 2_000_000):
        monkeypatch.setattr(S, "SAMPLED_AT_ONCE", most)
        assert sorted((tuple(r) for r in S.sample_per_group(one, "d", 4, "s").collect()), key=key) == want
    unique = S.negative_spans(d.filter("d in (1, 3, 5)"), "d", 3, listed=True)
    plan = _plan(S.sample_per_group(unique, "d", 4, "s"))
    assert "md5" not in plan and "Window" not in plan and "Join" not in plan   # each span was hashed and met the size of its group before


def test_pairs_are_matched_in_their_document(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(3)
    words = lambda n: [str(w) for w in rng.choice(["a", "b", "cc"], n)]
    docs = [(d, words(40)) for d in range(4)] + [(2, words(9)), (5, ["a"]), (None, ["a", "b"])]
    line = lambda no: (no, words(int(rng.integers(1, 4))), words(int(rng.integers(1, 3))), None if no == 7 else int(rng.integers(-8, 9)))
    lines = [[line(no) for no in sorted(rng.integers(0, 90, 60).tolist())] for _ in docs]
    lines[4] = [(no + 100, *z) for no, *z in lines[4]]
    offsets = lambda toks: [sum(len(t) + 1 for t in toks[:i]) for i in range(len(toks))]
    rows = [(d, toks, s := offsets(toks), [x + len(t) for x, t in zip(s, toks)], own) for (d, toks), own in zip(docs, lines)]
    whole = spark.createDataFrame(rows, "d int, tokens array<string>, starts array<int>, ends array<int>, lines array<struct<line_no:int,head_toks:array<string>,tail_toks:array<string>,gap:int>>")
    flat = whole.select("d", F.explode("lines").alias("z")).select("d", "z.*")
    cols = ["d", "line_no", "head_start", "head_end", "tail_start", "tail_end"]
    rows = lambda df: sorted((tuple(-9 if x is None else x for x in r) for r in df.select(*cols).collect()))
    want = rows(S.match_pairs(flat, whole.select("d", "tokens", "starts", "ends"), "d"))
    assert sum(r[2] >= 0 for r in want) > 40
    for size, most in ((200_000, 2_000_000), (1, 3)):
        monkeypatch.setattr(S, "MATCHED_AT_ONCE", size)
        monkeypatch.setattr(S, "FOLLOWED_AT_ONCE", most)
        assert rows(S.match_pairs(whole, None, "d")) == want
    assert "hashpartitioning" not in _plan(S.match_pairs(whole.filter("d <> 2"), None, "d"))   # lines and documents were dealt before


def test_graphs_are_read_by_the_number_of_the_node(spark, tmp_path):
    import gzip

    from tessera.plans import q_sources
    from tessera.sources import readers as RD
    texts = {"edges": "1, 2\n2, 1\n4,5\n9, 1\n3, 5\n\n", "indicator": "1\n1\n2\n2\n2\n", "labels": "7\n8\n", "attributes": "1.5, 2\n3,4\n5, 6\n7, 8\n9, 0\n"}
    for k, t in texts.items():
        (tmp_path / k).mkdir()
        lines = t.splitlines(keepends=True)
        for part in range(2):   # two compressed parts
            (tmp_path / k / f"part-{part}.txt.gz").write_bytes(gzip.compress("".join(lines[part * 2:part * 2 + 2] if part == 0 else lines[2:]).encode()))
    paths = {k: str(tmp_path / k) for k in texts}
    nodes, edges, _ = RD.read_graphs(spark, **paths, numbered=True)
    assert sorted((r.n, r.graph_id, r.label, r.node, r.x) for r in nodes.collect()) == [
        (1, 1, 7, 0, [1.5, 2.0]), (2, 1, 7, 1, [3.0, 4.0]), (3, 2, 8, 0, [5.0, 6.0]), (4, 2, 8, 1, [7.0, 8.0]), (5, 2, 8, 2, [9.0, 0.0])]
    assert sorted(map(tuple, edges.join(nodes.select("n"), "n").collect())) == [(1, 1), (2, 0), (3, 2), (4, 2)]
    plain, joined, graphs = RD.read_graphs(spark, **paths)
    assert sorted((r.graph_id, r.src, r.dst) for r in joined.collect()) == [(1, 0, 1), (1, 1, 0), (2, 0, 2), (2, 1, 2)]
    assert plain.count() == 5 and sorted(map(tuple, graphs.collect())) == [(1, 7), (2, 8)]
    numbers = RD.numbered_lines(spark, paths["attributes"])
    assert "SortMergeJoin" not in _plan(numbers) and "BroadcastHashJoin" in _plan(numbers)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" not in _plan(RD.numbered_lines(spark, paths["attributes"]))   # all lines moved to be numbered before
        files = q_sources._graph_files(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert all(f.endswith(".gz") for p in files.values() for f in spark.read.text(p).inputFiles())
