"""Findings of round 3 on growth: work and files that follow the input."""

import os
import re

from tessera.plans import fixtures as FX

TEXTS = [(1, None), (2, ""), (3, " \n\t\n"), (4, "abc\r\nabcdefgh\x0babcdefghi\x0cabcdefghij\x1cx y\u0085z zweiter wort"),
         (5, "Grüße-äöüäöü übermäßig \U0001f600\U0001f600\U0001f600\U0001f600\U0001f600\U0001f600\U0001f600\U0001f600 1234567"),
         (5, "a"), (6, "trailing longlonglong\n"), (7, "\n\nx\n \ny"), (8, "abcdefgh abcdefghi abcdefghij abcdefg abcdefghijk abcdefghijkl " * 40)]


def documents(spark, folder, rows=TEXTS):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def _spans(spans):
    spans = sorted(spans)
    rels = []
    for k in range(len(spans) - 1):
        head, tail = (k + 1, k) if (k + 1) % 3 == 0 else (k, k + 1)
        rels.append((FX.RELATION_TYPES_BY_DIST_MOD3[(spans[k + 1][0] - spans[k][0]) % 3], head, tail))
    return [(t, s, e) for s, e, t in spans], rels


def _expected(text):
    """The sentences of a text with both annotations, by loops."""
    kinds, no = FX.ENTITY_TYPES_BY_LEN_MOD4, 0
    for line in (text or "").split("\n"):
        toks = [t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t]
        if not toks:
            continue
        starts, gold, pred, at = [], [], [], 0
        for i, t in enumerate(toks):
            starts.append(at)
            at += len(t) + 1
            if len(t) >= 8:
                gold.append((i, i + 1, kinds[len(t) % 4]))
            if len(t) >= 9 and i + 1 < len(toks) and len(toks[i + 1]) >= 9:
                gold.append((i, i + 2, FX.PAIR_ENTITY_TYPE))
            if len(t) >= 7 and i % 7:
                kind = kinds[len(t) % 4]
                pred.append((i, i + 1, "gene" if kind == "disease" and i % 5 == 0 else kind))
        yield no, toks, starts, [s + len(t) for s, t in zip(starts, toks)], _spans(gold), _spans(pred)
        no += 1


def test_the_corpus_is_written_once_and_follows_its_rules(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FX, "CHUNK_BYTES", 64)   # several chunks, one of a single long document
    sf = documents(spark, tmp_path)
    plain = lambda rows: sorted((r.doc_id, r.sent_no, r.tokens, r.starts, r.ends, [tuple(e) for e in r.entities], [tuple(x) for x in r.relations])
                                for r in rows.collect())
    want = [(d, no, toks, s, e, g, p) for d, text in TEXTS for no, toks, s, e, g, p in _expected(text)]
    assert plain(FX.gold_docs(spark, sf)) == sorted((*x[:5], *x[5]) for x in want)
    assert plain(FX.pred_docs(spark, sf)) == sorted((*x[:5], *x[6]) for x in want)
    assert FX.sentences(spark, sf).columns == ["doc_id", "sent_no", "tokens", "starts", "ends"]
    folder = os.path.dirname(FX.gold_docs(spark, sf).inputFiles()[0])
    for docs in (FX.pred_docs(spark, sf), FX.sentences(spark, sf)):
        assert {os.path.dirname(f) for f in docs.inputFiles()} == {folder}


def test_pipe_lines_are_compressed_and_documents_meet_sentences_before_relations(spark, tmp_path, monkeypatch):
    from tessera.plans import q_sources
    made, real = [], q_sources._dir
    monkeypatch.setattr(q_sources, "_dir", lambda *at: made.append(real(*at)) or made[-1])
    sf = documents(spark, tmp_path)
    rows = q_sources.a6(spark, sf).collect()
    want = sum(len(g[1]) for *_, g, _ in _expected(TEXTS[-1][1]))
    assert [r.sentence for r in rows if r.doc == "8"] == [" ".join(TEXTS[-1][1].split())] * want
    written = sum(os.path.getsize(os.path.join(made[-1], f)) for f in os.listdir(made[-1]) if f.startswith("part-"))
    assert written * 20 < sum(len(r.sentence.encode()) for r in rows)


def test_a_column_corpus_is_read_without_an_exchange(spark, tmp_path):
    from tessera.sources import readers as RD
    token = lambda d, kind, i, t: "\t".join([d, kind, str(i), "O", "X", t, "O", "O", "O"])
    lines = [token("a", "Peop", 0, "J./COMMA/Doe"), token("a", "O", 1, "-LRB-"), token("a", "Loc", 2, "b/c"), "", "0\t2\tLive_In", "2\t7\tNo", "",
             "", "", token("b", "O", 0, "x/y"), "", "", token("c", "O", 0, "lost"), ""]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    got = RD.read_conll(spark, str(tmp_path))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = [(r.orig_id, r.tokens, [tuple(e) for e in r.entities], [tuple(x) for x in r.relations]) for r in got.collect()]
    assert rows == [("a", ["J.", ",", "Doe", "(", "b", "c"], [("Peop", 0, 3), ("Loc", 4, 6)], [("Live_In", 0, 1), ("No", 1, None)]), ("b", ["x/y"], [], [])]


def test_many_files_are_listed_by_a_task_a_folder(spark, tmp_path):
    from tessera.sources import readers as RD
    for k in range(200):
        folder = tmp_path / f"s{k % 4}" / "left"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"n {k}.csv").write_text("0 0\n")
    for hidden in (".n.csv", "_n.csv", "n.txt"):
        (tmp_path / "s0" / hidden).write_text("")
    got = RD.list_files(spark, str(tmp_path), "*.{csv,csv.gz}")
    assert got.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < 200   # one partition a few files before
    rows = got.collect()
    assert sorted(r.name for r in rows) == sorted(f"n {k}.csv" for k in range(200)) and {r.bytes for r in rows} == {4}
    assert {r.path for r in rows} == {f"file:{tmp_path}/s{k % 4}/left/n {k}.csv" for k in range(200)}


def test_a_last_document_without_its_second_blank_line_is_dropped(spark, tmp_path):
    from tessera.sources import readers as RD
    token = lambda d: "\t".join([d, "O", "0", "O", "X", d, "O", "O", "O"])
    for k, (end, whole) in enumerate([("\n", False), ("\n\n", False), ("\n\n\n", False), ("\n\n\n\n", True)]):
        (tmp_path / f"{k}.txt").write_text(token("a") + "\n\n\n" + token("b") + end)
        assert [r.orig_id for r in RD.read_conll(spark, str(tmp_path / f"{k}.txt")).collect()] == ["a", "b"][:1 + whole], end


def _exchanged(df):
    """The keys by which rows are dealt in the plan of ``df``."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.findall(r"(\w+)#", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]


def test_documents_are_dealt_whole(spark, tmp_path):
    from tessera.operators import joins as J
    from tessera.operators import metrics as M
    from tessera.operators import spans as S
    from tessera.plans import q_eval
    sf = documents(spark, tmp_path)
    g, p = q_eval._ents(spark, sf)
    value = ["start", "end", "type"]
    assert {tuple(k) for k in _exchanged(M.memberships(g, p, [*FX.DOC, *value]))} == {tuple(FX.DOC)}
    assert {tuple(k) for k in _exchanged(J.match_sets(g, p, [*FX.DOC, *value]))} == {tuple(FX.DOC)}
    lines = spark.createDataFrame([(1, "a b."), (2, "c ."), (3, "."), (4, "d")], "k long, line string")
    toks = S.tokenize(lines, "k", "line", detach_final_dot=True)
    assert _exchanged(toks) == [["k"]]
    assert sorted((r.k, r.tok_idx, r.token, r.char_start, r.char_end) for r in toks.collect()) == [
        (1, 0, "a", 0, 1), (1, 1, "b", 2, 3), (1, 2, ".", 3, 4), (2, 0, "c", 0, 1), (2, 1, ".", 1, 2), (4, 0, "d", 0, 1)]
    vec = spark.createDataFrame([(1, k, [float(k), -1.0]) for k in range(4)], "d long, pos int, vec array<double>")
    spans = spark.createDataFrame([(1, 0, 1, 3), (1, 1, 2, 2)], "d long, s int, start int, end int")
    pooled = S.span_max_pool(spans, S.dealt(vec, "d", "pos", "vec"), "d", "s", 2)
    assert sorted((r.s, r.vec) for r in pooled.collect()) == [(0, [2.0, -1.0]), (1, [0.0, 0.0])]


def test_pieces_of_a_glued_token_are_worked_out_once(spark):
    from pyspark.sql import functions as F

    from tessera.functions import text as X
    assert str(X.split_glued(F.col("z"))).count("split(") == 1
