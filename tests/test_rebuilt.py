"""Operators on made-up data against plain loops and numpy: long lines, long groups, long series, hot keys, files."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators import graph as GR
from tessera.operators import metrics as M
from tessera.operators import sequence as Q
from tessera.operators import spans as S
from tessera.operators import vectors as V
from tessera.operators.asof import asof_nearest, asof_nearest_small
from tessera.plans import fixtures as FX
from tessera.plans import registry
from tessera.session import checkpoint_dir
from tessera.sources import readers as RD
from tessera.sources import writers as WR
from tests.conftest import SF_SMALL

registry.load()
DOC = "tokens array<string>, entities array<struct<type:string,start:int,end:int>>, relations array<struct<type:string,head:int,tail:int>>"


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 300, 20_000])
def test_prefix_sums(spark, n):
    x = [i % 7 + 1 for i in range(n)]
    got = spark.createDataFrame([(x,)], "x array<int>").select(A.prefix_sums("x").alias("s")).first()["s"]
    assert got == np.cumsum(x).tolist()


def test_alignment_against_scan(spark):
    rng = np.random.default_rng(1)
    tokens, mentions = [], []
    for d in range(40):
        at = 0
        for i in range(int(rng.integers(0, 12))):
            at += int(rng.integers(0, 3))
            end = at + int(rng.integers(1, 5))
            tokens.append((d, i, at, end))
            at = end
        mentions += [(d, m, int(a), int(a + rng.integers(1, 9))) for m, a in enumerate(rng.integers(0, 25, 8))]
    got = S.align_spans(spark.createDataFrame(mentions, "d int, m int, char_start int, char_end int"),
                        spark.createDataFrame(tokens, "d int, tok_idx int, char_start int, char_end int"), "d", "m")
    want = set()
    for d, m, cs, ce in mentions:
        own = [t for t in tokens if t[0] == d]
        want.add((d, m, next((i for _, i, a, e in own if a <= cs < e), None), next((i + 1 for _, i, a, e in own if a < ce <= e), None)))
    assert set(map(tuple, got.collect())) == want


@pytest.fixture(scope="module")
def annotated(spark):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(30):
        tokens = [f"t{i}" for i in rng.integers(0, 6, int(rng.integers(1, 60)))]
        spans = sorted({(int(a), min(len(tokens), int(a) + int(k))) for a, k in zip(rng.integers(0, len(tokens), 9), rng.integers(1, 3, 9))})
        ents = [("x", a, e) for a, e in spans] + ([("y", *spans[0])] if d % 3 == 0 else [])
        rels = [("r", int(h), int(t)) for h, t in rng.integers(0, len(ents), (6, 2)) if h != t]
        rows.append((d, tokens, ents, rels))
    return rows, spark.createDataFrame(rows, f"d int, {DOC}")


def test_spans_and_pairs_against_loops(annotated):
    rows, docs = annotated
    spans, pairs, cands = [], [], []
    for d, tokens, ents, rels in rows:
        n = len(tokens)
        gold = {(s, e) for _, s, e in ents}
        spans += [(d, a, a + k, k) for k in range(1, 5) for a in range(n - k + 1) if (a, a + k) not in gold]
        linked = {(ents[h][1:], ents[t][1:]) for _, h, t in rels}
        pairs += [(d, *a[1:], *b[1:]) for a in ents for b in ents if a[1:] != b[1:] and (a[1:], b[1:]) not in linked]
        cands += [(d, i, j) for i in range(len(ents)) for j in range(len(ents)) if i != j]
    assert sorted(map(tuple, S.negative_spans(docs, "d", 4).collect())) == sorted(spans)
    assert sorted(map(tuple, S.negative_pairs(docs, "d").collect())) == sorted(pairs)
    assert sorted(map(tuple, S.candidate_pairs(docs, "d").collect())) == sorted(cands)


def test_pairs_of_a_long_line_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_PAIRS", 30_000)
    n, block = 700, 64
    rows = spark.range(n).select(F.lit(1).alias("d"), F.col("id").cast("int").alias("i"))
    p = S.ordered_pairs(rows, "d", "i", ["i"], ["i"], block)
    assert p.count() == n * n and p.select("l.i", "r.i").distinct().count() == n * n
    parts = p.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < n * n / 2


def test_phrases_against_scan(annotated):
    rows, docs = annotated
    phrases = S.to_mentions(docs, "d", with_tokens=True).select("d", "ent_idx", (F.col("end") - F.col("start")).alias("size"), S.phrase("tokens", "start", "end").alias("phrase"))
    got = sorted((r["d"], r["ent_idx"], r["occ"]) for r in S.find_phrases(docs, phrases, "d").collect())
    want = [(d, i, o) for d, tokens, ents, _ in rows for i, (_, s, e) in enumerate(ents) for o in range(len(tokens)) if tokens[o:o + e - s] == tokens[s:e]]
    assert got == sorted(want)


def test_repeated_lines_take_the_next_pair(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a", "b", "c", "a"])], "d int, tokens array<string>")
    # a at 0-1, 4-5, 10-11; b at 2-3, 6-7: gap 1 twice, gap 5 once; the third line of gap 1 has no pair left
    lines = [(1, n, ["a"], ["b"], g) for n, g in enumerate([1, 1, 1, 5, -4])]
    got = S.match_pairs(spark.createDataFrame(lines, "d int, line_no int, head_toks array<string>, tail_toks array<string>, gap int"), docs, "d")
    assert {r["line_no"]: (r["head_start"], r["tail_start"]) for r in got.collect()} == {0: (0, 1), 1: (2, 3), 2: (None, None), 3: (0, 3), 4: (None, None)}


def _greedy(word, vocab):
    at, out = 0, []
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocab:
                break
        else:
            return ["[UNK]"]
        out.append(piece)
        at = end
    return out or ["[UNK]"]


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_subwords_against_greedy_search(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(S, "BROADCAST_PIECES", broadcast)
    rng = np.random.default_rng(4)
    pieces = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "a", "b", "ab", "abc", "##a", "##b", "##bc", "##cab", "é", "##é", "c"]
    (tmp_path / "vocab.txt").write_text("\n".join(pieces) + "\n")
    vocab = RD.read_vocab(spark, str(tmp_path / "vocab.txt"))
    assert [r["piece"] for r in vocab.orderBy("idx").collect()] == pieces
    words = ["".join(rng.choice(list("abcé"), int(rng.integers(0, 9)))) for _ in range(300)] + ["x", "", "a" * 101, "ab" * 50]
    tokens = spark.createDataFrame([(i // 7, i % 7, w) for i, w in enumerate(words)], "d int, tok_idx int, token string")
    got = S.encode_subwords(tokens, vocab, "d").orderBy("d", "tok_idx").collect()
    at, last = 1, None
    for r, w in zip(got, words):
        at = 1 if r["d"] != last else at
        want = _greedy(w, set(pieces)) if len(w) <= S.WORD_CHARS else ["[UNK]"]
        assert r["pieces"] == want and r["ids"] == [pieces.index(p) for p in want] and (r["sub_start"], r["sub_end"]) == (at, at + len(want)), w
        at, last = at + len(want), r["d"]
    enc = {r["d"]: r["encoding"] for r in S.encodings(S.encode_subwords(tokens, vocab, "d"), vocab, "d").collect()}
    assert enc[0] == [2, *(i for r in got if r["d"] == 0 for i in r["ids"]), 3]


def _softmax(z):
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _attend(q, k, v, causal=False):
    s = q @ k.T / np.sqrt(q.shape[1])
    if causal:
        s = np.where(np.arange(len(k))[None, :] > np.arange(len(q))[:, None], -1e9, s)
    return _softmax(s) @ v


@pytest.mark.parametrize("causal", [False, True])
def test_attention_of_a_long_group(spark, causal):
    rng = np.random.default_rng(6)
    n = {"long": 5000, "one": 1, "short": 37}
    x = {g: rng.normal(size=(k, 16)) * 2 for g, k in n.items()}
    df = spark.createDataFrame([(g, i, r.tolist()) for g, m in x.items() for i, r in enumerate(m)], "g string, i int, x array<double>")
    got = V.attention(df, df, df, "g", "i", "x", causal=causal, block=300).collect()
    assert len(got) == sum(n.values())
    want = {g: _attend(m, m, m, causal) for g, m in x.items()}
    assert max(np.abs(np.array(r["out"]) - want[r["g"]][r["i"]]).max() for r in got) < 1e-9
    assert max(abs(r["p_sum"] - 1) for r in got) < 1e-9


def test_multi_head_against_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 12))
    heads = [tuple(rng.normal(size=(4, 12)).tolist() for _ in range(3)) for _ in range(3)]
    out = rng.normal(size=(5, 12)).tolist()
    df = spark.createDataFrame([(1, i, r.tolist()) for i, r in enumerate(x)], "g int, i int, x array<double>")
    got = np.array([r["y"] for r in V.multi_head(df, "g", "i", "x", heads, out).orderBy("i").collect()])
    want = np.concatenate([_attend(*(x @ np.array(w).T for w in h)) for h in heads], axis=1) @ np.array(out).T
    assert np.allclose(got, want)


def test_pooling_reads_all_dimensions(spark):
    df = spark.createDataFrame([("a", [1.0, 5.0, -2.0]), ("a", [3.0, 1.0, -4.0]), ("b", [0.0, 0.0, 7.0])], "g string, x array<double>")
    got = {(r["g"], r["d"]): (r["max"], r["mean"]) for r in V.pool(df, ["g"], "x").collect()}
    assert got[("a", 1)] == (5.0, 3.0) and got[("a", 2)] == (-2.0, -3.0) and got[("b", 2)] == (7.0, 7.0) and len(got) == 6


def _params(rng, n, m, k):
    return {"Waa": rng.normal(size=(n, n)) / 2, "Wax": rng.normal(size=(n, m)), "ba": rng.normal(size=n), "Wya": rng.normal(size=(k, n)), "by": rng.normal(size=k)}


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_scans_against_loops(spark, batch):
    rng = np.random.default_rng(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)  # states are carried over the cuts
    try:
        x = {s: rng.normal(size=(k, 2)) for s, k in {"a": 25, "b": 1, "c": 60}.items()}
        df = spark.createDataFrame([(s, t, r.tolist()) for s, m in x.items() for t, r in enumerate(m)], "s string, t int, x array<double>")
        p = _params(rng, 4, 2, 3)
        got = {(r["s"], r["step"]): r for r in Q.rnn_scan(df, ["s"], ["t"], "x", p).collect()}
        for s, m in x.items():
            a = np.zeros(4)
            for t, row in enumerate(m):
                a = np.tanh(p["Waa"] @ a + p["Wax"] @ row + p["ba"])
                assert np.allclose(got[s, t]["a"], a) and np.allclose(got[s, t]["y"], _softmax(p["Wya"] @ a + p["by"]))
        w = {k: rng.normal(size=(4, 6)) for k in ("Wf", "Wi", "Wc", "Wo")} | {k: rng.normal(size=4) for k in ("bf", "bi", "bc", "bo")} | {"Wy": rng.normal(size=(3, 4)), "by": rng.normal(size=3)}
        got = {(r["s"], r["step"]): r for r in Q.lstm_scan(df, ["s"], ["t"], "x", w).collect()}
        sig = lambda z: 1 / (1 + np.exp(-z))
        for s, m in x.items():
            a, c = np.zeros(4), np.zeros(4)
            for t, row in enumerate(m):
                ax = np.concatenate([a, row])
                f, i, o = (sig(w["W" + g] @ ax + w["b" + g]) for g in "fio")
                c = f * c + i * np.tanh(w["Wc"] @ ax + w["bc"])
                a = o * np.tanh(c)
                r = got[s, t]
                assert np.allclose(r["a"], a) and np.allclose(r["c"], c) and np.allclose(r["y"], _softmax(w["Wy"] @ a + w["by"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_hand_worked_rnn_and_a_long_series(spark):
    one = {"Waa": [[0.5]], "Wax": [[1.0]], "ba": [0.0], "Wya": [[1.0], [-1.0]], "by": [0.0, 0.0]}
    df = spark.createDataFrame([(0, 0, [1.0]), (0, 1, [0.0])], "s int, t int, x array<double>")
    got = [(r["a"][0], r["y"][0]) for r in Q.rnn_scan(df, ["s"], ["t"], "x", one).orderBy("step").collect()]
    a0 = np.tanh(1.0)
    a1 = np.tanh(0.5 * a0)
    assert np.allclose(got, [(a0, 1 / (1 + np.exp(-2 * a0))), (a1, 1 / (1 + np.exp(-2 * a1)))])
    n = 100_000
    long = spark.range(n).select(F.lit(1).alias("s"), F.col("id").alias("t"), F.array((F.col("id") % 5 - 2).cast("double")).alias("x"))
    last = Q.rnn_scan(long, ["s"], ["t"], "x", one).filter(F.col("step") == n - 1).first()
    a = 0.0
    for t in range(n):
        a = np.tanh(0.5 * a + t % 5 - 2)
    assert np.isclose(last["a"][0], a)


def test_moments_against_a_loop(spark):
    rng = np.random.default_rng(10)
    g = rng.normal(size=40)
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(g)], "s int, t int, g double")
    r = Q.ewma(df, ["s"], ["t"], "g").first()
    m = v = 0.0
    for x in g:
        m, v = 0.9 * m + 0.1 * x, 0.999 * v + 0.001 * x * x
    assert np.isclose(r["m_hat"], m / (1 - 0.9**40)) and np.isclose(r["v_hat"], v / (1 - 0.999**40))


def test_vocabulary_leaves_no_token_out(spark):
    df = spark.createDataFrame([(t,) for t in ["7", "add", "zebra", "apple", "7", None, "BOS"]], "token string")
    assert {r["token"]: r["idx"] for r in Q.build_vocab(df).collect()} == {"7": 7, "add": 12, "BOS": 14, "apple": 16, "zebra": 17}


@pytest.mark.parametrize("largest", [0, 10**6])
def test_propagation_against_matrices(spark, largest):
    rng = np.random.default_rng(11)
    weights = [rng.normal(size=(3, 2)).tolist(), rng.normal(size=(2, 3)).tolist()]
    nodes, edges, want = [], [], {}
    for g in range(12):
        n = int(rng.integers(1, 9))
        x = rng.normal(size=(n, 2))
        a = np.triu(rng.random((n, n)) < 0.4, 1)
        a = (a | a.T).astype(float)
        edges += [(g, int(i), int(j)) for i, j in np.argwhere(a)]
        nodes += [(g, i, r.tolist()) for i, r in enumerate(x)]
        hat = a + np.eye(n)
        d = hat.sum(axis=0) ** -0.5
        hat = d[:, None] * hat * d[None, :]
        for w in weights:
            x = np.maximum(hat @ (x @ np.array(w).T), 0)
        want |= {(g, i): r for i, r in enumerate(x)}
    got = GR.propagate(spark.createDataFrame(nodes, "graph_id int, node int, x array<double>"), spark.createDataFrame(edges, "graph_id int, src int, dst int"), weights, largest=largest)
    rows = got.collect()
    assert len(rows) == len(want) and all(np.allclose(r["x"], want[r["graph_id"], r["node"]]) for r in rows)


def _exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line.strip(" :+-*()0123456789") for line in plan.split("\n")]


def test_hops_share_one_partitioning(spark):
    plan = _exchanges(registry.QUERIES["h10_propagate"](spark, SF_SMALL))
    shuffles = [line for line in plan if line.startswith("Exchange")]
    assert len(shuffles) <= 2 and all("REPARTITION_BY_NUM" in line for line in shuffles)   # the table of both, wide for values and narrow for links


def test_reports_scan_each_side_once(spark):
    for name in ("e7_prf_report", "e27_eval_row"):
        plan = _exchanges(registry.QUERIES[name](spark, SF_SMALL))
        assert sum(line.startswith("FileScan") for line in plan) == 2, name


def test_masked_losses_by_hand(spark):
    df = spark.createDataFrame([("a", [0.0, 2.0], [0.0, 1.0], True), ("a", [50.0, -50.0], [0.0, 0.0], False), ("b", [1.0, 1.0], [1.0, 0.0], False)],
                               "b string, x array<double>, y array<double>, m boolean")
    got = {r["b"]: (r["rel_loss"], r["n_rel_loss"]) for r in M.masked_bce(df, "x", "y", "m", ["b"]).collect()}
    assert np.isclose(got["a"][0], (np.log(2) + np.log1p(np.exp(-2))) / 2) and got["a"][1] == 1 and got["b"] == (None, 0)
    ents = spark.createDataFrame([("a", 1.5), ("b", 0.5), ("c", 2.0)], "b string, entity_loss double")
    joint = {r["b"]: r["train_loss"] for r in M.joint_loss(ents, M.masked_bce(df, "x", "y", "m", ["b"]), ["b"]).collect()}
    assert np.isclose(joint["a"], 1.5 + got["a"][0]) and joint["b"] == 0.5 and joint["c"] == 2.0


def test_graph_files_of_several_parts(spark, tmp_path):
    def put(name, *parts):
        (tmp_path / name).mkdir()
        for i, p in enumerate(parts):
            (tmp_path / name / f"part-{i}.txt").write_text(p)

    put("indicator", "1\n1\n", "2\n", "1\n2\n")
    put("attributes", "0.5, 1\n1, 2\n1, 3\n", "1, 4\n1, 5\n")
    put("labels", "7\n-1\n")
    put("edges", "1, 4\n5, 3\n", "2, 1\n")
    nodes, edges, graphs = RD.read_graphs(spark, *(str(tmp_path / k) for k in ("edges", "indicator", "labels", "attributes")))
    assert sorted(map(tuple, nodes.collect())) == [(1, 0, [0.5, 1.0]), (1, 1, [1.0, 2.0]), (1, 2, [1.0, 4.0]), (2, 0, [1.0, 3.0]), (2, 1, [1.0, 5.0])]
    assert sorted(map(tuple, edges.collect())) == [(1, 0, 2), (1, 1, 0), (2, 1, 0)]
    assert sorted(map(tuple, graphs.collect())) == [(1, 7), (2, -1)]
    assert tuple(RD.graph_counts(nodes, edges, graphs).first()) == (2, 5, 3)
    (tmp_path / "long").mkdir()
    (tmp_path / "long" / "a.txt").write_text("".join(f"{i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert RD.numbered_lines(spark, str(tmp_path / "long")).filter("line_no <> cast(value as long)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_listed_by_their_names(spark):
    p = RD.new_folder(spark, SF_SMALL, "list")
    names = ["x/001_S_0001__2020-01-02__T1.5.csv", "x/y/001_S_0001__2020-01-02__T1.5.csv.gz", "002_S_0002__2020-01-02__a b+c%.csv", "notes.txt", "x/plain.csv"]
    assert WR.write_named_files(spark.createDataFrame([(n, "1 2\n") for n in names], "name string, value string"), f"file://{p}" if p.startswith("/") else p) == 5
    got = sorted(r["name"] for r in RD.list_files(spark, p, "*.{csv,csv.gz}").collect())
    assert got == sorted(n.rsplit("/", 1)[-1] for n in names if ".csv" in n)
    assert spark.read.text(f"{p}/x/y").collect()[0][0] == "1 2"   # compressed, and read as such


def test_matrices_of_one_file(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# a\n1 2\n\n 3  4 \n# b\n5 6\n")
    (tmp_path / "n.txt").write_text("7 8\n9 10\n")
    got = sorted(((r["file"][-5:], r["name"], r["row"]), r["values"]) for r in RD.read_matrix(spark, str(tmp_path)).filter("name is not null").collect())
    assert got == [(("m.txt", "a", 0), [1.0, 2.0]), (("m.txt", "a", 1), [3.0, 4.0]), (("m.txt", "b", 0), [5.0, 6.0])]
    assert sorted((r["row"], r["values"]) for r in RD.read_matrix(spark, str(tmp_path / "n.txt")).collect()) == [(0, [7.0, 8.0]), (1, [9.0, 10.0])]


def test_inputs_of_one_name_do_not_meet(spark, tmp_path):
    for side, n in (("a", 10), ("b", 20)):
        (tmp_path / side / "data").mkdir(parents=True)
        spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") * 3).alias("user_id"), F.lit(side).alias("event_type")).write.parquet(str(tmp_path / side / "data" / "events.parquet"))
    one, two = (registry.QUERIES["a4_read_jsonl"](spark, str(tmp_path / s / "data")) for s in ("a", "b"))
    assert one.count() == 10 and two.count() == 20 and one.select("event_type").distinct().first()[0] == "a"


def test_derived_tables_follow_their_inputs(spark, tmp_path):
    def put(text):
        spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        return [r["tokens"] for r in FX.sentences(spark, str(tmp_path)).collect()]

    assert put("one two") == [["one", "two"]]
    assert put("three four five and more") == [["three", "four", "five", "and", "more"]]
    assert checkpoint_dir(spark)


def test_a_hot_day_spreads(spark):
    rng = np.random.default_rng(12)
    day = dt.datetime(2024, 5, 1)
    us = lambda n: day + dt.timedelta(microseconds=int(n))
    hot = rng.integers(0, 3600 * 10**6, 400)   # one key, one hour of one day
    left = [(i, "hot", us(t)) for i, t in enumerate(hot)] + [(1000 + i, "hot", us(hot[0])) for i in range(300)]
    left += [(5000 + i, f"k{i % 5}", us(t)) for i, t in enumerate(rng.integers(-9 * 10**11, 9 * 10**11, 300))] + [(9000, None, us(0)), (9001, "hot", None)]
    right = [(i, "hot", us(t)) for i, t in enumerate(rng.integers(-10**6, 3600 * 10**6, 300))] + [(1000 + i, "hot", us(hot[0] + 5)) for i in range(200)]
    right += [(5000 + i, f"k{i % 6}", us(t)) for i, t in enumerate(rng.integers(-9 * 10**11, 9 * 10**11, 200))]
    L = spark.createDataFrame(left, "lid int, k string, ts timestamp")
    R = spark.createDataFrame(right, "rid int, k string, ts timestamp").select("rid", "k", "ts")
    got = asof_nearest(L, R, ["k"], "ts", ["rid"], tie="rid", bucket_rows=20)
    want = asof_nearest_small(L, R, ["k"], "ts", ["rid"], tie="rid")
    assert sorted(map(str, got.select("lid", "rid", "delta").collect())) == sorted(map(str, want.select("lid", "rid", "delta").collect()))
    from tessera.operators import asof
    points = L.select("k", asof.ordinal(L, "ts").alias("_o")).unionByName(R.select("k", asof.ordinal(R, "ts").alias("_o"))).filter("k = 'hot' and _o is not null").distinct()
    widths = asof._widths(points, ["k"], asof.DAY_US, 20)
    parts = asof._bucket(points, ["k"], asof.DAY_US, widths).groupBy("_b").count().collect()
    assert len(parts) > 30 and max(r["count"] for r in parts) <= 20
    assert asof._widths(points, ["k"], asof.DAY_US, 10**6) is None


def _fitted(spark):
    from tessera.operators import ml as ML
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 4))
    y = (x @ rng.normal(size=(4, 3))).argmax(axis=1)
    y[:40] = rng.integers(0, 3, 40)
    df = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "vec_id long, embedding array<double>, label int")
    return ML, x, y, ML.features(df, "embedding", "label"), df


def test_softmax_fit_is_at_the_optimum(spark):
    ML, x, y, f, df = _fitted(spark)
    model = ML.fit_softmax(f, max_iter=200, reg=0.01)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    p = _softmax(x @ w.T + b)
    got = {r["vec_id"]: r for r in ML.score(model, f, "vec_id").collect()}
    assert all(np.allclose(got[i]["prob"], p[i]) and got[i]["y_pred"] == p[i].argmax() and np.isclose(got[i]["p_max"], p[i].max()) for i in range(len(x)))
    # the penalty is on weights of standardised features: gradient of the mean loss = -reg * w * sd^2
    grad = (p - np.eye(3)[y]).T @ x / len(x)
    assert np.abs(grad + 0.01 * w * x.std(axis=0, ddof=1) ** 2).max() < 2e-3 and np.abs((p - np.eye(3)[y]).mean(axis=0)).max() < 1e-3


def test_mlp_scores_are_its_layers(spark):
    ML, x, y, f, _ = _fitted(spark)
    model = ML.fit_mlp(f, [4, 5, 3], max_iter=60)
    w = model.weights.toArray()
    w1, b1, w2, b2 = w[:20].reshape((5, 4), order="F"), w[20:25], w[25:40].reshape((3, 5), order="F"), w[40:]
    p = _softmax(1 / (1 + np.exp(-(x @ w1.T + b1))) @ w2.T + b2)
    got = {r["vec_id"]: r["prob"] for r in ML.score(model, f, "vec_id").collect()}
    assert max(np.abs(np.array(got[i]) - p[i]).max() for i in range(len(x))) < 1e-6
    assert (p.argmax(axis=1) == y).mean() > 0.75


def test_model_queries_hold_their_reports(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", F.col("label").cast("int").alias("y")).collect()
    truth = {r["vec_id"]: r["y"] for r in e}
    for name, model in (("i1_fit_softmax", "softmax"), ("i2_fit_mlp", "mlp")):
        rows = registry.QUERIES[name](spark, SF_SMALL).collect()
        assert sorted(r["vec_id"] for r in rows) == sorted(v for v in truth if v % 2 == 0) and all(r["y_true"] == truth[r["vec_id"]] for r in rows)
        acc = np.mean([r["y_true"] == r["y_pred"] for r in rows])
        rep = {r["label"]: r for r in registry.QUERIES["i4_compare_models"](spark, SF_SMALL).filter(F.col("model") == model).collect()}
        assert np.isclose(rep["accuracy"]["precision"], acc) and rep["accuracy"]["support"] == len(rows)
    scored = registry.QUERIES["i3_score"](spark, SF_SMALL).collect()
    assert all(0 < r["p_max"] <= 1 and r["n_classes"] >= 2 for r in scored) and len(scored) == sum(v % 2 == 0 for v in truth)
    transfer = {r["corpus"]: r["accuracy"] for r in registry.QUERIES["i5_transfer_eval"](spark, SF_SMALL).collect()}
    assert set(transfer) == {"A", "B"} and all(0 <= v <= 1 for v in transfer.values())
