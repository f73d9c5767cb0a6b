"""The derived sentences hold every token of every text, and per-document results have every document."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import fixtures as FX
from tessera.plans import q_sources, registry
from tessera.session import table
from tests.conftest import SF_SMALL

registry.load()


def test_sentences_hold_all_tokens_in_order(spark):
    want = {r.doc_id: r.text.split() for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect() if r.text and r.text.split()}
    got: dict = {}
    for r in FX.sentences(spark, SF_SMALL).orderBy(*FX.DOC).collect():
        assert len(r.tokens) >= 1 and len(r.tokens) == len(r.starts) == len(r.ends)
        got.setdefault(r.doc_id, []).extend(r.tokens)
    assert got == want


def test_a_sentence_is_a_whole_line(spark):
    lines = [line.split() for r in table(spark, SF_SMALL, "documents").select("text").collect() for line in (r.text or "").split("\n")]
    assert sorted(r.tokens for r in FX.sentences(spark, SF_SMALL).collect()) == sorted(ws for ws in lines if ws)
    assert max(map(len, lines)) > 64
    pairs = sum(m * (m - 1) for m in (sum(len(t) >= 8 for t in ws) for ws in lines))
    from tessera.operators.spans import candidate_pairs
    single = FX.gold_docs(spark, SF_SMALL).withColumn("entities", F.filter("entities", lambda e: e["end"] - e["start"] == 1))
    assert candidate_pairs(single, FX.DOC).count() == pairs


def test_every_sentence_has_a_result(spark):
    n = FX.sentences(spark, SF_SMALL).count()
    for name in ("e9_doc_examples", "d13_set_mismatch", "f9_has_overlap", "c29_to_docs"):
        assert registry.QUERIES[name](spark, SF_SMALL).count() == n, name
    full = registry.QUERIES["e9_doc_examples"](spark, SF_SMALL).filter("n_tp + n_fn + n_fp = 0")
    assert full.count() > 0 and full.filter(F.least("precision", "recall", "f1") < 100).isEmpty()


@pytest.mark.parametrize("name, size", [("a1_read_docs", 8192), ("a2_read_split_docs", 8192), ("a5_read_conll", 8192), ("a14_read_parallel", 512)])
def test_files_follow_the_data(spark, monkeypatch, name, size):
    made, real = [], q_sources._dir
    monkeypatch.setattr(q_sources, "_dir", lambda *at: made.append(real(*at)) or made[-1])

    def read():
        got = sorted(map(tuple, registry.QUERIES[name](spark, SF_SMALL).collect()))
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(made[-1]).filter("length > 0").select("length").collect()
        return got, [f["length"] for f in files]

    want, _ = read()
    monkeypatch.setattr(q_sources.WR, "FILE_BYTES", size)
    got, sizes = read()
    assert got == want and len(sizes) > 16
    assert max(sizes) < 8 * size or name == "a1_read_docs" and sum(n > 8 * size for n in sizes) < len(sizes) / 10   # one document may be longer than a file


def test_smoothing_takes_its_classes_from_the_data(spark, monkeypatch):
    from tessera.operators import metrics as M
    logits = [[0.0, 1.0, 2.0, 0.5] * 3, [1.0] * 12]   # 12 classes
    cp = spark.createDataFrame([(0, 11, logits[0]), (1, 0, logits[1])], "vec_id long, y_true int, logits array<double>")
    monkeypatch.setattr(FX, "class_preds", lambda *_: cp)
    got = registry.QUERIES["e20_label_smoothing_loss"](spark, SF_SMALL).first()["loss"]
    assert abs(got - M.label_smoothing_loss(cp, "logits", "y_true", 0.1, 12).first()["loss"]) < 1e-5
