"""Queries on the driver's small tables against brute force and held-out rows; pages of layouts that the fit has not seen."""

import itertools
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_documents import _slow_components

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"

SAID = ["The ferry left the harbour an hour before dawn, with only nine people on board.", "Nobody spoke while the lights of the town sank behind the water.",
        "By noon the wind had turned, and the captain changed course twice to keep the swell behind them.",
        "A child asked whether the island had any trees, and an old man laughed.", "He said there had been trees once, before the war took them for the mines.",
        "When they landed the road was wet and the houses were shut.", "Somebody had left bread on the wall near the church, still warm.",
        "They ate it standing up, and that was the first day."]
PROSE = "".join(f"<p>{x}</p>" for x in SAID)
#: Whole pages by hand: none of them comes from the generator that the trees are fitted on.
LAYOUTS = {
    "heading": f"<h1>The island</h1>{PROSE}", "two paragraphs": "".join(f"<p>{x}</p>" for x in SAID[:2]), "paragraphs": PROSE, "many paragraphs": PROSE * 4,
    "plain blocks": f"<div><div>{PROSE}</div></div>", "table": f"<table><tr><td>{PROSE}</td></tr></table>",
    "newsletter": f'<article class="newsletter-post">{PROSE}</article>', "category of comments": f'<article class="post category-comments">{PROSE}</article>',
    "article": f"<article>{PROSE}</article>", "content": f'<div id="content">{PROSE}</div>',
    "menu cell": f'<table><tr><td><ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul></td><td>{PROSE}</td></tr></table><p>&copy; 2024 Some Company</p>',
    "side bar": f'<div class="header"><a href=/>Site</a></div><div>{PROSE}</div><div class="sidebar"><h3>Related</h3><ul><li><a href=1>Other story</a></li></ul></div><footer>(c) 2020</footer>',
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_pages_of_other_layouts(name):
    from tessera.llm.extraction import main_texts, trained
    got = main_texts([f"<html><body>{LAYOUTS[name]}</body></html>"], trained())[0].split("\n")
    want = [x for x in SAID if x in LAYOUTS[name]]
    assert [x for x in want if x not in got] == []
    assert [x for x in got if x not in SAID and x != "The island"] == []


def test_pages_without_a_text_have_none():
    from tessera.llm.extraction import main_texts, trained
    page = "<body><nav><ul><li><a href=1>Home</a></li></ul></nav><form><label>Mail</label><input></form><footer>&copy; 2024 All rights reserved.</footer></body>"
    assert main_texts([page, "", None, "<p>"], trained()) == ["", "", "", ""]


def test_decoding_against_all_labellings():
    from tessera.llm.dom import nodes_of, parse
    from tessera.llm.extraction import decode
    rng = np.random.default_rng(2)
    for page in ("<div><p>a</p><p>b</p></div><div>c</div>", "<ul><li>a<li>b<ul><li>c</ul></ul>", "<div><div><div>a</div>b</div>c</div>d"):
        nodes = nodes_of(parse(page))
        place = {id(n): i for i, n in enumerate(nodes)}
        up = [place[id(n.parent)] if n.parent is not None else -1 for n in nodes]
        for _ in range(40):
            margin = rng.normal(size=len(nodes)) * 2
            best = max((sum(m for m, k in zip(margin, labels) if k), labels) for labels in itertools.product([False, True], repeat=len(nodes))
                       if labels[0] and all(not k or i == 0 or labels[up[i]] for i, k in enumerate(labels)))
            assert decode(nodes, margin) == list(best[1])


@pytest.mark.parametrize("unit", ["x <button>b</button>", "<div>", "<div><p>a</p></div>", "<p>a <b>b</b>"])
def test_time_grows_with_the_page(unit):
    from tessera.llm.extraction import main_texts, trained
    model, took = trained(), []
    for n in (2000, 16_000):
        t = time.process_time()
        main_texts([unit * n], model)
        took.append(time.process_time() - t)
    assert took[1] < 20 * max(took[0], 0.05)


def test_languages_of_held_out_documents(spark):
    from tessera.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op8_language"](spark, SF).filter("held_out").join(docs, "doc_id").filter("lang is not null and lang_pred <> 'und'").collect()
    assert len(got) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97


def test_quality_of_held_out_documents(spark):
    from tessera.llm.queries import QUERIES
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op9_quality"](spark, SF).filter("held_out").join(labels, "doc_id").filter("quality is not null").collect()
    assert len(got) > 50 and np.mean([r["quality"] == r["predicted"] for r in got]) >= 0.95


def test_shards_are_even(spark):
    from tessera.llm.queries import QUERIES
    rows = QUERIES["op10_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    size, of = Counter(), defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["size"]
        of[texts[r["doc_id"]]].add(r["shard"])
    groups = Counter()
    for r in rows:
        groups[texts[r["doc_id"]]] += r["size"]
    assert len(rows) == len(texts) and all(len(s) == 1 for s in of.values()) and sorted(size) == list(range(16))
    assert max(size.values()) - min(size.values()) <= max(0.005 * np.mean(list(size.values())), max(groups.values()))


def test_bins_are_as_few_as_by_first_fit(spark):
    from tessera.llm.queries import QUERIES
    rows = QUERIES["op2_packing"](spark, SF).collect()
    ends: dict = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048
    pieces = sorted((r["length"] for r in rows), reverse=True)
    bins: list = []
    for p in pieces:
        at = next((i for i, b in enumerate(bins) if b + p <= 2048), None)
        if at is None:
            bins.append(p)
        else:
            bins[at] += p
    assert len(ends) <= len(bins) + 8


def test_pipeline_against_brute_force(spark, odd, empty):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from tessera.llm.common import materialize
    from tessera.llm.language import LEAST_SCORE, identify, keep_known
    from tessera.llm.mixing import mix, taken
    from tessera.llm.packing import tokenizer_path
    from tessera.llm.quality import score
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "language", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, now, SMALL), f"test-{name}")
        assert out.columns == docs.columns
        seen[name] = now, out
        now = out
    good = {r["doc_id"] for r in score(docs, labels).filter("score >= 0.7").collect()}
    assert {r["doc_id"] for r in seen["quality"][1].collect()} == good
    told = {r["doc_id"]: r for r in identify(seen["language"][0]).collect()}
    assert {r["doc_id"] for r in seen["language"][1].collect()} == {d for d, r in told.items() if r["lang_pred"] != "und" and r["score"] >= LEAST_SCORE}
    sure = keep_known(seen["language"][0], least_score=0.998).collect()
    assert {r["doc_id"] for r in sure} == {d for d, r in told.items() if r["lang_pred"] != "und" and r["score"] >= 0.998} and 0 < len(sure) < len(told)
    rows = sorted(seen["near_dedup"][0].collect(), key=lambda r: r["doc_id"])
    first = _slow_components([r["text"] for r in rows])
    assert {r["doc_id"] for r in seen["near_dedup"][1].collect()} == {rows[i]["doc_id"] for i, c in enumerate(first) if c == i}
    size = {r["doc_id"]: (r["size"], r["taken"]) for r in taken(*mix(seen["mixing"][0])).collect()}
    copies = Counter(r["doc_id"] for r in seen["mixing"][1].collect())
    assert all(n <= 2 for n in copies.values()) and set(copies) <= set(size)
    assert abs(sum(size[d][0] * n for d, n in copies.items()) - sum(t for _, t in size.values())) <= 0.05 * sum(t for _, t in size.values())
    pieces = stages["packing"](spark, now, SMALL).collect()
    t = Tokenizer.from_file(tokenizer_path())
    texts = [r["text"] or "" for r in now.select("text").collect()]
    assert sum(r["length"] for r in pieces) == sum(len(e.ids) + 1 for e in t.encode_batch_fast(texts, add_special_tokens=False))
    # odd rows and an empty table pass through every stage
    for frame in (odd, empty):
        now = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = materialize(stage(spark, now, SMALL), f"test-odd-{name}")
            assert now.columns == frame.columns
        assert stages["packing"](spark, now, SMALL).filter(F.col("length") < 1).count() == 0
