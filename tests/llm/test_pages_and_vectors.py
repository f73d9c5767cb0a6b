"""Page extraction and neighbour search: planted pages, odd rows, recall against brute force."""

import numpy as np

PAGE = """<html><head><title>No</title></head><body><div class="cookie-notice"><p>We use cookies, accept them all.</p></div>
<header><div class="logo">Site</div><nav><ul><li><a href="/">Home</a></li></ul></nav></header>
<div id="main"><article class="post"><h1>A &amp; B</h1><p>First <b>bold</b>
 words of&nbsp;the story, which go on for a while.</p><div class="ad">Buy now cheap things</div><ul><li>one item<li>two items</ul></article>
<aside class="sidebar"><h3>More</h3><p>Other stories that may please you, too.</p></aside></div>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this story very much, thank you.</p></div></section>
<form><label>Mail</label><input></form><footer>&copy; 2024</footer><script>var x = "</p>";</script></body></html>"""


def test_extraction(spark):
    from tessera.llm.extraction import extract
    pages = spark.createDataFrame([(1, "u", PAGE), (None, None, None), (2, "u", ""), (3, "u", "<p>"), (1, "u", PAGE), (4, "u", "<b" * 5000)], "page_id long, url string, html string")
    got = extract(pages.selectExpr("*", "'x' as text", "'y' as n_chars")).collect()
    first = [r for r in got if r["page_id"] == 1]
    assert [r["text"] for r in first] == ["A & B\nFirst bold words of the story, which go on for a while.\none item\ntwo items"] * 2
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == 6
    assert {r["text"] for r in got if r["page_id"] in (None, 2, 3)} == {""}
    assert extract(pages.limit(0)).count() == 0


def test_controls_and_media_neither_hide_nor_swallow_text():
    from tessera.llm.dom import nodes_of, parse
    from tessera.llm.extraction import main_texts, trained

    def texts(page):
        return [x.text for x in nodes_of(parse(page)) if x.text]

    assert texts("<p>Let <math><mi>x</mi> <mo>=</mo> <mn>1</mn></math> be.</p>") == ["Let x = 1 be."]
    assert texts("<noscript><p>a</p></noscript><object><object>b</object>c</object><svg><text>d</text><path d='1'/></svg>e") == list("abcde")
    for tag in ("button", "select", "svg", "datalist", "canvas", "audio", "video"):
        page = f"<div><{tag}>x<section><h2>Head</h2><p>Text</p></section></div>"
        leaf = next(x for x in nodes_of(parse(page)) if x.text == "Text")
        assert (leaf.parent.tag, leaf.parent.parent.tag, leaf.parent.parent.parent.tag) == ("p", "section", "div"), tag
    more = "It goes on with words of the story, and then with more of them, so that it is long enough. " * 3
    plain = PAGE.replace("<div class=\"ad\">", f"<p>{more}</p><div class=\"ad\">")
    want = main_texts([plain], trained())
    assert more.strip() in want[0]
    for icon in ("<svg><path d='M1'/></svg>", "<button>Share</button>"):
        assert main_texts([plain.replace("with words of the story", f"with words {icon} of the story", 1)], trained()) == want, icon
    for start in ("<button>", "<select>", "<svg>", "<video>", "<noscript>", "<object>"):
        assert more.strip() in main_texts([plain.replace(f"<p>{more}", f"{start}<p>{more}")], trained())[0], start


def test_numbers_are_a_share_of_the_whole_leaf():
    from tessera.llm.dom import parse
    from tessera.llm.extraction import features
    shares = [features(parse(f"<p>{t}</p>"))[1][-1, -2] for t in ("a" * 300 + "1" * 100, "a" * 400)]
    assert shares == [0.25, 0]


def test_neighbours(spark):
    from tessera.llm.neighbours import search
    rng = np.random.default_rng(3)
    v = rng.standard_normal((600, 16))
    v[100:160] = v[100]  # ties
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(None, [1.0] * 16), (1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0, 2.0]), (1080, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as bucket", "2 as v", "3 as cell")
    got = search(df, 20, 20).collect()
    hits = 0
    for q in range(0, 600, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        exact = (v * v[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(600), -exact)) if i != q][:20]
        assert len(own) == 20 and all(abs(s - exact[i]) < 1e-12 for _, i, s in own)
        hits += len({i for _, i, _ in own} & set(order))
    assert hits / 600 >= 0.9 and len(got) == 600
    assert search(df.limit(0), 20, 20).count() == 0
    few = search(df.filter("vec_id < 5"), 5, 20).collect()
    assert [r["rank"] for r in few] == [1, 2, 3, 4]
