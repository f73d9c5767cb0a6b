"""Operator 5 - the main text of web pages by boosted trees over the nodes of their trees.

Each block node and each run of text is described by its kind, the words of its attributes and of its
ancestors', depth, the density of text and links in its subtree, and its siblings. Trees fitted on
generated pages of known structure give the odds that it belongs to the main text. Decoding picks the
likeliest labels that do not contradict: whatever is inside a node that does not belong, does not
belong either. A page that holds prose though no text of it was found likely falls back on the block with the most
prose outside of what is named or made as something else. Text of the nodes that belong is joined, block by block, in page order.
The time for a page grows with its length, however deep or flat it is.

Defined results: a null or empty page, or one without main text, has the empty text and n_chars 0;
null ids and urls are carried; repeated rows are extracted alike; an empty table gives an empty
result; other columns are ignored. A line break element is white space of its block.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tessera.llm.boosting import Trees, fit
from tessera.llm.common import columns
from tessera.llm.dom import PHRASING, Node, nodes_of, parse

#: Pages generated for the fit (its bound), and the shape of the model.
TRAINING_PAGES, TREES, DEPTH = 900, 80, 6

#: Words of class, id and role attributes, by what they say about a node.
SAYS = {
    "content": "article articlebody blog body content copy description detail entry hentry main news page post prose read reading rich story text",
    "navigation": "breadcrumb breadcrumbs crumb crumbs index links menu menubar nav navbar navigation pager pagination paging skip tab tabs toc toolbar topbar",
    "header": "banner brand branding head header heading hero logo masthead site sitename tagline",
    "footer": "bottom colophon contentinfo copyright foot footer imprint legal",
    "aside": "aside complementary more popular promo promoted rail recent recommend recommended related rightcol sidebar side teaser trending widget widgets",
    "advert": "ad ads adbox adsense adslot advert advertisement advertising adverts dfp partner sponsor sponsored sponsors",
    "notice": "alert alertdialog announcement consent cookie cookies dialog disclaimer gdpr message modal newsletter notice notification overlay paywall popup privacy subscribe toast",
    "comments": "comment commentlist comments commenter discuss discussion disqus feedback livefyre replies reply respond response responses thread",
    "form": "contact form login register search searchbox signin signup",
    "social": "author bio byline date facebook follow like meta rating share sharing social tag tags twitter vote",
    # Said by elements only.
    "control": "", "media": "", "fallback": "",
}
_SAID = {w: k for k, (_, words) in enumerate(SAYS.items()) for w in words.split()}
_KINDS = [("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("li", "dt", "dd"), ("ul", "ol", "dl", "menu"), ("div",), ("section",), ("article", "main"), ("nav",), ("header",),
          ("footer",), ("aside",), ("form", "fieldset", "legend"), ("table", "tbody", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption", "address"), ("#text",), ("html",),
          ("button", "select", "option", "optgroup", "datalist"), ("svg", "canvas", "audio", "video", "template", "annotation", "annotation-xml"), ("noscript", "object")]
_KIND = {tag: k for k, tags in enumerate(_KINDS) for tag in tags}
_TAG_SAYS = {"nav": 1, "header": 2, "footer": 3, "aside": 4, "form": 8, "article": 0, "main": 0}
_TAG_SAYS |= {tag: at for at, tags in enumerate(_KINDS[-3:], len(SAYS) - 3) for tag in tags}
_NUMBERS = re.compile(r"[\d©®™]")
_GROUPS, _FIRST = len(SAYS), len(_KINDS)
WIDTH = _FIRST + 2 * _GROUPS + 24


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """The nodes in page order and what is known of each."""
    nodes = nodes_of(root)
    n = len(nodes)
    at = {id(x): i for i, x in enumerate(nodes)}
    parent = [at[id(x.parent)] if x.parent is not None else -1 for x in nodes]
    own = np.zeros((n, 6))  # characters, linked characters, text leaves, sentence marks, paragraphs, blocks
    for i, x in enumerate(nodes):
        if x.text:
            own[i, :4] = len(x.text), x.linked, 1, sum(map(x.text.count, ".,;!?"))
        else:
            own[i, 4], own[i, 5] = x.tag == "p", 1
    sums = own.copy()
    for i in range(n - 1, 0, -1):
        sums[parent[i]] += sums[i]
    out = np.zeros((n, WIDTH))
    a, b = _FIRST, _FIRST + _GROUPS
    c = b + _GROUPS
    whole = max(1.0, sums[0, 0])
    before = np.cumsum(own[:, 0]) - own[:, 0]
    out[np.arange(n), [_KIND.get(x.tag, 4) for x in nodes]] = 1
    depth, inherits, hidden = [0.0] * n, [False] * n, [0.0] * n
    for i, x in enumerate(nodes):
        up = parent[i]
        said = [_SAID[w] for w in x.words if w in _SAID]
        if x.tag in _TAG_SAYS:
            said.append(_TAG_SAYS[x.tag])
        for k in said:
            out[i, a + k] += 1
        hidden[i] = float(x.hidden)
        if up >= 0:
            depth[i] = depth[up] + 1
            hidden[i] += hidden[up]
            if inherits[up]:
                out[i, b:c] = out[up, b:c] + out[up, a:b]
        inherits[i] = bool(said) or up >= 0 and inherits[up]
    out[:, c + 21] = hidden
    up = np.maximum(np.array(parent), 0)
    text, linked, leaves, marks, paragraphs, blocks = sums.T
    out[:, c] = np.log1p(text)
    out[:, c + 1] = linked / np.maximum(text, 1)
    out[:, c + 2] = text / np.maximum(blocks, 1)
    out[:, c + 3] = np.log1p(leaves)
    out[:, c + 4] = marks / np.maximum(text, 1)
    out[:, c + 5] = np.log1p(paragraphs)
    out[:, c + 6] = text / whole
    out[:, c + 7] = depth
    out[:, c + 8] = before / whole
    out[:, c + 9] = text / np.maximum(text[up], 1)
    out[:, c + 10] = linked[up] / np.maximum(text[up], 1)
    out[:, c + 11] = np.log1p(text[up])
    out[:, c + 12] = np.log1p(paragraphs[up])
    out[:, c + 13] = text[up] / whole
    # Siblings: how many, which, how long on average, what comes before and after.
    for x in nodes:
        m = len(x.children)
        if m == 1:
            i = at[id(x.children[0])]
            out[i, c + 14], out[i, c + 16] = np.log1p(1), np.log1p(text[i])
        elif m:
            own_at = [at[id(y)] for y in x.children]
            t, r = text[own_at], linked[own_at] / np.maximum(text[own_at], 1)
            near = np.zeros((m, 7))
            near[:, 0], near[:, 1], near[:, 2] = np.log1p(m), np.arange(m) / m, np.log1p(t.sum() / m)
            near[1:, 3], near[:-1, 4] = np.log1p(t[:-1]), np.log1p(t[1:])
            near[1:, 5], near[:-1, 6] = r[:-1], r[1:]
            out[own_at, c + 14:c + 21] = near
    out[:, c + 22] = [len(_NUMBERS.findall(y.text)) / len(y.text) if y.text else 0 for y in nodes]
    out[:, c + 23] = np.log1p(linked)
    return nodes, out


def decode(nodes: list[Node], margin: np.ndarray) -> list[bool]:
    """The likeliest consistent labels: a node belongs only if its parent does; the root does."""
    odds = np.clip(margin, -8, 8).tolist()
    at = {id(x): i for i, x in enumerate(nodes)}
    # What a subtree gains over belonging nowhere, if its top belongs.
    gain = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        gain[i] += odds[i]
        if nodes[i].parent is not None and gain[i] > 0:
            gain[at[id(nodes[i].parent)]] += gain[i]
    keep = [False] * len(nodes)
    for i, x in enumerate(nodes):
        keep[i] = x.parent is None or keep[at[id(x.parent)]] and gain[i] > 0
    return keep


#: What makes a run of text prose: words, a mark that ends a sentence, few links; and how many characters of it make a page one with a text.
PROSE_WORDS, PROSE_LINKED, PROSE_CHARS = 8, 0.4, 160
_ENDS = re.compile(r"[.!?。！？…][\"'”’)\]]*(?:\s|$)")


def fallback(nodes: list[Node], x: np.ndarray, margin: np.ndarray) -> list[bool]:
    """Labels of a page of which nothing belongs: the prose of the block that has most of it, outside of what says to be
    something else; nothing if that is little."""
    a, b = _FIRST, _FIRST + _GROUPS
    other = x[:, a + 1:b].sum(axis=1) + x[:, b + 1:b + _GROUPS].sum(axis=1) + x[:, b + _GROUPS + 21]
    at, total = {id(y): i for i, y in enumerate(nodes)}, np.zeros(len(nodes))
    prose = [bool(y.text) and other[i] == 0 and margin[i] > -6 and y.linked <= PROSE_LINKED * len(y.text) and len(y.text.split()) >= PROSE_WORDS
             and _ENDS.search(y.text) is not None for i, y in enumerate(nodes)]
    for i, y in enumerate(nodes):
        if prose[i]:  # to the block that paragraphs stand in
            holder = y.parent
            if holder.tag in ("p", "li", "blockquote", "td", "dd") and holder.parent is not None:
                holder = holder.parent
            total[at[id(holder)]] += len(y.text)
    best = int(total.argmax())
    if total[best] < PROSE_CHARS:
        return [False] * len(nodes)
    inside = [False] * len(nodes)
    for i, y in enumerate(nodes):
        inside[i] = i == best or y.parent is not None and inside[at[id(y.parent)]]
    return [p and q for p, q in zip(prose, inside)]


def agreed(nodes: list[Node], x: np.ndarray, margin: np.ndarray, keep: list[bool]) -> list[bool]:
    """``keep``, where paragraphs that stand side by side and say nothing else share the lot of most of their text, unless a
    paragraph's own odds are clearly against it."""
    a, b = _FIRST + 1, _FIRST + _GROUPS
    at = {id(y): i for i, y in enumerate(nodes)}
    keep = list(keep)
    for i, y in enumerate(nodes):
        if not keep[i] or len(y.children) < 2:
            continue
        plain = [at[id(z)] for z in y.children if z.tag == "p" and not z.hidden]
        plain = [j for j in plain if x[j, a:b].sum() == 0 and all(not z.children for z in nodes[j].children)]
        size = {j: sum(len(z.text) for z in nodes[j].children) for j in plain}
        if 2 * sum(size[j] for j in plain if keep[j]) > sum(size.values()):
            for j in plain:
                if not keep[j] and margin[j] > -5:
                    keep[j] = True
                    for z in nodes[j].children:
                        keep[at[id(z)]] = True
    return keep


def main_texts(pages: list[str | None], model: Trees) -> list[str]:
    """The main text of each page."""
    described = [features(parse(p)) for p in pages]
    if not described:
        return []
    margins = model.margin(np.concatenate([x for _, x in described]))
    out, at = [], 0
    for nodes, x in described:
        own = margins[at:at + len(nodes)]
        at += len(nodes)
        keep = agreed(nodes, x, own, decode(nodes, own))
        if not any(k and y.text for y, k in zip(nodes, keep)):
            keep = fallback(nodes, x, own)
        out.append(_joined([y for y, k in zip(nodes, keep, strict=True) if k and y.text]))
    return out


def _joined(leaves: list[Node]) -> str:
    """The texts, a line each; one that only controls or media part from the one before goes on its line."""
    parts, last, places = [], None, {}
    for x in leaves:
        if last is not None:
            apart = True
            if last.parent is x.parent:
                if id(x.parent) not in places:  # how many siblings before each are no controls or media, once a parent
                    among = x.parent.children
                    before = np.cumsum([0, *(y.tag not in PHRASING for y in among)]).tolist()
                    places[id(x.parent)] = {id(y): n for y, n in zip(among, before)}
                own = places[id(x.parent)]
                apart = own[id(x)] - own[id(last)] > 1
            parts.append("\n" if apart else " ")
        parts.append(x.text)
        last = x
    return "".join(parts)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    model = trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.iloc[at:at + 128]
                texts = main_texts([p if isinstance(p, str) else "" for p in part["html"]], model)
                yield pd.DataFrame({"page_id": part["page_id"].astype("Int64").to_numpy(), "url": part["url"].to_numpy(), "text": texts, "n_chars": [len(t) for t in texts]}).astype({"page_id": "Int64"})

    return columns(pages, page_id="long", url="string", html="string").mapInPandas(run, "page_id long, url string, text string, n_chars long")


@cache
def trained(pages: int = TRAINING_PAGES, seed: int = 5) -> Trees:
    """Trees fitted on ``pages`` generated pages; a container belongs if anything in it does."""
    rng, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        nodes, x = features(parse(generated_page(rng)))
        marks = {}
        for node in nodes:
            marks[id(node)] = node.mark if node.mark is not None else marks.get(id(node.parent), False)
        belongs = {id(n): marks[id(n)] and bool(n.text) for n in nodes}
        for node in reversed(nodes):
            if node.parent is not None and belongs[id(node)]:
                belongs[id(node.parent)] = True
        xs.append(x)
        ys.append([belongs[id(n)] for n in nodes])
    return fit(np.concatenate(xs), np.concatenate(ys).astype(float), trees=TREES, depth=DEPTH, rate=0.2, bins=32)


# Generated pages. data-mark="1" opens main text, data-mark="0" anything else.


def _words(rng: random.Random, least: int, most: int) -> str:
    n = rng.randint(least, most)
    words = ["".join(rng.choice("aeioulnrstdmcpgbhkvé") for _ in range(rng.randint(1, 9))) for _ in range(n)]
    style = rng.random()
    if style < 0.06:
        return " ".join(w.upper() + "!!" for w in words)
    if style < 0.1:
        return " | ".join(words)
    if style < 0.14:
        return " ".join(w + rng.choice(["%%%", "###", "***", "&amp;"]) for w in words)
    if style < 0.18:
        return " ".join(words[:1] * n)
    out = []
    for i, w in enumerate(words):
        out.append((w.capitalize() if not i or out[-1][-1] == "." else w) + (rng.choice([".", ",", "", "", "", "", "", ""])))
    return " ".join(out) + "."


def _named(rng: random.Random, kinds: list[str], tags: list[str]) -> tuple[str, str]:
    """A start tag with fitting or no attributes, and its end."""
    tag = rng.choice(tags)
    words = [rng.choice(SAYS[k].split()) for k in kinds[:1] * rng.choice([1, 1, 2])] + [rng.choice(["box", "wrap", "inner", "col", "x1", "container", "block", "grid"])] * rng.choice([0, 0, 1])
    rng.shuffle(words)
    plain = tag not in ("div", "section", "ul", "p", "span", "table") and rng.random() < 0.6
    name = "" if plain or not kinds else f' {rng.choice(["class", "class", "id", "role"])}="{rng.choice(["-", " ", "_"]).join(words)}"'
    return f"<{tag}{name}", f"</{tag}>"


def _links(rng: random.Random, most: int = 8) -> str:
    items = [f'<a href="/{i}">{_words(rng, 1, 4).rstrip(".")}</a>' for i in range(rng.randint(1, most))]
    return rng.choice([lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", lambda: " ".join(items), lambda: " | ".join(items), lambda: "".join(f"<p>{x}</p>" for x in items)])()


def _prose(rng: random.Random, most: int, longest: int = 90) -> str:
    return "".join(f"<p>{_words(rng, 1, rng.choice([8, 30, longest]))}</p>" for _ in range(rng.randint(1, most)))


def _other(rng: random.Random, kind: str) -> str:
    """Something that is not main text."""
    tags = {"navigation": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "advert": ["div", "aside", "section", "p"],
            "notice": ["div", "section", "p"], "comments": ["section", "div", "ol"], "form": ["form", "div"], "social": ["div", "ul", "p"]}[kind]
    start, end = _named(rng, [kind], tags)
    if start.startswith("<p"):
        inner = _words(rng, 2, 25)
    elif kind in ("navigation", "social"):
        inner = _links(rng)
    elif kind == "header":
        inner = rng.choice(["", f"<h1>{_words(rng, 1, 5)}</h1>", f"<p>{_words(rng, 1, 10)}</p>", f"<div>{_words(rng, 1, 5)}</div>"]) + rng.choice(["", _links(rng)])
    elif kind == "footer":
        inner = rng.choice([f"&copy; www.example.org &middot; {_words(rng, 2, 20)}", f"<p>&copy; 2024 {_words(rng, 1, 12)}</p>", _links(rng), _prose(rng, 2, 40) + _links(rng)])
    elif kind == "aside":
        inner = rng.choice(["", f"<h{rng.randint(2, 4)}>{_words(rng, 1, 4)}</h2>"]) + rng.choice([_links(rng), _prose(rng, 3), _words(rng, 3, 40)])
    elif kind == "comments":
        inner = rng.choice(["", f"<h3>{_words(rng, 1, 4)}</h3>"]) + "".join(
            rng.choice([f'<div class="comment">{_prose(rng, 2)}</div>', f"<li><b>{_words(rng, 1, 2)}</b>{_prose(rng, 2)}</li>", f"<article class='comment'>{_prose(rng, 2)}</article>", _prose(rng, 2)]) for _ in range(rng.randint(1, 5)))
    elif kind == "form":
        inner = f"<label>{_words(rng, 1, 4)}</label><input name=q>" + rng.choice(["", _prose(rng, 2, 20), f"<div>{_words(rng, 1, 12)}</div>"])
        if not start.startswith("<form") and rng.random() < 0.7:
            inner = f"<form>{inner}</form>"
    else:
        inner = rng.choice([_words(rng, 2, 40), _prose(rng, 2), f"<p>{_words(rng, 2, 30)}</p>" + _links(rng, 2)])
    return f'{start} data-mark="0">{inner}{end}'


def _control(rng: random.Random) -> str:
    """A control, a picture or another part that is not main text."""
    few, some = _words(rng, 1, 4), _words(rng, 3, 16)
    options = "".join(f"<option>{_words(rng, 1, 3)}{rng.choice(['', '</option>'])}" for _ in range(rng.randint(1, 6)))
    return rng.choice([f'<button data-mark="0">{few}</button>', f'<select data-mark="0">{options}</select>', f'<datalist data-mark="0">{options}</datalist>',
                       f'<svg data-mark="0" viewBox="0 0 9 9"><g><path d="M0 0"/><text>{few}</text></g></svg>', f'<template data-mark="0"><div><p>{some}</p></div></template>',
                       f'<video data-mark="0" src="v"><p>{some}</p></video>', f'<audio data-mark="0">{some}</audio>', f'<canvas data-mark="0">{few}</canvas>',
                       f'<object data-mark="0"><p>{few}</p></object>', f'<noscript data-mark="0">{rng.choice([few, some])}</noscript>'])


def _open_up(rng: random.Random, blocks: str) -> str:
    """Main text within, or after the start of, an element that may hold it."""
    tag = rng.choice(["noscript", "object", "video", "button", "svg", "select"])
    end = f"</{tag}>" if tag in ("noscript", "object") and rng.random() < 0.7 else ""
    return f"<{tag}>{blocks}{end}"


_START = re.compile(r"<([a-z][a-z0-9]*)(?=[\s>])")


def _article(rng: random.Random) -> str:
    layout = rng.random()
    blocks = [rng.choice(["", f"<h1>{_words(rng, 1, 12)}</h1>", f"<h1>{_words(rng, 1, 12)}</h1>", f"<header><h1>{_words(rng, 1, 12)}</h1></header>", f"<h2>{_words(rng, 1, 9)}</h2>"])]
    for _ in range(rng.choice([0, 1, 2, 4, 8, 14])):
        blocks.append(rng.choice([lambda: _prose(rng, 3), lambda: _prose(rng, 3), lambda: _prose(rng, 2), lambda: f"<p><b>{_words(rng, 1, 20)}<br>", lambda: f"<h{rng.randint(2, 4)}>{_words(rng, 1, 6)}</h2>",
                                  lambda: "<ul>" + "".join(f"<li>{_words(rng, 1, 20)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>", lambda: f"<blockquote>{_prose(rng, 2)}</blockquote>",
                                  lambda: f"<div>{_words(rng, 3, 50)}</div>", lambda: f"<div>{_prose(rng, 3)}</div>", lambda: f"<section>{_prose(rng, 3)}</section>", lambda: f"<pre>{_words(rng, 3, 20)}</pre>",
                                  lambda: f"<p>{_words(rng, 3, 30)} <a href='/x'>{_words(rng, 1, 6)}</a></p>", lambda: f"<table><tr><td>{_words(rng, 1, 6)}<td>{_words(rng, 1, 6)}</table>",
                                  lambda: f"<figure><figcaption>{_words(rng, 2, 12)}</figcaption></figure>"])())
        if rng.random() < 0.12:
            blocks.append(_other(rng, rng.choice(["advert", "aside", "social", "form", "notice"])))
        if rng.random() < 0.1:
            blocks.append(rng.choice([_control(rng), f"<p>{_words(rng, 1, 20)} {_control(rng)} {_words(rng, 1, 20)}</p>"]))
        if rng.random() < 0.03:
            blocks.append(_open_up(rng, _prose(rng, 4)))
    if not any(blocks):
        blocks = [f"<p>{_words(rng, 1, 40)}</p>"]
    if layout < 0.16:  # straight in the page, or in a block or cell without a name
        inner = "".join(b if "data-mark" in b else _START.sub(r'<\1 data-mark="1"', b) for b in blocks)
        if layout < 0.08:
            return inner
        if layout < 0.12:
            return f"<div>{inner}</div>" if layout < 0.1 else f'<div><div data-mark="1">{"".join(blocks)}</div></div>'
        side = f"<td>{_other(rng, rng.choice(['navigation', 'aside', 'advert']))}</td>"
        cell = f'<td data-mark="1">{"".join(blocks)}</td>'
        return f"<table><tr>{rng.choice([cell, side + cell, cell + side])}</tr></table>"
    if layout < 0.22:  # named as something else, or as both
        start, end = _named(rng, [rng.choice([k for k in SAYS if SAYS[k] and k != "content"])], ["article", "article", "main", "div", "section"])
        words = rng.choice([rng.choice(SAYS["content"].split()) + rng.choice(["-", " "]), "", ""]) + rng.choice(SAYS[rng.choice(["notice", "comments", "header", "aside", "social", "advert", "navigation"])].split())
        start = start if "=" in start else f'{start} class="{words}"'
        if start[1:4] in ("div", "sec"):
            start = re.sub(r'="', f'="{rng.choice(SAYS["content"].split())}-', start, count=1)
        return f'{start} data-mark="1">{"".join(blocks)}{end}'
    inner = "".join(blocks) + (_other(rng, rng.choice(["comments", "social", "aside"])) if rng.random() < 0.15 else "")
    for _ in range(rng.choice([0, 1, 1, 2])):
        start, end = _named(rng, rng.choice([["content"], ["content"], []]), ["div", "div", "section", "article", "main"])
        inner = f"{start}>{inner}{end}"
    start, end = _named(rng, rng.choice([["content"], ["content"], ["content"], []]), ["article", "article", "article", "main", "div", "section"])
    return f'{start} data-mark="1">{inner}{end}'


def generated_page(rng: random.Random) -> str:
    """A page of random structure around one article."""
    kinds = ["navigation", "header", "advert", "notice", "aside", "social", "form"]
    top = [_other(rng, k) for k in rng.sample(kinds, rng.randint(0, 4))]
    low = [_other(rng, k) for k in rng.sample(["comments", "aside", "advert", "form", "social", "notice", "navigation"], rng.randint(0, 3))] + [_control(rng) for _ in range(rng.choice([0, 0, 1]))] + [_other(rng, "footer")] * (rng.random() < 0.85)
    middle = _article(rng)
    if rng.random() < 0.1:
        top.append(_control(rng))
    if rng.random() < 0.3:
        near = [_other(rng, rng.choice(["aside", "advert", "navigation"]))]
        start, end = _named(rng, [], ["div"])
        middle = f"{start} id=\"page\">" + "".join(rng.choice([[middle, *near], [*near, middle]])) + end
    loose = f"<p data-mark=\"0\">{_words(rng, 1, 6)}</p>" if rng.random() < 0.05 else ""
    return f"<!DOCTYPE html><html><head><title>{_words(rng, 1, 9)}</title></head><body>{''.join(top)}{loose}{middle}{''.join(low)}</body></html>"
