"""A small forgiving reader of HTML: a page becomes a tree of block nodes whose text sits in leaves.

Inline elements belong to the block they are in. Open paragraphs, list items and table cells close
where the next one starts; end tags without a start are ignored; what is open at the end closes.
Scripts, styles, the head and other raw elements have no text. Controls, media and their like are nodes of
the block they are in; those without an end tag close where an element starts that they cannot hold.
"""

from __future__ import annotations

import html
import re
from collections import Counter

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rb rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom "
                   "msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd mlabeledtr semantics".split())
#: Raw elements: what is up to their end tag is not markup, and has no text.
SILENT = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Nodes that may stand within a run of text and don't close paragraphs; those that are never shown.
PHRASING = frozenset("button select option optgroup datalist svg canvas audio video object noscript template annotation annotation-xml".split())
UNSEEN = frozenset("template datalist annotation annotation-xml".split())
_SECTIONS = frozenset("article aside footer form h1 h2 h3 h4 h5 h6 header main nav section".split())
_BLOCKS = _SECTIONS | frozenset("address blockquote center dd details dl dt fieldset figure hr li menu ol p pre table ul".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

_TAG = re.compile(r"""<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[!?/][^>]*+>)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:@][-\w:.]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]++))?""")
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
#: Attributes whose words describe a node.
NAMING = frozenset(("class", "id", "role", "itemprop", "aria-label", "name", "data-role", "data-type", "data-component"))


class Node:
    """A block element, or (tag ``#text``) a run of text between the blocks of its parent."""

    __slots__ = ("tag", "words", "parent", "children", "pieces", "linked", "hidden", "mark", "text")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.words: list[str] = []
        self.pieces: list[str] = []
        self.linked, self.hidden, self.mark, self.text = 0, False, None, ""


def _describe(node: Node, attributes: str) -> None:
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in NAMING:
            node.words += [w.lower() for w in _PART.findall(value)]
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            node.hidden = True
        elif name == "data-mark":
            node.mark = value == "1"


_HOLDS_P = ("td", "th", "li", "blockquote", "div", "article", "section", "main", "body", "button", "object", "noscript", "template", "svg", "canvas", "audio", "video")


def _over(tag: str) -> str:
    """The elements that cannot hold a ``tag``: what is open of them ends where it starts."""
    if tag in _SECTIONS:
        return "select datalist svg button audio video canvas"
    if tag in _BLOCKS:
        return "select datalist svg button"
    return "select datalist svg" if tag == "div" else "button" if tag == "button" else "select" if tag == "select" else ""


def parse(page: str | None) -> Node:
    """The root of the page's tree."""
    page = page or ""
    root = here = Node("html", None)
    link, head = False, False
    opened: Counter[str] = Counter()   # what is open between the root and here: who is not, is not looked for

    def flush() -> None:
        """What was read since the last block becomes a text leaf of this one."""
        nonlocal here
        if here.pieces:
            text = " ".join("".join(here.pieces).split())
            if text:
                leaf = Node("#text", here)
                leaf.text, leaf.linked = text, min(here.linked, len(text))
                here.children.append(leaf)
            here.pieces, here.linked = [], 0

    def close(node: Node) -> None:
        nonlocal here, link
        while here is not node:
            flush()
            opened[here.tag] -= 1
            here = here.parent
        flush()
        opened[node.tag] -= node.parent is not None
        here, link = node.parent or node, False

    def open_up(tags: str, borders: tuple[str, ...]) -> Node | None:
        names, node = tags.split(), here
        if not any(opened[t] for t in names):
            return None
        while node.parent is not None and node.tag not in borders:
            if node.tag in names:
                return node
            node = node.parent
        return None

    def said(text: str) -> None:
        if text and not head:
            text = html.unescape(text) if "&" in text else text
            here.pieces.append(text)
            if link:
                here.linked += len(text.strip())

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        if m.start() > at:
            said(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, ends, attributes = tag.lower(), bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if tag in SILENT:
            if not ends and not (attributes or "").endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "head":
            head = not ends
        elif tag in ("html", "body"):
            head = False
            if tag == "body" and not ends:
                _describe(root, attributes)
        elif tag in VOID:
            if tag == "br" and not head:
                here.pieces.append(" ")
            elif tag == "hr":
                flush()
        elif tag in INLINE:
            if tag == "a":
                link = not ends
        elif ends:
            if (node := open_up(tag, ())) is not None:
                close(node)
        else:
            head = head and tag in PHRASING
            drawn = tag == "svg" or opened["svg"] > 0 and (not opened["foreignobject"] or open_up("svg", ("foreignobject",)) is not None)
            if (attributes or "").endswith("/") and (drawn or tag in PHRASING):
                continue
            if (over := _over(tag)) and (node := open_up(over, ("template", "foreignobject"))) is not None:
                close(node)
                drawn = False
            if tag not in PHRASING and not drawn and (p := open_up("p", _HOLDS_P)) is not None:
                close(p)
            if tag in CLOSES and (node := open_up(*CLOSES[tag])) is not None:
                close(node)
            flush()
            node = Node(tag, here)
            here.children.append(node)
            _describe(node, attributes)
            node.hidden = node.hidden or tag in UNSEEN
            opened[tag] += 1
            here, link = node, False
    if at < len(page):
        rest = page[at:]
        said(rest if not re.match(r"<[a-zA-Z/!?]", rest) else "")
    close(root)
    return root


def nodes_of(root: Node) -> list[Node]:
    """All nodes, parents before their children, in page order."""
    out, left = [], [root]
    while left:
        node = left.pop()
        out.append(node)
        left.extend(reversed(node.children))
    return out
