"""Main body of an HTML page by composite text density over its DOM."""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without end tag, without visible text, and inside a line of text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "template", "head", "svg"}
INLINE = {"a", "abbr", "b", "cite", "code", "em", "i", "kbd", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "time", "u", "label", "button"}


class Node:
    """An element: its characters and tags, those in links, and its parts in order (texts and elements)."""

    __slots__ = ("tag", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str):
        self.tag, self.parts = tag, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack = [self.root]
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden += 1
        if self.hidden:
            return
        node = Node(tag)
        if tag in ("p", "li", "tr", "td", "dt", "dd") and self.stack[-1].tag == tag:
            self.stack.pop()  # the end tag may be left out
        self.stack[-1].parts.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        if not self.hidden:
            self.stack[-1].parts.append(Node(tag))

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
            return
        if self.hidden:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                break

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.stack[-1].parts.append(data)


def _order(root: Node) -> list[Node]:
    """All nodes, parents before their children (no recursion: pages may nest deeply)."""
    out = [root]
    for node in out:
        out.extend(node.children())
    return out


def measure(root: Node) -> list[Node]:
    """Characters and tags of every node, its composite density, and the sum over its children."""
    nodes = _order(root)
    for n in reversed(nodes):
        own = sum(len(" ".join(p.split())) for p in n.parts if isinstance(p, str))
        kids = n.children()
        n.chars = own + sum(k.chars for k in kids)
        n.tags = len(kids) + sum(k.tags for k in kids)
        if n.tag in ("a", "button"):
            n.link_chars, n.link_tags = n.chars, n.tags + 1
        else:
            n.link_chars, n.link_tags = sum(k.link_chars for k in kids), sum(k.link_tags for k in kids)
    share = root.link_chars / max(root.chars, 1)
    for n in nodes:
        c, t, lc, lt = n.chars, max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
        if c:
            base = math.log(c / max(c - n.link_chars, 1) * n.link_chars + share * c + math.e)
            n.density = max(0.0, c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)) if base > 1 else c / t * math.log(max(c / lc * t / lt, 1.0))
    for n in nodes:
        n.total = sum(k.density for k in n.children())
    return nodes


def _lines(node: Node, floor: float, out: list[str]) -> None:
    """Text of a node line by line, without the parts below the floor."""
    buffer: list[str] = []

    def flush():
        text = " ".join("".join(buffer).split())
        if text:
            out.append(text)
        buffer.clear()

    stack: list = [iter([node])]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
        elif part is flush:
            flush()
        elif isinstance(part, str):
            buffer.append(part)
        elif part.tag == "br":
            flush()
        elif part.tag in INLINE:
            stack.append(iter(part.parts))
        elif part is node or part.density >= floor:
            flush()
            stack.append(iter([*part.parts, flush]))
    flush()


def html_body(html: str | None) -> list[str]:
    """Lines of the main body of a page.

    The main subtree is the node with the greatest sum of its children's densities; the
    least density on the path from it up to the body is the threshold for its parts.
    Null, blank and linkless texts give what text there is.
    """
    if not html or not html.strip():
        return []
    builder = _Builder()
    builder.feed(html)
    builder.close()
    nodes = measure(builder.root)
    parent = {id(k): n for n in nodes for k in n.children()}
    best = max(nodes, key=lambda n: n.total)
    if best.total == 0:
        best = builder.root
    floor, at = best.density, best
    while id(at) in parent:
        at = parent[id(at)]
        if at.tag != "html" and at.density > 0:
            floor = min(floor, at.density)
    out: list[str] = []
    _lines(best, floor, out)
    return out


def strip_html(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, line_no, line): the body lines of pages given as HTML, counted from 1. No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, line) for k, h in zip(b["k"], b["h"]) for i, line in enumerate(html_body(h), 1)]
            yield pd.DataFrame(rows, columns=["k", "n", "line"]).astype({"k": "int64", "n": "int32"})

    out = pages.select(F.col(key).cast("long").alias("k"), F.col(html).cast("string").alias("h")).mapInPandas(run, "k long, n int, line string")
    return out.select(F.col("k").alias(key), F.col("n").alias("line_no"), "line")
