"""Main text of web pages by gradient-boosted trees over DOM nodes.

Each element node has features: text density of its subtree, links, depth, sibling statistics, and tokens of its tag, class
and id and of its ancestors'. The trees are trained with Spark ML on the nodes of a sample of ``sample_pages`` pages
(a documented bound), labelled from pages' own semantic markup; each page is in the sample twice, once with its tokens hidden,
so that shape alone must do. Decoding goes down the tree: a rejected node takes its whole subtree with it, so no part is
kept below a rejected ancestor; the choice with the largest sum of scores, weighted by text, is taken.

Defined cases: a null or empty page has an empty text; unclosed and cut-off markup is closed at the end; a quote that is never
closed is a character; very long and deep pages take time in proportion to their length; repeated rows are treated alike; an empty
table gives no rows; columns named text or n_chars are replaced, others may have any name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.boosted_trees import fit, margins
from siltworks.llm.common import per_row

# Names of HTML elements and usual tokens of page parts.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe svg title textarea select button object".split())
INLINE = frozenset(
    "a abbr acronym area audio b bdi bdo big canvas cite code data del dfn em embed font i img input ins kbd label link map mark math meta meter nobr output picture progress q rb rp rt rtc ruby s samp slot small span strike strong sub sup time tt u var video wbr"
    " annotation mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
FOREIGN = frozenset("svg math".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
GOOD = frozenset("article main articlebody content post entry story".split())
BAD = frozenset(
    "nav menu header footer aside form ad ads advert advertisement banner sidebar cookie cookies notice consent comment comments respond share social related promo newsletter breadcrumb breadcrumbs pagination sponsor sponsored popup modal toolbar widget masthead".split()
)

# quotes open a value only after =; one that is never closed is a character of an unquoted value
ATTRIBUTES = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^>=]++)*+"""
# a comment ends at the first of these, also right where it begins
TAG = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
SELF_CLOSED = re.compile(r"""(?:\A|[\s"'])/\s*\Z""")
N_FEATURES = 16


class Node:
    __slots__ = ("tag", "parent", "parts", "children", "tokens", "depth", "chars", "own", "linked", "tags", "stops", "good", "bad", "index")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.parts, self.children = tag, parent, [], []
        self.tokens = {tag, *(t for m in ATTRIBUTE.finditer(attributes) for t in re.split(r"[^a-z]+", m[2].lower()) if t)}
        self.depth = parent.depth + 1 if parent else 0
        own = 1 if self.tokens & BAD else 2 if self.tokens & GOOD else 0
        #: distance to the nearest node, itself included, with such a token; 99: none
        self.bad = 0 if own == 1 else min(99, parent.bad + 1) if parent else 99
        self.good = 0 if own == 2 else min(99, parent.good + 1) if parent else 99
        if parent:
            self.index = len(parent.children)
            parent.children.append(self)
            parent.parts.append(self)
        else:
            self.index = 0


def parse(page: str) -> list[Node]:
    """The element nodes in page order; text stands in their parts as strings."""
    root = Node("html", None)
    nodes, here, at, n = [root], root, 0, len(page)
    # tags that are not closed any more behind a place, and how often a tag is open: so a page takes time in proportion to its length
    never: set[str] = set()
    open_: Counter[str] = Counter()

    def close(down_to: Node) -> Node:
        """Closes what is open below a node and the node itself."""
        up = here
        while up is not down_to:
            open_[up.tag] -= 1
            up = up.parent
        open_[up.tag] -= 1
        return up.parent

    while at < n:
        found = page.find("<", at)
        if found < 0:
            found = n
        if found > at:
            here.parts.append(html.unescape(page[at:found]))
        if found == n:
            break
        m = TAG.match(page, found)
        if not m:
            here.parts.append("<")
            at = found + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_[tag]:
                up = here
                while up.tag != tag:
                    up = up.parent
                here = close(up)
            continue
        # a slash closes nothing but foreign elements (void ones are closed anyway)
        closed = (tag in FOREIGN or open_["math"] > 0) and SELF_CLOSED.search(m[3]) is not None
        if tag in RAW:
            if not closed and tag not in never:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                if end:
                    at = end.end()
                else:
                    never.add(tag)
            if not closed and tag in never and tag in ("script", "style", "title", "textarea"):
                at = n
            continue
        if tag in ("html", "head", "body"):
            continue
        if tag in CLOSES_P or tag == "li":
            goal = "li" if tag == "li" else "p"
            if open_[goal]:
                up = here
                while up and up.tag != goal and (up.tag in INLINE or up.tag == "p"):
                    up = up.parent
                if up and up.tag == goal:
                    here = close(up)
        node = Node(tag, here, m[3])
        nodes.append(node)
        if tag not in VOID and not closed:
            here = node
            open_[tag] += 1
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    for node in reversed(nodes):
        texts = [p for p in node.parts if isinstance(p, str)]
        node.own = sum(len(p.strip()) for p in texts)
        node.chars = node.own + sum(c.chars for c in node.children)
        node.linked = node.chars if node.tag == "a" else sum(c.linked for c in node.children)
        node.tags = 1 + sum(c.tags for c in node.children)
        node.stops = sum(p.count(".") + p.count(",") for p in texts) + sum(c.stops for c in node.children)
    rows = []
    for x in nodes:
        up = x.parent
        rows.append((
            math.log1p(x.chars), math.log1p(x.own), x.linked / max(x.chars, 1), x.tags / max(x.chars, 1), x.depth, x.index, len(up.children) if up else 1, x.chars / max(up.chars, 1) if up else 1.0,
            x.stops / max(x.chars, 1), x.good, x.bad, x.bad < 99 and x.bad <= x.good, x.good < 99 and x.good < x.bad, x.tag == "p", x.tag in ("ul", "ol", "li", "a"), math.log1p(up.chars) if up else 0.0,
        ))
    return np.array(rows, float).reshape(len(nodes), N_FEATURES)


HIDDEN = [9, 10, 11, 12]


def labelled(page: str, hide: bool) -> list[tuple[list[float], int]]:
    """Features and labels of the nodes below semantic markup: 1 if the nearest marked node is main text."""
    nodes = parse(page)
    x = features(nodes)
    if hide:
        x[:, HIDDEN] = (99, 99, 0, 0)
    return [(row.tolist(), int(node.good < node.bad)) for node, row in zip(nodes, x, strict=True) if min(node.good, node.bad) < 99]


def decode(nodes: list[Node], score: np.ndarray) -> list[bool]:
    """Kept nodes: the choice with the largest sum of score times text in which no node is kept below a rejected one."""
    gain = [float(s) * (node.own + 0.01) for s, node in zip(score, nodes, strict=True)]
    number = {id(x): i for i, x in enumerate(nodes)}
    below, kept_best = [0.0] * len(nodes), [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        children = [number[id(c)] for c in nodes[i].children]
        below[i] = gain[i] + sum(below[c] for c in children)
        kept_best[i] = gain[i] + sum(max(kept_best[c], -below[c]) for c in children)
    keep = [False] * len(nodes)
    for i, node in enumerate(nodes):
        keep[i] = (node.parent is None or keep[number[id(node.parent)]]) and (node.parent is None or kept_best[i] >= -below[i])
    return keep


def blocks(nodes: list[Node], keep: list[bool]) -> str:
    """The kept text: white space inside a block is one space, blocks are joined by a line end."""
    number = {id(x): i for i, x in enumerate(nodes)}
    done: list[str] = []
    current: list[str] = []

    def end() -> None:
        if text := " ".join("".join(current).split()):
            done.append(text)
        current.clear()

    stack: list = [iter(nodes[0].parts)] if keep[0] else []
    names = [nodes[0].tag]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if names.pop() not in INLINE:
                end()
        elif isinstance(part, str):
            current.append(part)
        else:
            if part.tag not in INLINE:
                end()
            if keep[number[id(part)]]:
                stack.append(iter(part.parts))
                names.append(part.tag)
    end()
    return "\n".join(done)


def extract(page: str | None, trees: list) -> tuple[str, int]:
    if not page:
        return "", 0
    nodes = parse(page)
    text = blocks(nodes, decode(nodes, margins(trees, features(nodes))))
    return text, len(text)


def main_text(pages: DataFrame, html_column: str = "html", key: str = "page_id", sample_pages: int = 500, seed: int = 9, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with text and n_chars (code points)."""
    carry = [c for c in (pages.columns if carry is None else carry) if c not in ("text", "n_chars")]
    n = pages.count()
    share = 1.0 if n <= sample_pages else sample_pages / n
    # by the page itself, so that the sample doesn't depend on how rows are dealt
    chosen = pages.select(F.col(f"`{html_column}`").alias("html"), F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{html_column}`")).alias("hash"))
    picked = chosen.where(F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("hash", "html").limit(2 * sample_pages)

    def node_rows(batches):
        for batch in batches:
            rows = [r for page in batch.column(0).to_pylist() for hide in (False, True) for r in labelled(page or "", hide)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.int32())], names=["x", "y"])

    sample = picked.mapInArrow(node_rows, "x array<double>, y int").persist()
    trees = fit(sample, "x", "y")
    sample.unpersist()
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in carry), F.lit(0).alias("_none")).alias("_row"), F.col(f"`{html_column}`").alias("_html"))
    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        return per_row(lambda page: extract(page, trees), ["_html"], schema, ["_row"])(batches)

    found = rows.mapInArrow(run, StructType([rows.schema["_row"]]).add("text", "string").add("n_chars", "long"))
    return found.select(*(F.col(f"_row.`{c}`") for c in carry), "text", "n_chars")
