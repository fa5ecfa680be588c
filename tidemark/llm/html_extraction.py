"""Main-text extraction by gradient-boosted trees over DOM nodes.

A page becomes a tree of elements.  Trees boosted on node features (subtree
density, attribute tokens, depth, sibling statistics) give each element a log odds
of being main text.  Hierarchical decoding then picks the labelling of the whole
tree with the largest total in which nothing below a dropped element is kept, by
one pass up and one down.  The text of kept elements, block by block in page
order, is the result.

The model is trained here, on pages that :func:`training_pages` makes from layouts
with a known main text; their number bounds the sample.

Inline elements follow the block that they are in, unless an attribute names a part of a page that is no main text
(an advert, a share link) or they are a control's label: those are judged like blocks.  A ``header``, that of an article
included, is no main text.  Where keeping and dropping an element are worth the same, it is dropped.

White space is what Unicode calls so (``WHITE``), non-breaking spaces included.

Defined results: a null or empty page, or one without text, gives an empty text; an
empty table gives no rows.  Unclosed and stray tags are tolerated as browsers do; a tag
that is cut off by the end of the page, or by a quote that is never closed, ends the
page and is no text.  Rows are read
one by one, null and repeated ids and repeated rows included; reading takes time in
proportion to a page's length.  Only ``page_id``, ``url`` and ``html`` are read by name;
other columns may have any.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import slices

PAGES, SEED = 240, 11
#: Bytes of pages that a worker reads at a time; their trees take many times that.
SLICE_BYTES = 1 << 20
TREES, DEPTH, RATE, CUTS = 40, 3, 0.3, 24

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe select".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: Attribute and tag tokens that name parts of a page.
AGAINST = frozenset(
    "ad ads advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form "
    "header login masthead menu meta nav navbar navigation newsletter notice outbrain pagination popup promo promoted recommend related "
    "reply responses search share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar topbar widget".split()
)
FOR = frozenset("article body content entry main post story text".split())

#: What begins with "<" and is not text: a comment, a declaration, or the name of a tag.
_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: One attribute: its name, and its value with quotes or without.
_ATTR = re.compile(r"[\s/]*(?:(>)|(=?[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(\"?)|'([^']*)('?)|([^\s>\"'][^\s>]*))?)?)")
_NAMED = frozenset("class id role itemprop".split())
#: White space, which is all that is turned into one space: that of HTML, and the spaces of other scripts.
WHITE = "\t\n\f\r \x0b\x85\xa0                　"
_WHITE = re.compile(f"[{WHITE}]+")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("attrs", "depth", "floor", "items", "kids", "parent", "tag")

    def __init__(self, tag: str, attrs: frozenset, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.depth = parent.depth + 1 if parent else 0
        self.floor: Node = parent.floor if parent and tag in INLINE else self  # the nearest block, itself included
        self.kids: list[Node] = []
        self.items: list = []  # texts and kids, in order


def _attributes(page: str, pos: int) -> tuple[int, frozenset, bool]:
    """Where the tag whose name ends at ``pos`` ends (-1: never), the words of its naming attributes, and whether it closes itself."""
    words: set[str] = set()
    while True:
        m = _ATTR.match(page, pos)
        if m[1]:
            return m.end(), frozenset(words), page[m.start() : m.end()].endswith("/>")
        if m.end() == len(page) or (m[3] is not None and not m[4]) or (m[5] is not None and not m[6]):
            return -1, frozenset(), False  # cut off within the tag, or a quote that is never closed
        if m.end() == pos:  # a lone character that begins no attribute
            pos += 1
            continue
        if m[2].lower() in _NAMED:
            words.update(_WORD.findall((m[3] or m[5] or m[7] or "").lower()))
        pos = m.end()


def parse(page: str) -> Node:
    """The element tree; raw elements such as scripts keep no text.

    Every character is looked at a bounded number of times: what is open is counted by
    tag, so that stray end tags cost nothing.
    """
    root = at = Node("#page", frozenset(), None)
    opened: Counter = Counter()
    pos, end, text = 0, len(page), 0  # text: where the text that is being read began

    def close(n: Node) -> Node:
        opened[n.tag] -= 1
        return n.parent

    while pos < end:
        lt = page.find("<", pos)
        m = _OPEN.match(page, lt) if lt >= 0 else None
        if lt >= 0 and not m:
            if lt == end - 1 or page[lt + 1] != "/":  # a lone "<" is text
                pos = lt + 1
                continue
            stop = page.find(">", lt)  # "</" and no name: a comment, which ends at ">"
            here = lt, end if stop < 0 else stop + 1
        elif lt < 0:
            here = end, end
        elif m[1]:
            stop = page.find("-->", max(m.end() - 2, lt + 4))
            here = lt, end if stop < 0 else stop + 3
        elif m[2]:
            stop = page.find(">", lt)
            here = lt, end if stop < 0 else stop + 1
        else:
            stop, names, shut = _attributes(page, m.end())
            here = lt, end if stop < 0 else stop
        if here[0] > text:
            at.items.append(entities.unescape(page[text : here[0]]))
        pos = text = here[1]
        if not m or not m[4] or stop < 0:
            continue
        tag = m[4].lower()
        if m[3]:
            if opened[tag]:
                while at.tag != tag:
                    at = close(at)
                at = close(at)
            continue
        ends = CLOSES.get(tag) or ({"p"} if tag in CLOSES_P else ())
        while at.floor.tag in ends and at.floor.parent:
            floor = at.floor
            while at is not floor:
                at = close(at)
            at = close(at)
        node = Node(tag, names, at)
        at.kids.append(node)
        at.items.append(node)
        if tag in RAW:
            found = _RAW_END[tag].search(page, pos)
            pos = text = found.end() if found else end
        elif tag not in VOID and not shut:
            at = node
            opened[tag] += 1
    return root


_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}


def is_judged(n: Node) -> bool:
    """Whether an element is judged by itself: a block, or an inline element that says it is no text of its block."""
    if n.tag in INLINE:
        return n.tag == "label" or not AGAINST.isdisjoint(n.attrs)
    return n.tag not in RAW and n.tag not in VOID


def blocks(root: Node) -> list[Node]:
    """The elements that are judged, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if is_judged(n):
            out.append(n)
        todo.extend(reversed(n.kids))
    return out


FEATURES = (
    "text", "links", "density", "words_a_kid", "tags", "depth", "against", "for", "against_above", "for_above", "paragraph", "heading",
    "list", "place", "siblings", "share", "control", "inline",
)
_PARAGRAPH = frozenset("p pre blockquote td dd figcaption".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_LIST = frozenset("ul ol dl li dt table tr".split())
_CONTROL = frozenset("button input label select option fieldset form".split())


def describe(root: Node) -> tuple[list[Node], np.ndarray]:
    nodes = blocks(root)
    own: dict[int, list[float]] = {}  # characters, characters in links, tags, words
    order, todo = [], [(root, False)]
    while todo:
        n, link = todo.pop()
        link = link or n.tag == "a"
        order.append((n, link))
        todo.extend((k, link) for k in n.kids)
    for n, link in reversed(order):
        s = [0.0, 0.0, 1.0, 0.0]
        if n.tag not in RAW:
            for x in n.items:
                if isinstance(x, str):
                    words = x.split()
                    c = float(sum(map(len, words)))
                    s[0] += c
                    s[1] += c if link else 0.0
                    s[3] += len(words)
                else:
                    k = own[id(x)]
                    s = [a + b for a, b in zip(s, k, strict=True)]
        own[id(n)] = s
    x = np.zeros((len(nodes), len(FEATURES)))
    above: dict[int, tuple[float, float]] = {}
    mates = {id(root): (0.0, 1, own[id(root)][0])}  # place, children of the same tag, text of all children
    for n, _ in order:
        tags, text = Counter(k.tag for k in n.kids), sum(own[id(k)][0] for k in n.kids)
        for j, k in enumerate(n.kids):
            mates[id(k)] = (j / len(n.kids), tags[k.tag], text)
    for i, n in enumerate(nodes):
        c, a, tags, words = own[id(n)]
        names = n.attrs | {n.tag}
        bad, good = float(bool(names & AGAINST)), float(bool(names & FOR))
        up = n.parent
        while up is not None and id(up) not in above:
            up = up.parent
        over = above[id(up)] if up is not None else (0.0, 0.0)
        above[id(n)] = (max(over[0], bad), max(over[1], good))
        place, alike, mate_text = mates[id(n)]
        x[i] = (
            np.log1p(c), a / max(1.0, c), c / tags, words / max(1, len(n.kids)), np.log1p(tags), n.depth, bad, good, *over,
            n.tag in _PARAGRAPH, n.tag in _HEADING, n.tag in _LIST, place, np.log1p(alike), c / max(1.0, mate_text), n.tag in _CONTROL, n.tag in INLINE,
        )
    return nodes, x


def decode(nodes: list[Node], odds: np.ndarray) -> set[int]:
    """Ids of the kept nodes: the best labelling in which no kept node is below a dropped one."""
    at = {id(n): i for i, n in enumerate(nodes)}
    parent = np.full(len(nodes), -1)
    for i, n in enumerate(nodes):
        up = n.parent
        while up is not None and id(up) not in at:
            up = up.parent
        if up is not None:
            parent[i] = at[id(up)]
    keep, drop = odds / 2, -odds / 2
    keep, drop = keep.copy(), drop.copy()
    for i in range(len(nodes) - 1, 0, -1):  # parents come first
        p = parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = np.zeros(len(nodes), bool)
    for i in range(len(nodes)):
        kept[i] = (i == 0 or kept[parent[i]]) and keep[i] > drop[i]
    return {id(n) for n, k in zip(nodes, kept, strict=True) if k}


def text_of(root: Node, kept: set[int]) -> str:
    """Texts of kept elements; inline elements follow the block they are in."""
    out: list[str] = []

    stack: list = [(root, iter(root.items))]
    while stack:
        n, items = stack[-1]
        x = next(items, None)
        if x is None:
            stack.pop()
            if n.tag not in INLINE:
                out.append(" ")
        elif isinstance(x, str):
            out.append(x)
        elif x.tag in RAW:
            continue
        elif x.tag in INLINE:
            if not is_judged(x) or id(x) in kept:
                stack.append((x, iter(x.items)))
        else:
            out.append(" ")
            if id(x) in kept:
                stack.append((x, iter(x.items)))
    return _WHITE.sub(" ", "".join(out)).strip(" ")


# Boosting


class Boosted:
    """Trees on binary log loss, each a list of (feature, cut, left, right) or a leaf value."""

    def __init__(self, bias: float, trees: list):
        self.bias, self.trees = bias, trees

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            feature, cut, left, right, value = tree
            for _ in range(DEPTH):
                go = x[np.arange(len(x)), feature[at]] <= cut[at]
                at = np.where(go, left[at], right[at])
            out += value[at]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Boosted:
    """Second-order boosting with regression trees cut at quantiles."""
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    odds, made = np.full(len(y), bias), []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1])) for f in range(x.shape[1])]

    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        nodes: list[list] = []

        def grow(rows: np.ndarray, depth: int, g=g, h=h, nodes=nodes) -> int:
            me = len(nodes)
            gs, hs = g[rows].sum(), h[rows].sum()
            nodes.append([0, np.inf, me, me, RATE * gs / (hs + 1.0)])
            best = (1e-6, None, None)
            for f in range(x.shape[1]) if depth else ():
                v = x[rows, f]
                for c in cuts[f]:
                    low = v <= c
                    gl, hl = g[rows][low].sum(), h[rows][low].sum()
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if gain > best[0] and hl > 0.5 and hs - hl > 0.5:
                        best = (gain, f, c)
            if best[1] is not None:
                low = x[rows, best[1]] <= best[2]
                left, right = grow(rows[low], depth - 1), grow(rows[~low], depth - 1)
                nodes[me][:4] = [best[1], best[2], left, right]
            return me

        grow(np.arange(len(y)), DEPTH)
        f, c, a, b, v = (np.array(z) for z in zip(*nodes, strict=True))
        tree = (f.astype(np.int64), c.astype(float), a.astype(np.int64), b.astype(np.int64), v.astype(float))
        made.append(tree)
        odds = odds + Boosted(0.0, [tree]).odds(x)
    return Boosted(bias, made)


# Training pages

_BAD = (
    ("nav", ""), ("div", "menu main-menu"), ("header", ""), ("div", "site-header"), ("footer", ""), ("div", "footer"), ("aside", ""),
    ("div", "sidebar"), ("div", "ad"), ("div", "advert box"), ("section", "promo sponsored"), ("form", ""), ("div", "newsletter signup"),
    ("div", "cookie notice"), ("div", "banner"), ("section", "comments"), ("div", "comment-list"), ("ul", "social share"),
    ("div", "related posts"), ("div", "breadcrumbs"), ("ul", "pagination"), ("div", "search"), ("div", "x1"),
)


def training_pages(n: int = PAGES, seed: int = SEED) -> Iterator[str]:
    """Pages whose main-text elements carry the attribute ``data-main``."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(1, 9)))
    line = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))

    def bad() -> str:
        tag, name = rng.choice(_BAD)
        kind = rng.randrange(6)
        if name == "x1":  # a name that says nothing; only its links do
            name, kind = word(), rng.choice((0, 5))
        if kind == 5 and tag != "ul":
            inner = " ".join(f"<a href='/{word()}'>{line(1, 3)}</a>" for _ in range(rng.randint(1, 6)))
        elif kind == 0 or tag == "ul":
            inner = "".join(f"<li><a href='/{word()}'>{line(1, 3)}</a></li>" for _ in range(rng.randint(3, 9)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == 1:
            inner = "".join(f"<p>{line(2, 30)}</p>" for _ in range(rng.randint(1, 4)))
        elif kind == 2:
            inner = f"<label>{line(1, 3)}</label><input name=q><button>{line(1, 2)}</button>"
        elif kind == 3:
            inner = "".join(f"<div><h4>{line(1, 2)}</h4><p>{line(5, 60)}</p></div>" for _ in range(rng.randint(1, 4)))
        else:
            inner = line(1, 25)
        attr = f' {rng.choice(["class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def good() -> str:
        parts = [f"<h1 data-main>{line(2, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14])):
            r, inline = rng.random(), f" <b>{line(1, 3)}</b> <a href=#>{line(1, 3)}</a> "
            if r < 0.65:
                parts.append(f"<p data-main>{line(1, 90)}{inline if rng.random() < 0.4 else ''}{line(0, 40)}" + "</p>" * (rng.random() < 0.9))
            elif r < 0.75:
                parts.append(f"<h2 data-main>{line(1, 7)}</h2>")
            elif r < 0.83:
                parts.append("<ul data-main>" + "".join(f"<li data-main>{line(2, 25)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif r < 0.88:
                parts.append(f"<blockquote data-main><p data-main>{line(5, 50)}</p></blockquote>")
            elif r < 0.92:
                rows = "".join(f"<tr data-main><td data-main>{line(1, 4)}</td><td data-main>{line(1, 4)}</td></tr>" for _ in range(3))
                parts.append(f"<table data-main>{rows}</table>")
            elif r < 0.96:
                parts.append(f"<div data-main>{line(10, 80)}</div>")
            else:
                parts.append(bad())
        return "".join(parts)

    inline = random.Random(seed + 1)  # of its own, so that the pages stay what they are

    def noted(page: str) -> str:
        """A page with labels, adverts and share links within some of its paragraphs."""
        tags = ('span class="advert"', "label", 'a class="share" href="#"', 'em class="sponsored"', 'span id="promo"', 'a class="comments" href="#"', 'small class="cookie-notice"')

        def put(m: re.Match) -> str:
            if inline.random() > 0.15:
                return m[0]
            tag = inline.choice(tags)
            words = " ".join("".join(inline.choice("aeioubcdfglmnprst") for _ in range(inline.randint(1, 9))) for _ in range(inline.choice((1, 2, 4, 12, 30))))
            return f"{m[0]}<{tag}>{words}</{tag.split()[0]}> "

        return re.sub("<p data-main>|<li data-main>|<td data-main>", put, page)

    for _ in range(n):
        box = rng.choice(["<article data-main>", '<div class="content" data-main>', '<main data-main><article data-main>', '<div id="post-body" data-main>', '<section class="story" data-main>', "<div data-main>"])
        before = "".join(bad() for _ in range(rng.randint(0, 4)))
        after = "".join(bad() for _ in range(rng.randint(0, 4)))
        shut = "</article></main>" if "main><" in box else f"</{box[1:].split()[0].rstrip('>')}>"
        yield noted(f"<html data-main><head><title>{line(1, 6)}</title></head><body data-main>{before}{box}{good()}{shut}{after}</body></html>")


@lru_cache(maxsize=1)
def model() -> Boosted:
    xs, ys = [], []
    for page in training_pages():
        marks = re.sub(r" data-main", ' itemprop="zzmain"', page)
        nodes, _ = describe(parse(marks))
        label = [float(n.tag == "#page" or "zzmain" in n.attrs) for n in nodes]
        _, x = describe(parse(page))
        xs.append(x)
        ys.append(np.array(label))
    return boost(np.concatenate(xs), np.concatenate(ys))


def extract(pages: list[str | None], trees: Boosted) -> list[str]:
    roots = [parse(p or "") for p in pages]
    made = [describe(r) for r in roots]
    if not made:
        return []
    odds = trees.odds(np.concatenate([x for _, x in made]))
    out, at = [], 0
    for root, (nodes, x) in zip(roots, made, strict=True):
        out.append(text_of(root, decode(nodes, odds[at : at + len(x)])))
        at += len(x)
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    trees = model()  # some kilobytes, part of the task
    schema = T.StructType(
        [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 2, SLICE_BYTES):
                text = extract(part.column(2).to_pylist(), trees)
                n = pa.array(map(len, text), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), n], names=schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op4 over ``pages``."""
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
