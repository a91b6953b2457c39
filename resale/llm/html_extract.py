"""Main text of web pages: gradient-boosted trees over DOM nodes and hierarchical decoding.

A page becomes a tree of block elements; a run of text and inline elements
inside a block is a leaf.  Trees (numpy, histogram splits) estimate for every
node whether main text lies in it, from subtree text and link density, depth,
sibling statistics, and the tag and attribute tokens of the node and its
ancestors.  Decoding takes the most likely labelling in which a node with main
text has only ancestors with main text, so an ancestor and its descendants
cannot contradict each other; leaves labelled as main text are the result.

The model is fitted on a bounded sample of pages (``max_pages`` with the
smallest hash of their id, ``max_chars`` characters in all, longer pages left out
first) that mark their article by an element of that kind;
nodes inside it that are no menu, form, notice or comment are the positive
ones.  Copies of the sample with other element names and attributes, without
them, and with menus, comments, notices and forms made of the sample's own
texts keep the model from relying on one template.

Defined results: null or empty html has no text; markup that is cut off or
never closed is read as far as it goes; without a page to learn from every leaf
is kept; repeated rows give repeated rows; an empty table gives an empty table;
other columns are not read.  Very long pages are taken whole.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resale.llm.common import hashed_sample, slices, strings

MAX_PAGES, MAX_CHARS = 200, 8_000_000
MAX_TOKENS = 72
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.25

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "dfn", "em", "font", "i", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "big", "strike", "ins", "del", "label"}
INLINE |= {"math", "mi", "mo", "mn", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msup", "msub", "msubsup", "mover", "munder", "semantics"}
SKIPPED = {"script", "style", "template", "head", "title", "svg", "iframe", "textarea", "select", "datalist", "option", "optgroup", "button"}
#: A start tag that ends an open option.
OPTIONS = {"option": {"option"}, "optgroup": {"option", "optgroup"}}
#: Blocks of text; inside a skipped element that is none of RAW they show that its end tag is missing.
BLOCKS = {"article", "main", "section", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "blockquote", "pre"}
RAW = {"script", "style", "template", "title", "textarea", "head"}
#: Elements that do not end a head, and the white space that does not.
HEAD = {"head", "title", "meta", "link", "style", "script", "base", "noscript", "template"}
SPACE = " \t\n\f\r"
#: An open element that a start tag of the other kind closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ARTICLE = {"article", "main"}
NOISE_TAGS = {"nav", "aside", "footer", "header", "form", "menu", "dialog"}
NOISE = {"ad", "ads", "advert", "banner", "breadcrumb", "comment", "comments", "cookie", "footer", "header", "login", "menu", "nav", "navbar", "newsletter", "notice", "popup", "promo", "related", "reply", "share", "sidebar", "social", "sponsored", "subscribe", "widget"}


class Node:
    """A block element, or a leaf (tag ``#text``) with its text."""

    __slots__ = ("tag", "tokens", "children", "text", "linked", "main")

    def __init__(self, tag: str, tokens: tuple[str, ...] = (), text: str = "", linked: int = 0):
        self.tag, self.tokens, self.text, self.linked = tag, tokens, text, linked
        self.children: list[Node] = []
        self.main = False


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.skip: list[str] = []  # a skipped element and the open elements inside it
        self.links = 0
        self.run: list[str] = []
        self.run_linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.open[-1].children.append(Node("#text", (), text, min(self.run_linked, len(text))))
        self.run, self.run_linked = [], 0

    def handle_starttag(self, tag, attrs):
        if self.skip == ["head"] and tag not in HEAD:
            self.skip = []  # the end tag of a head may be left out
        if self.skip and tag in OPTIONS and self.skip[-1] in OPTIONS[tag]:
            self.skip.pop()  # as may that of an option
        if self.skip and tag in BLOCKS and not RAW.intersection(self.skip):
            self.skip = []  # no such element holds a block of text: its end tag is missing
        if self.skip or tag in SKIPPED:
            if tag not in VOID and not (tag == "head" and self.skip):
                self.skip.append(tag)
            return
        if tag == "a":
            self.links = 1
        if tag in INLINE:
            return
        self.flush()
        if tag in VOID:
            return
        self.links = 0
        if tag in CLOSES:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in CLOSES[tag]:
                    del self.open[k:]
                    break
                if self.open[k].tag in ("ul", "ol", "dl", "table"):
                    break
        elif self.open[-1].tag == "p":
            self.open.pop()
        tokens = tuple(t for k, v in attrs if k in ("class", "id", "role") and v for t in re.split(r"[^a-z]+", v.lower()) if t)
        node = Node(tag, tokens)
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIPPED:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag) :]
                return
            if tag in INLINE or all(n.tag != tag for n in self.open):
                return
            self.skip = []  # the end of an element around a skipped one ends both
        if tag == "a":
            self.links = 0
        if tag in INLINE or tag in VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self.flush()
                del self.open[k:]
                return

    def handle_data(self, data):
        if self.skip == ["head"] and data.strip(SPACE):
            self.skip = []
        if not self.skip:
            self.run.append(data)
            self.run_linked += self.links * len(data)


def parse(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    t.flush()
    return t.root


NUMBERS = 16


@dataclass
class Page:
    """Nodes of a page in page order: parents, numeric features, token sets (own and inherited), leaf texts."""

    parents: list[int] = field(default_factory=list)
    rows: list[list[float]] = field(default_factory=list)
    tokens: list[frozenset[str]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    main: list[bool] = field(default_factory=list)


def flatten(root: Node) -> Page:
    """Numeric features: subtree sizes and densities, position, depth, siblings."""
    page = Page()
    stats: list[list[float]] = []  # characters, linked, words, marks, elements, leaves, paragraphs, lists
    levels: list[int] = []

    # page order without recursion; sums are added up afterwards from the last node to the first
    todo = [(root, -1, 0, frozenset())]
    kids: list[list[int]] = []
    while todo:
        node, parent, depth, above = todo.pop()
        number = len(page.parents)
        own = above if node.tag == "#text" else above | {f"<{node.tag}>", *node.tokens}
        page.parents.append(parent)
        page.tokens.append(own)
        page.texts.append(node.text)
        page.main.append(node.main)
        levels.append(depth)
        kids.append([])
        if parent >= 0:
            kids[parent].append(number)
        t = node.text
        marks = t.count(".") + t.count(",") + t.count("!") + t.count("?")
        stats.append([len(t), node.linked, t.count(" ") + bool(t), marks, node.tag != "#text", bool(t), node.tag == "p", node.tag == "li"])
        todo += [(c, number, depth + 1, own) for c in reversed(node.children)]
    for i in range(len(stats) - 1, 0, -1):
        up = stats[page.parents[i]]
        for k, x in enumerate(stats[i]):
            up[k] += x
        if page.main[i]:
            page.main[page.parents[i]] = True
    total = max(stats[0][0], 1)
    before = 0
    for i, s in enumerate(stats):
        parent = page.parents[i]
        sibs = kids[parent] if parent >= 0 else [0]
        up = stats[parent] if parent >= 0 else s
        place = sibs.index(i) if len(sibs) < 64 else (i - sibs[0]) / max(sibs[-1] - sibs[0], 1) * len(sibs)
        page.rows.append([
            s[0], s[2], s[1] / max(s[0], 1), s[0] / (s[4] + 1), s[3] / max(s[2], 1), s[0] / max(s[5], 1), s[6], s[7],
            levels[i], s[0] / total, before / total, place, len(sibs), up[0] / len(sibs), up[1] / max(up[0], 1), s[0] / max(up[0], 1),
        ])
        before += len(page.texts[i])
    return page


@dataclass
class Model:
    """Boosted trees over binned features: per tree the features, cuts and leaf values of a full binary tree."""

    vocabulary: list[str]
    edges: list[np.ndarray]
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    base: float

    def matrix(self, pages: list[Page]) -> np.ndarray:
        index = {t: i for i, t in enumerate(self.vocabulary)}
        n = sum(len(p.rows) for p in pages)
        out = np.zeros((n, NUMBERS + len(index)), np.uint8)
        numbers = np.array([r for p in pages for r in p.rows], np.float32)
        for k, e in enumerate(self.edges):
            out[:, k] = np.searchsorted(e, numbers[:, k])
        known: dict[frozenset[str], list[int]] = {}
        at = 0
        for p in pages:
            for t in p.tokens:
                cols = known.get(t)
                if cols is None:
                    cols = known[t] = [NUMBERS + index[x] for x in t if x in index]
                out[at, cols] = 1
                at += 1
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def _boost(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Second-order gradient boosting of logistic loss with histograms, level by level."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    inner = 2**DEPTH - 1
    tokens = x[:, NUMBERS:].astype(np.float32)
    all_f, all_c, all_v = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p) + 1e-6
        feature, cut = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = at - first
            best = np.full(width, 1e-6)
            here = slice(first, first + width)
            gt, ht = (np.bincount(local, v, width)[:, None] for v in (g, h))

            def gains(gs: np.ndarray, hs: np.ndarray, gt=gt, ht=ht) -> np.ndarray:
                out = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                return np.where((hs < 2) | (ht - hs < 2), 0, out)

            for f in range(NUMBERS):
                key = local * BINS + x[:, f]
                gain = gains(*(np.bincount(key, v, width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (g, h)))
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better], feature[here][better], cut[here][better] = top[better], f, k[better]
            if x.shape[1] > NUMBERS:
                spread = np.zeros((len(y), 2 * width), np.float32)
                spread[np.arange(len(y)), local], spread[np.arange(len(y)), width + local] = g, h
                with_token = (tokens.T @ spread).astype(float)
                gain = gains(gt - with_token[:, :width].T, ht - with_token[:, width:].T)
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                feature[here][better], cut[here][better] = NUMBERS + k[better], 0
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += value[leaf]
        all_f.append(feature)
        all_c.append(cut)
        all_v.append(value)
    return np.array(all_f), np.array(all_c), np.array(all_v), base


def _mark(root: Node) -> bool:
    """Mark the leaves of main text from element kinds; False if the page has no article element."""
    found = False
    todo = [(root, False, False)]
    while todo:
        node, inside, noise = todo.pop()
        inside = inside or node.tag in ARTICLE
        noise = noise or node.tag in NOISE_TAGS or any(t in NOISE for t in node.tokens)
        node.main = bool(node.text) and inside and not noise
        found = found or inside
        todo += [(c, inside, noise) for c in node.children]
    return found


_BODY = [("div", ("content",)), ("div", ("post", "body")), ("section", ("story",)), ("div", ("entry",)), ("main", ()), ("div", ("article", "text")), ("td", ()), ("div", ())]
_EXTRA = [
    ("div", ("comments",), "div", ("comment",)), ("section", ("comment", "list"), "p", ()), ("aside", ("sidebar",), "li", ()), ("div", ("sidebar", "widget"), "li", ()),
    ("div", ("cookie", "notice"), "p", ()), ("div", ("notice",), "p", ()), ("form", ("newsletter", "subscribe"), "p", ()), ("div", ("related",), "li", ()),
    ("header", ("site", "header"), "p", ()), ("div", ("promo", "banner"), "p", ()), ("div", ("share", "social"), "li", ()), ("div", ("footer",), "p", ()), ("div", ("menu",), "li", ()),
]


def _varied(root: Node, texts: list[str], rng: random.Random) -> Node:
    """A copy of a marked page with other names and more blocks that are not main text."""

    def extra() -> Node:
        tag, tokens, inner, inner_tokens = rng.choice(_EXTRA)
        out = Node(tag, tokens if rng.random() < 0.8 else ())
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(texts).split(" ")
            at = rng.randrange(len(words))
            part = " ".join(words[at : at + rng.choice((2, 4, 8, 25, 60))])
            child = Node(inner, inner_tokens)
            child.children.append(Node("#text", (), part, len(part) if inner == "li" else 0))
            out.children.append(child)
        return out

    loose = rng.random() < 0.25  # the article's blocks stand among the page's own
    marked = rng.random() < 0.75  # attributes say what a block is

    def copy(node: Node) -> list[Node]:
        tag, tokens = node.tag, node.tokens if marked else ()
        if tag in ARTICLE:
            tag, tokens = rng.choice(_BODY)
            tokens = tokens if marked else ()
        elif tag in ("nav", "footer", "div") and rng.random() < 0.3 and tag != "#root":
            return []
        elif tag == "nav" and rng.random() < 0.6:
            tag, tokens = "div", rng.choice([("menu",), ("nav",), ("topbar",), ()])
        elif tag == "footer" and rng.random() < 0.6:
            tag, tokens = "div", rng.choice([("footer",), ("copyright",), ("bottom",), ()])
        elif tag == "h1" and rng.random() < 0.3:
            tag = rng.choice(["h2", "h3", "div"])
        out = Node(tag, tokens, node.text, node.linked)
        out.main = node.main
        out.children = [c for child in node.children for c in copy(child)]
        if node.tag in ARTICLE or tag == "body":
            for _ in range(rng.randint(0, 2)):
                out.children.insert(rng.choice((0, len(out.children), rng.randint(0, len(out.children)))), extra())
        if node.tag in ARTICLE and loose:
            return out.children
        if node.tag in ARTICLE:
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                wrap = Node("div", rng.choice([("wrap",), ("container",), ("page",), ("row",), ()]))
                wrap.children = [out]
                if rng.random() < 0.4:
                    wrap.children.insert(rng.choice((0, 1)), extra())
                out = wrap
        return [out]

    return copy(root)[0]


def train(htmls: list[str], seed: int = 3) -> Model | None:
    """Fit on pages that mark their article; None if there are none."""
    rng = random.Random(seed)
    roots = [r for r in map(parse, htmls) if _mark(r)]
    if not roots:
        return None
    plain = [flatten(r) for r in roots]
    texts = [t for p in plain for t in p.texts if t] or ["-"]
    # the pages as they are weigh as much as their variants
    pages = 4 * plain + [flatten(_varied(r, texts, rng)) for r in roots for _ in range(4)]
    seen = Counter(t for p in pages for t in frozenset().union(*p.tokens))
    vocabulary = [t for t, n in sorted(seen.items(), key=lambda kv: (-kv[1], kv[0])) if n >= 3][:MAX_TOKENS]
    numbers = np.array([r for p in pages for r in p.rows], np.float32)
    edges = [np.unique(np.quantile(numbers[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(NUMBERS)]
    model = Model(vocabulary, edges, np.empty(0), np.empty(0), np.empty(0), 0.0)
    y = np.array([m for p in pages for m in p.main], float)
    if y.min() == y.max():
        return None
    model.features, model.cuts, model.leaves, model.base = _boost(model.matrix(pages), y)
    return model


def decode(parents: list[int], logits: np.ndarray) -> np.ndarray:
    """The likeliest labels in which every node with main text has a parent with main text."""
    n = len(parents)
    yes, no = -np.logaddexp(0, -logits), -np.logaddexp(0, logits)
    for i in range(n - 1, 0, -1):  # children come after their parents
        yes[parents[i]] += max(yes[i], no[i])
        no[parents[i]] += no[i]
    out = np.zeros(n, bool)
    for i in range(n):
        out[i] = yes[i] > no[i] and (i == 0 or out[parents[i]])
    return out


def extract(htmls: list[str], model: Model | None) -> list[str]:
    pages = [flatten(parse(h)) for h in htmls]
    if model is None:
        return [" ".join(t for t in p.texts if t) for p in pages]
    logits = model.logits(model.matrix(pages)) if pages else np.empty(0)
    out, at = [], 0
    for p in pages:
        keep = decode(p.parents, logits[at : at + len(p.parents)])
        out.append(" ".join(t for t, k in zip(p.texts, keep) if t and k))
        at += len(p.parents)
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = MAX_PAGES, max_chars: int = MAX_CHARS) -> Model | None:
    """Fit on the ``max_pages`` ids with the smallest hash (of an id with several pages the smallest), ``max_chars`` characters in all."""
    rows = pages.select(F.col(id_col).cast("long").alias("doc_id"), F.col(html_col).cast("string").alias("h")).where("h is not null and doc_id is not null")
    chosen = hashed_sample(rows.select("doc_id"), max_pages).collect()  # distinct ids only, bounded by max_pages
    if not chosen:
        return None
    ids = pages.sparkSession.createDataFrame([(r.doc_id,) for r in chosen], "doc_id long")
    one = rows.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("h").alias("h"))
    # whole pages from the shortest on while they fit (a window over at most max_pages rows), the shortest one always
    by = Window.orderBy("size", "doc_id")
    fits = one.withColumn("size", F.length("h")).select("*", F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"), F.row_number().over(by).alias("nth"))
    sample = fits.where((F.col("sum") <= max_chars) | (F.col("nth") == 1)).select("doc_id", "h").collect()
    return train([r.h for r in sorted(sample, key=lambda r: r.doc_id)])


def main_text(pages: DataFrame, model: Model | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", 1 << 20):
            text = extract(strings(b.column("html")), model)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(step, "page_id long, url string, text string, n_chars long")
