"""HTML extraction: boosted trees over DOM-node features, decoded along the tree.

A page becomes a tree of block elements; its leaves are runs of text between
block boundaries.  Each node gets features: sizes, link share and density of
its subtree, its depth and place, its siblings, its tag and its attribute
tokens, and which kinds of elements hold it.  Gradient-boosted trees give each
node the probability p that it holds main text.

Decoding.  A node is kept or dropped; a dropped node drops its whole subtree, so
no kept node lies in a dropped one.  Dropping costs the sum of log(1 - p) over
the subtree, keeping log p plus the best of each child; the best labelling
comes from one pass from the leaves up.  The text is the kept leaves in page order,
one per line, white space inside one turned into single spaces.

Training.  The labels are known by construction: passages of about ``SAMPLE``
pages, drawn by the hash of the id (of at most ``SAMPLE_CHARS`` characters), are laid
out as ``LAYOUTS`` pages in many ways, with menus, headers, footers, sidebars,
notices, adverts, forms and comments around the article, whose tags and
class names are often without meaning; the sampled pages that have one
``article`` element take part as they are.  The seed is fixed, the sample and
the model are of a fixed size; training runs on the driver.

Cases: a null or empty html, or one without text, gives an empty text.
Unclosed and stray tags are tolerated; a page cut off in a tag or a character
reference is read as far as it goes.  Repeated rows are extracted alike.  On an
empty table nothing is read; the model then learns from invented passages.
"""

from __future__ import annotations

import html as htmllib
import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample

SAMPLE = 300
SAMPLE_CHARS = 50_000
LAYOUTS = 600

#: Fixed values of HTML: elements that are blocks, that are void, whose text is not page text.
BLOCKS = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre section select
summary table tbody td textarea tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("audio canvas head iframe noscript object script style svg template title video".split())
#: Of these the rest of the page is text without an end tag; the others end with their parent at the latest.
RAW = set("script style template title".split())
#: An open element of the first kind ends when one of the second starts, unless one of the third lies between.
IMPLIED = {
    "p": (BLOCKS - {"button", "label", "option", "optgroup", "select", "textarea"}, {"td", "th", "button", "table", "body"}),
    "li": ({"li"}, {"ul", "ol", "menu", "body"}),
    "dt": ({"dt", "dd"}, {"dl", "body"}),
    "dd": ({"dt", "dd"}, {"dl", "body"}),
    "option": ({"option", "optgroup"}, {"select", "body"}),
    "tr": ({"tr", "tbody", "tfoot"}, {"table", "body"}),
    "td": ({"td", "th", "tr", "tbody"}, {"table", "body"}),
    "th": ({"td", "th", "tr", "tbody"}, {"table", "body"}),
    "head": ({"body"}, set()),
}
ENDED_BY: dict[str, list[tuple[str, set[str]]]] = {}
for _open, (_starts, _bounds) in IMPLIED.items():
    for _start in _starts:
        ENDED_BY.setdefault(_start, []).append((_open, _bounds))

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>?""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]++)\s*+(?:=\s*+("[^"]*+"?|'[^']*+'?|[^\s"'>]++))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Attribute tokens by what they commonly name.
NAMES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager skip tabs crumbs links",
    "header": "header masthead topbar logo brand tagline site banner hero",
    "footer": "footer foot copyright legal colophon bottom imprint",
    "side": "sidebar side aside rail widget related recommended popular trending secondary more teaser",
    "notice": "notice cookie cookies consent gdpr alert popup modal newsletter subscribe paywall overlay toast message privacy warning dialog",
    "advert": "ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion promoted dfp outbrain taboola",
    "form": "form search login signup signin register contact input field submit",
    "comment": "comment comments commentlist disqus reply replies respond discussion responses feedback reviews thread",
    "social": "share sharing social follow tags byline meta author print rating",
    "main": "article content main post entry story body text page primary prose",
}
TOKENS = {t: k for k, ts in NAMES.items() for t in ts.split()}
KINDS = list(NAMES)
TAGS = """address article aside blockquote body button dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 header label
legend li main menu nav ol option p pre section select table td textarea th tr ul""".split()
TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
HOLDERS = ["article", "aside", "footer", "form", "header", "main", "nav", "ul", "table"]
HOLDER_NUMBER = {t: i for i, t in enumerate(HOLDERS)}
SIZES = 22
#: Buckets of hashed attribute tokens; after them a bit for hidden elements.
HASHED = 64
HASH_PARTS = ((0, 32), (32, 32), (64, 1))
FEATURES = SIZES + len(TAGS) + 3 * len(KINDS) + len(HOLDERS) + HASHED + 1


class Page:
    """The nodes of a page, in document order; node 0 is the root."""

    def __init__(self) -> None:
        self.tag, self.parent, self.kinds, self.hashed, self.mark = ["#root"], [-1], [0], [0], [""]
        self.text: list[str | None] = [None]
        self.link = [0]  # characters of a leaf that lie in links

    def add(self, tag: str, parent: int, kinds: int = 0, hashed: int = 0, mark: str = "", text: str | None = None, link: int = 0) -> int:
        for column, value in ((self.tag, tag), (self.parent, parent), (self.kinds, kinds), (self.hashed, hashed),
                              (self.mark, mark), (self.text, text), (self.link, link)):
            column.append(value)
        return len(self.tag) - 1


def _attributes(raw: str) -> tuple[int, int, str]:
    """Kinds of names as bits, hashed tokens as bits, and the training mark."""
    kinds = hashed = 0
    mark = ""
    for name, value in ATTRIBUTE.findall(raw):
        name = name.lower()
        if name == "data-label":
            mark = value.strip("\"'")
        elif name in ("class", "id", "role", "itemprop"):
            for w in WORD.findall(value):
                w = w.lower()
                if w in TOKENS:
                    kinds |= 1 << KINDS.index(TOKENS[w])
                hashed |= 1 << zlib.crc32(w.encode()) % HASHED
        elif name in ("hidden", "aria-hidden"):
            hashed |= 1 << HASHED
    return kinds, hashed, mark


def parse(source: str | None) -> Page:
    page, source = Page(), source or ""
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and their nodes; inline elements have their block's
    places: dict[str, list[int]] = defaultdict(list)  # of each tag, where it is open in the stack
    blocks = [0]  # where blocks are
    ends: dict[str, int] = {}  # the next end tag of a silent element, as far as it was looked for
    run: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                at = stack[-1][1]
                page.add("#text", at, text=text, link=min(linked, len(text)))
            run, linked = [], 0

    def enter(name: str, node: int) -> None:
        places[name].append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        stack.append((name, node))

    def close(at: int) -> None:
        """End the open elements from ``at`` on."""
        nonlocal links
        if blocks[-1] >= at:
            flush()
        while len(stack) > at:
            name, _ = stack.pop()
            places[name].pop()
            if name in BLOCKS:
                blocks.pop()
            links -= name == "a"

    def heard(piece: str) -> None:
        nonlocal linked
        piece = htmllib.unescape(piece)     # a reference does not reach over a tag
        run.append(piece)
        if links:
            linked += len(piece)

    def silent_end(name: str, place: int) -> int:
        """Where a silent element ends; ``place`` itself if it isn't closed in its parent."""
        if ends.get(name, -1) < place:
            over = re.compile(rf"</{re.escape(name)}(?![A-Za-z])[^>]*>?", re.I).search(source, place)
            ends[name] = over.end() if over else len(source) + 1
        over = ends[name]
        if name in RAW:
            return min(over, len(source))
        if over > len(source):
            return place
        parent, depth = stack[blocks[-1]][0], 0
        if len(blocks) > 1:
            for m in re.compile(rf"<(/?){parent}(?![A-Za-z0-9])", re.I).finditer(source, place, over):
                depth += -1 if m[1] else 1
                if depth < 0:
                    return place
        return over

    place, end = 0, len(source)
    while place < end:
        m = TAG.search(source, place)
        if m is None:
            heard(source[place:])
            break
        if m.start() > place:
            heard(source[place:m.start()])
        place = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, raw = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            at = places[name][-1] if places.get(name) else 0
            if at and (name in BLOCKS or at > blocks[-1]):
                close(at)
            continue
        if name in SILENT:
            if name != "head" and not raw.endswith("/"):
                place = silent_end(name, place)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                run.append(" ")
            if name == "hr":
                flush()
            continue
        for ended, bounds in ENDED_BY.get(name, ()):
            at = places[ended][-1] if places.get(ended) else 0
            if at and not any(places[t][-1] > at for t in bounds if places.get(t)):
                close(at)
        if name in BLOCKS:
            flush()
            enter(name, page.add(name, stack[-1][1], *_attributes(raw)))
        else:
            links += name == "a"
            enter(name, stack[-1][1])
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    leaf = np.array([t is not None for t in page.text])
    own = np.array([len(t) if t else 0 for t in page.text], float)
    size = own.copy()
    link = np.array(page.link, float)
    stops = np.array([sum(map(t.count, ".,;:!?")) if t else 0 for t in page.text], float)
    runs, elements = leaf.astype(float), (~leaf).astype(float)
    paragraphs = np.array([t == "p" for t in page.tag], float)
    items = np.array([t in ("li", "td", "option") for t in page.tag], float)
    depth, order, children = np.zeros(n), np.zeros(n), np.zeros(n)
    before = np.concatenate([[0], np.cumsum(own)[:-1]])
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
        order[i] = children[parent[i]]
        children[parent[i]] += 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for sums in (size, link, stops, runs, elements, paragraphs, items):
            sums[p] += sums[i]
    up = np.maximum(parent, 0)
    total = max(1.0, size[0])
    siblings = np.maximum(children[up], 1)
    largest = np.zeros(n)
    np.maximum.at(largest, up[1:], size[1:])
    previous, following = np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        p = page.parent[i]
        if p in last:
            previous[i], following[last[p]] = size[last[p]], size[i]
        last[p] = i
    x = np.zeros((n, FEATURES), np.float32)
    x[:, :SIZES] = np.stack([
        leaf, np.log1p(size), link / np.maximum(size, 1), stops / (size + 1), size / np.maximum(runs, 1), np.log1p(elements),
        size / (elements + 1), depth, order, siblings, order / siblings, before / total, size / total, size[up] / total,
        link[up] / np.maximum(size[up], 1), size / np.maximum(largest[up], 1), np.log1p(previous), np.log1p(following),
        paragraphs / np.maximum(runs, 1), items / np.maximum(runs, 1), paragraphs, np.full(n, np.log1p(total))], axis=1)
    kinds = np.array(page.kinds)
    around, held = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(1, n):
        p = page.parent[i]
        around[i] = around[p] | page.kinds[p]
        held[i] = held[p] | (1 << HOLDER_NUMBER[page.tag[i]] if page.tag[i] in HOLDER_NUMBER else 0)
    inside = kinds.copy()
    for i in range(n - 1, 0, -1):
        inside[parent[i]] |= inside[i]
    at = SIZES
    for i, t in enumerate(page.tag):
        t = page.tag[page.parent[i]] if t == "#text" else t
        if t in TAG_NUMBER:
            x[i, at + TAG_NUMBER[t]] = 1
    at += len(TAGS)
    for bits, width in ((np.where(leaf, kinds[up], kinds), len(KINDS)), (around, len(KINDS)), (inside, len(KINDS)),
                        (held, len(HOLDERS)), *[(np.array([h >> k & 0xFFFFFFFF for h in page.hashed]), w) for k, w in HASH_PARTS]):
        x[:, at:at + width] = bits[:, None] >> np.arange(width) & 1
        at += width
    return x


class Tree(NamedTuple):
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray


class BoostedTrees:
    """Logistic boosting of complete trees of one depth over binned features;
    each tree sees half the rows and half the features."""

    def __init__(self, trees: int = 60, depth: int = 5, rate: float = 0.2, bins: int = 32, shrink: float = 1.0):
        self.n, self.depth, self.rate, self.bins, self.shrink = trees, depth, rate, bins, shrink
        self.trees: list[Tree] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        every, width_all = x.shape
        n, f, r = every // 2 or every, width_all // 2, np.random.default_rng(1)
        edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(width_all)]
        binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1).astype(np.int32)
        share = y.mean().clip(0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(every, self.base)
        columns = np.arange(f, dtype=np.int32) * self.bins
        for _ in range(self.n):
            rows, seen = r.choice(every, n, replace=False), r.choice(width_all, f, replace=False)
            part, cells = x[rows], binned[rows[:, None], seen] + columns
            p = 1 / (1 + np.exp(-score[rows]))
            g, h = p - y[rows], p * (1 - p)
            gr, hr = np.repeat(g, f), np.repeat(h, f)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                key = ((node * f * self.bins)[:, None] + cells).ravel()
                shape = (width, f, self.bins)
                gs = np.bincount(key, gr, width * f * self.bins).reshape(shape)
                hs = np.bincount(key, hr, width * f * self.bins).reshape(shape)
                gl, hl = gs.cumsum(axis=2)[:, :, :-1], hs.cumsum(axis=2)[:, :, :-1]
                ga, ha = gs.sum(axis=2, keepdims=True), hs.sum(axis=2, keepdims=True)
                gain = gl**2 / (hl + self.shrink) + (ga - gl)**2 / (ha - hl + self.shrink)
                gain[(hl < 1) | (ha - hl < 1)] = -1
                best = gain.reshape(width, -1).argmax(axis=1)
                for k in range(width):
                    which, at = divmod(int(best[k]), self.bins - 1)
                    real = int(seen[which])
                    if gain[k, which, at] > (ga[k, which]**2 / (ha[k, which] + self.shrink)).item() + 1e-6 and at < len(edges[real]):
                        feature[first + k], cut[first + k] = real, edges[real][at]
                here = first + node
                node = 2 * node + (part[np.arange(n), feature[here]] > cut[here])
            leaves = 1 << self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.shrink)
            self.trees.append(Tree(feature, cut, value))
            score += self._value(self.trees[-1], x)
        return self

    def _value(self, tree: Tree, x: np.ndarray) -> np.ndarray:
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for level in range(self.depth):
            here = (1 << level) - 1 + node
            node = 2 * node + (x[rows, tree.feature[here]] > tree.cut[here])
        return tree.value[node]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return sum((self._value(t, x) for t in self.trees), np.full(len(x), self.base))


def decode(page: Page, odds: np.ndarray) -> list[str]:
    """The leaves that the best consistent labelling keeps."""
    keep = (-np.logaddexp(0, -odds)).tolist()
    drop = (-np.logaddexp(0, odds)).tolist()
    keep[0] = 0.0
    for i in range(len(keep) - 1, 0, -1):
        p = page.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] * len(keep)
    for i in range(1, len(keep)):
        kept[i] = kept[page.parent[i]] and keep[i] > drop[i]
    return [t for t, k in zip(page.text, kept) if t is not None and k]


def labels(page: Page) -> np.ndarray:
    """1 for the nodes that hold a leaf of the article: a leaf is main if the
    nearest marked element around it is marked ``main``."""
    state = ["drop"] * len(page.tag)
    y = np.zeros(len(page.tag))
    for i in range(1, len(page.tag)):
        state[i] = page.mark[i] or state[page.parent[i]]
        y[i] = page.text[i] is not None and state[i] == "main"
    for i in range(len(y) - 1, 0, -1):
        y[page.parent[i]] = max(y[page.parent[i]], y[i])
    return y


class Layout:
    """Pages laid out at random from passages, with marks."""

    def __init__(self, seed: int, passages: list[str]):
        self.r = random.Random(seed)
        self.sentences = [s for p in passages for s in re.findall(r"[^.!?]+[.!?]?", p) if len(s) > 15][:20_000]
        while len(self.sentences) < 500:
            self.sentences.append(" ".join("".join(self.r.choices("abcdefghilmnoprstu", k=self.r.randint(2, 9))) for _ in range(self.r.randint(5, 15))) + ".")

    def some(self, low: int, high: int) -> str:
        return htmllib.escape(" ".join(self.r.choice(self.sentences).strip() for _ in range(self.r.randint(low, high))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.some(1, 1).split()[:self.r.randint(low, high)]) or "more"

    def wrap(self, inner: str, tags: str, names: str, mark: str = "") -> str:
        """An element with one of the tags and names, the names in a third of the cases without meaning."""
        r, tag = self.r, self.r.choice(tags.split())
        name = r.choice(names.split()) if r.random() < 0.67 or tag in ("div", "section") and r.random() < 0.5 else f"{r.choice('bcjx')}{r.randint(1, 99)}"
        attribute = r.choice(["", f' class="{name}"', f' class="{name}"', f' class="{r.choice(["row", "col-8", "wrap"])} {name}"', f' id="{name}"'])
        return f"<{tag}{attribute}{f' data-label={mark!r}' if mark else ''}>{inner}</{tag}>"

    def links(self, n: int) -> str:
        out = "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(n))
        return self.r.choice([f"<ul>{out}</ul>", f"<ul>{out}</ul>", re.sub("</?li>", " ", out), f"<ol>{out}</ol>"])

    def menu(self) -> str:
        return self.wrap(self.links(self.r.randint(3, 12)), "nav nav div", "nav menu navbar main-menu breadcrumbs toc")

    def advert(self) -> str:
        inner = self.some(1, 2)
        return self.wrap(self.r.choice([inner, f"<p>{inner}</p>", f'<a href="/x">{inner}</a>']), "div div aside ins section", "ad ads advert sponsored promo banner-ad")

    def notice(self) -> str:
        return self.wrap(f"<p>{self.some(1, 2)}</p>" + self.r.choice(["", "<button>OK</button>", '<a href="/privacy">more</a>']),
                         "div div aside section dialog p", "notice cookie-notice consent alert newsletter popup cookie-banner")

    def form(self) -> str:
        return (f'<form action="/s">{self.r.choice(["", f"<p>{self.some(1, 1)}</p>", f"<h3>{self.words(2, 4)}</h3>"])}<label>{self.words(1, 3)}</label><input name="q">'
                + self.r.choice(["", f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>", f"<textarea>{self.words(2, 5)}</textarea>"])
                + f"<button>{self.words(1, 2)}</button></form>")

    def sidebar(self) -> str:
        parts = [f"<h3>{self.words(1, 4)}</h3>{self.links(self.r.randint(3, 8))}", f"<p>{self.some(1, 3)}</p>", self.advert(),
                 f"<div><h4>{self.words(1, 4)}</h4><p>{self.some(1, 2)}</p></div>"]
        return self.wrap("".join(self.r.sample(parts, self.r.randint(1, 3))), "aside aside div section", "sidebar side related widget rail")

    def comments(self) -> str:
        one = lambda: self.r.choice(["<div class='comment'><p>{}</p></div>", "<li><p>{}</p></li>", "<div><b>{w}</b><p>{}</p></div>", "<p>{}</p>", "<article class='comment'><p>{}</p></article>"]).format(self.some(1, 4), w=self.words(1, 2))
        body = "".join(one() for _ in range(self.r.randint(1, 8)))
        return self.wrap(self.r.choice(["", f"<h3>{self.words(1, 3)}</h3>", "<h2>Comments</h2>"]) + body + (self.form() if self.r.random() < 0.3 else ""),
                         "section div div ol", "comments comment-list discussion responses commentlist replies")

    def header(self) -> str:
        inner = f"<{(t := self.r.choice(['h1', 'h2', 'div', 'p', 'a']))}>{self.words(1, 5)}</{t}>" + self.r.choice(["", f"<p>{self.some(1, 1)}</p>", self.menu()])
        return self.wrap(inner, "header header div", "header site-header masthead topbar")

    def footer(self) -> str:
        inner = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.some(1, 2)}", f"<p>{self.some(1, 3)}</p>", self.links(4) + f"<p>&copy; {self.words(1, 4)}</p>"])
        return self.wrap(inner, "footer footer div", "footer site-footer legal copyright")

    def block(self) -> str:
        r, k = self.r, self.r.random()
        if k < 0.62:
            text = self.some(1, 6)
            if r.random() < 0.25:
                w = text.split(" ")
                at = r.randrange(len(w))
                w[at] = r.choice(['<a href="/y">{}</a>', "<b>{}</b>", "<em>{}</em>", "{}<br>"]).format(w[at])
                text = " ".join(w)
            return r.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<div>{text}</div>", f"<p><b>{text}<br>"])
        if k < 0.74:
            return f"<h{(n := r.choice('2234'))}>{self.words(2, 8)}</h{n}>"
        if k < 0.84:
            return "<ul>" + "".join(f"<li>{self.some(1, 2)}" for _ in range(r.randint(2, 6))) + "</ul>"
        if k < 0.9:
            return f"<blockquote>{r.choice(['', '<p>'])}{self.some(1, 3)}</blockquote>"
        if k < 0.95:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 5))) + "</table>"
        return f"<figure><img src='/i.png'><figcaption>{self.some(1, 1)}</figcaption></figure>" if k < 0.98 else f"<pre>{self.some(1, 3)}</pre>"

    def article(self) -> str:
        r = self.r
        title = f"<h1>{self.words(3, 12)}</h1>"
        parts = [r.choice([title, title, "", f"<header>{title}</header>"])] + [self.block() for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25]))]
        if not re.search("<(p|div|li|blockquote)", "".join(parts[1:])):
            parts.append(f"<p>{self.some(2, 5)}</p>")
        for extra in (self.advert, self.sidebar, self.form, self.notice, self.menu):
            if r.random() < 0.08:
                parts.insert(r.randint(1, len(parts)), self.wrap(extra(), "div", "inset", "drop"))
        if r.random() < 0.1:
            parts.append(self.wrap(self.comments(), "div", "after", "drop"))
        return self.wrap("".join(parts), r.choice(["article", "article", "article", "main", "div", "div", "section"]),
                         "article content post entry story main-content article-body", "main")

    def page(self) -> str:
        r = self.r
        maybe = lambda p, f: [f()] if r.random() < p else []
        top = maybe(0.5, self.header) + maybe(0.7, self.menu) + maybe(0.3, self.notice) + maybe(0.3, self.form) + maybe(0.5, self.advert)
        r.shuffle(top)
        middle = maybe(0.25, self.sidebar) + [self.article()] + maybe(0.4, self.sidebar) + maybe(0.4, self.comments) + maybe(0.2, self.advert)
        inner = "".join(middle)
        for _ in range(r.choice([0, 0, 1, 2])):
            inner = self.wrap(inner, "div div main", "wrap container layout page row")
        bottom = maybe(0.15, self.notice) + maybe(0.15, self.comments) + maybe(0.75, self.footer) + maybe(0.1, self.advert)
        return f"<!DOCTYPE html><html><head><title>{self.words(3, 8)}</title></head><body>{''.join(top)}{inner}{''.join(bottom)}</body></html>"


def train(sample: list[str]) -> BoostedTrees:
    """A model from sampled pages: as they are, and their passages laid out anew."""
    pages, passages = [], []
    for source in sample:
        parsed = parse(source)
        if parsed.tag.count("article") == 1:
            parsed.mark[parsed.tag.index("article")] = "main"
            pages.append(parsed)
            y = labels(parsed)
            passages += [t for t, m in zip(parsed.text, y) if t and m]
        else:
            passages += [t for t in parsed.text if t]
    layout = Layout(17, passages)
    pages += [parse(layout.page()) for _ in range(LAYOUTS)]
    return BoostedTrees().fit(np.concatenate([features(p)[1:] for p in pages]), np.concatenate([labels(p)[1:] for p in pages]))


def extract_texts(sources: list[str | None], model: BoostedTrees) -> list[str]:
    pages = [parse(s) for s in sources]
    rows = [features(p) for p in pages]
    if not rows:
        return []
    odds, at, out = model.log_odds(np.concatenate(rows)), 0, []
    for p, x in zip(pages, rows):
        out.append("\n".join(decode(p, odds[at:at + len(x)])))
        at += len(x)
    return out


def fit_model(pages: DataFrame) -> BoostedTrees:
    sample = (hash_sample(pages.select("page_id", "html"), SAMPLE, "page_id")
              .where(F.length("html") <= SAMPLE_CHARS).select("html").limit(2 * SAMPLE).collect())
    return train(sorted(r["html"] for r in sample))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = pages.sparkSession.sparkContext.broadcast(fit_model(pages))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # a few pages' nodes at a time
                part = batch.slice(at, 64)
                texts = extract_texts(part.column(2).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
