"""Main-text extraction by boosted trees over DOM nodes (operator 10).

A page is read into a tree of block elements.  Every node gets features of its tag and
attribute tokens, its depth, the density and link share of its subtree, and its place
among its siblings; gradient-boosted trees give the probability that it is main text.
Decoding takes the best labelling of the whole tree in which a node is above the main text,
in it, or noise: below noise there is only noise, and below main text there is no way back
to "above", so an ancestor and a descendant never contradict each other.  The text of the
nodes in the main text is given out block by block.

Trees are fitted on a bounded sample: at most ``sample_pages`` pages and ``sample_nodes``
(60,000) of their nodes, both in the order of a hash, whose nodes are labelled where their markup tells (article and main against navigation,
footer, form and the like), and ``TEMPLATES`` pages made by rule that show sidebars,
notices, forms and reader comments, with and without telling markup.  Each sample page is
also used with its telling tags and tokens taken away, so that density and place are learned.

Defined cases: a null or empty html, or one without main text, gives the empty text; broken
markup is read as browsers do in the main (open elements end with their parent, an
unfinished comment or script runs to the end of the page; contents of svg, select
and object are noise up to the closing tag; without one, and in svg in any case, the next block
or the end of an element around ends them; an svg that closes itself is empty); null ids and urls and repeated
rows are rows like any other; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

SAMPLE_PAGES = 1500
SAMPLE_NODES = 60_000
TEMPLATES = 120
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe".split())
NOISE_TAGS = frozenset(["select", "object"])
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var".split())
#: Elements that a new one of the same group ends, and the containers that the search stops at.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body div article main section nav footer header aside form table ul ol dl blockquote td th".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BLOCK = ENDS_P | SCOPE | CLOSES.keys() - {"option"} | {"head", "figure", "figcaption", "details", "summary"}
#: What ends an svg before its closing tag, as browsers do.
BREAKS_OUT = BLOCK | frozenset("b big br center code em embed i img listing menu meta nobr ruby s small span strike strong sub sup tt u var".split())
TAGS = ["html", "body", "head", "div", "section", "article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li",
        "table", "tr", "td", "th", "pre", "blockquote", "figure", "figcaption", "nav", "footer", "header", "aside", "form",
        "button", "fieldset", "dl", "dt", "dd", "details", "summary", "address"]
TAG_ID = {t: i for i, t in enumerate(TAGS)}
GOOD_TAGS, BAD_TAGS = frozenset(["article", "main"]), frozenset("nav footer aside form button fieldset head".split())
GOOD_TOKENS = frozenset("article articlebody main content post story entry body text".split())
BAD_TOKENS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disqus "
    "footer form header legal login masthead menu modal nav navbar navigation newsletter notice notification pager "
    "pagination popup promo promotion recommended related search share sharing sidebar signup social sponsor sponsored "
    "subscribe tags toolbar widget reply replies respond complementary contentinfo alert".split())
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)").match
_SPECIAL = re.compile(r"[>\"']").search
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE).search for name in RAW}
_ATTR = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE).findall
_TOKENS = re.compile(r"[a-z]+").findall
_PUNCT = re.compile(r"[.,;:!?]").findall


class Page:
    """Nodes in document order: tag, parent, depth, last descendant, own and link characters,
    marks of punctuation, attribute tokens; and the pieces of text with the node they stand in."""

    def __init__(self):
        self.tag, self.parent, self.depth, self.last = [-1], [-1], [0], [0]
        self.chars, self.link, self.punct, self.good, self.bad, self.gold = [0], [0], [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # node, break counter, text


class Source:
    """A page's markup, read tag by tag.  Every method takes time in proportion to what it
    passes over: what cannot be a tag is remembered and not tried twice."""

    def __init__(self, text: str):
        self.text = text
        self.dead: set[int] = set()  # quotes from which no ">" is reached outside quotes
        self.ends: dict[str, dict[int, int]] = {}
        self.gt = (0, -1)  # from the first place to the second there is no ">" but at the second

    def next_gt(self, at: int) -> int:
        """The first ">" from ``at`` on, -1 if there is none."""
        if not self.gt[0] <= at <= self.gt[1]:
            end = self.text.find(">", at)
            if end < 0:
                self.gt = (at, len(self.text))
            else:
                self.gt = (at, end)
        return self.gt[1] if self.gt[1] < len(self.text) else -1

    def tag(self, lt: int) -> tuple[int, str, str, str] | None:
        """End, slash, name and attributes of the tag at ``lt``: up to the first ">" outside quotes,
        or up to the first of all if the quotes do not close."""
        m = _NAME(self.text, lt)
        if m is None:
            return None
        at, met = m.end(), []
        while True:
            special = _SPECIAL(self.text, at)
            if special is None or special.start() in self.dead:
                break
            c = special.start()
            if self.text[c] == ">":
                return c + 1, m.group(1), m.group(2).lower(), self.text[m.end():c]
            met.append(c)
            close = self.text.find(self.text[c], c + 1)
            if close < 0:
                break
            at = close + 1
        self.dead.update(met)
        gt = self.next_gt(m.end())
        return None if gt < 0 else (gt + 1, m.group(1), m.group(2).lower(), self.text[m.end():gt])

    def marks(self, at: int) -> Iterator[tuple[int, int, str, str, str]]:
        """Start, end, slash, name and attributes of every tag from ``at`` on, but for those in
        comments and raw-text elements."""
        while (lt := self.text.find("<", at)) >= 0:
            if self.text.startswith("<!--", lt):
                end = self.text.find("-->", lt + 4)
                at = len(self.text) if end < 0 else end + 3
                continue
            found = self.tag(lt)
            if found is None:
                if self.next_gt(lt) < 0:
                    return
                at = lt + 1
                continue
            at, slash, name, attrs = found
            if name in RAW and not slash:
                end = _RAW_END[name](self.text, at)
                at = end.end() if end else len(self.text)
                continue
            yield lt, at, slash, name, attrs

    def closed(self, name: str, at: int) -> int | None:
        """Where the closing tag ends of the element of that name whose contents begin at ``at``; all
        elements of the name from the first one on are paired in one pass."""
        if name not in self.ends:
            opened, ends = [at], {}
            for _, end, slash, tag, attrs in self.marks(at):
                if tag == name:
                    if not slash:
                        if name != "svg" or not attrs.endswith("/"):
                            opened.append(end)
                    elif opened:
                        ends[opened.pop()] = end
            self.ends[name] = ends
        return self.ends[name].get(at)

    def svg_end(self, at: int) -> int:
        """Where the contents of an svg end that begin at ``at``: at its closing tag, or before it at
        a tag that breaks out of it; without a closing tag, at the first such tag even in foreign content."""
        closing, within = self.closed("svg", at), Counter()
        for start, end, slash, name, attrs in self.marks(at):
            if closing is not None and end >= closing:
                return closing
            if name in BREAKS_OUT if not slash else name in BREAKS_OUT | INLINE and not within[name]:
                if closing is None or not within["foreignobject"]:
                    return start
            if slash:
                within[name] -= within[name] > 0
            elif name not in VOID and not attrs.endswith("/"):
                within[name] += 1
        return len(self.text)

    def block(self, at: int) -> int:
        return next((start for start, _, _, name, _ in self.marks(at) if name in BLOCK), len(self.text))


class Open:
    """The open elements as a stack of (name, node), with the places of each name, of the elements
    that are not inline, and of those that end a search for an element to close."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.push("", 0)

    def _of(self, name: str) -> list[list[int]]:
        own = [self.places.setdefault(name, [])]
        return own + [self.blocks] * (name not in INLINE) + [self.scopes] * (name in SCOPE)

    def push(self, name: str, node: int) -> None:
        for places in self._of(name):
            places.append(len(self.stack))
        self.stack.append((name, node))

    def pop(self) -> tuple[str, int]:
        for places in self._of(self.stack[-1][0]):
            places.pop()
        return self.stack.pop()

    def last(self, name: str) -> int:
        """Place of the innermost element of a name, 0 if there is none."""
        return (self.places.get(name) or (0,))[-1]


def parse(source: str) -> Page:
    page, marks, opened, links, at, breaks = Page(), Source(source), Open(), 0, 0, 0
    stack = opened.stack

    def text(raw: str) -> None:
        if raw:
            s = entities.unescape(raw) if "&" in raw else raw
            node, n = stack[-1][1], len(s) - s.count(" ")
            page.pieces.append((node, breaks, s))
            page.chars[node] += n
            page.link[node] += n if links else 0
            page.punct[node] += len(_PUNCT(s))

    def close(depth: int) -> None:
        nonlocal links, breaks
        while len(stack) > depth:
            name, node = opened.pop()
            links -= name == "a"
            if name not in INLINE:
                breaks += 1
            page.last[node] = len(page.tag) - 1

    while True:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        if source.startswith("<!--", lt):
            text(source[at:lt])
            end = source.find("-->", lt + 4)
            at = len(source) if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), lt):
            text(source[at:lt])
            end = source.find(">", lt)
            at = len(source) if end < 0 else end + 1
            continue
        found = marks.tag(lt)
        if found is None:
            if marks.next_gt(lt) < 0:  # no further tag
                text(source[at:])
                break
            text(source[at:lt + 1])
            at = lt + 1
            continue
        text(source[at:lt])
        at, slash, name, attrs = found
        if slash:
            k = opened.last(name)
            if k and not (name in INLINE and opened.blocks and opened.blocks[-1] > k):
                close(k)
            continue
        if name == "br":
            text(" ")
            continue
        if name in VOID:
            breaks += name == "hr"
            continue
        if name in RAW:
            end = _RAW_END[name](source, at)
            at = end.end() if end else len(source)
            continue
        if name == "svg":
            at = at if attrs.endswith("/") else marks.svg_end(at)
            continue
        if name in NOISE_TAGS:
            at = marks.closed(name, at) or marks.block(at)
            continue
        enders = CLOSES.get(name, set()) | ({"p"} if name in ENDS_P else set())
        if enders:
            k = max(map(opened.last, enders))
            if k and (not opened.scopes or opened.scopes[-1] <= k):
                close(k)
        tokens = _TOKENS(" ".join(a or b or c for a, b, c in _ATTR(attrs)).lower()) if "=" in attrs else []
        if name in INLINE and not tokens:
            links += name == "a"
            opened.push(name, stack[-1][1])
            continue
        links += name == "a"
        parent = stack[-1][1]
        if name not in INLINE:
            breaks += 1
        node = len(page.tag)
        for column, value in ((page.tag, TAG_ID.get(name, len(TAGS))), (page.parent, parent), (page.depth, page.depth[parent] + 1),
                              (page.last, node), (page.chars, 0), (page.link, 0), (page.punct, 0),
                              (page.good, sum(t in GOOD_TOKENS for t in tokens) + (name in GOOD_TAGS)),
                              (page.bad, sum(t in BAD_TOKENS for t in tokens) + (name in BAD_TAGS)),
                              (page.gold, ("data-main" in attrs) - ("data-noise" in attrs))):
            column.append(value)
        opened.push(name, node)
    close(0)
    page.last[0] = len(page.tag) - 1
    return page


class Nodes:
    """The nodes of many pages as arrays (one page after the other)."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.tag) for p in pages], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.page = np.repeat(np.arange(len(pages)), sizes)
        base = self.first[self.page]
        join = lambda name: np.concatenate([np.zeros(0, np.int64), *(np.array(getattr(p, name), np.int64) for p in pages)])
        for name in ("tag", "depth", "chars", "link", "punct", "good", "bad", "gold"):
            setattr(self, name, join(name))
        self.root = join("parent") < 0
        self.parent = np.where(self.root, np.arange(len(base)), join("parent") + base)
        self.last = join("last") + base
        by_depth = np.argsort(self.depth, kind="stable")
        self.levels = np.split(by_depth, np.cumsum(np.bincount(self.depth))[:-1])[1:] if len(base) else []

    def subtree(self, own: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(own)]
        return total[self.last + 1] - total[np.arange(len(own))]

    def above(self, own: np.ndarray) -> np.ndarray:
        """Sum over the proper ancestors."""
        out = np.zeros(len(own), own.dtype)
        for level in self.levels:
            up = self.parent[level]
            out[level] = out[up] + own[up]
        return out

    def features(self) -> np.ndarray:
        n, here = len(self.tag), np.arange(len(self.tag))
        chars, links, tags = (self.subtree(x) for x in (self.chars, self.link, np.ones(n, np.int64)))
        whole = chars[self.first[self.page]]
        before = np.r_[0, np.cumsum(self.chars)][here] - np.r_[0, np.cumsum(self.chars)][self.first[self.page]]
        # order by parent keeps document order among siblings
        order = np.argsort(self.parent, kind="stable")
        up = self.parent[order]
        starts = np.nonzero(np.r_[True, up[1:] != up[:-1]])[0] if n else np.zeros(0, np.int64)
        runs = np.diff(np.r_[starts, n])
        index, many, mates = np.empty(n), np.empty(n), np.empty(n)
        index[order] = np.arange(n) - np.repeat(starts, runs)
        many[order] = np.repeat(runs, runs)
        mates[order] = np.repeat(np.add.reduceat(chars[order], starts), runs) if n else 0
        log = lambda x: np.log1p(x.astype(np.float64))
        is_tag = lambda *names: np.isin(self.tag, [TAG_ID[x] for x in names])
        paragraphs, items = self.subtree(is_tag("p").astype(np.int64)), self.subtree(is_tag("li").astype(np.int64))
        return np.stack([
            is_tag("p", "pre", "blockquote"), is_tag("h1", "h2", "h3", "h4", "h5", "h6"), is_tag("ul", "ol", "li"),
            is_tag("div", "section"), is_tag("article", "main"), is_tag("nav", "footer", "header", "aside", "form"),
            is_tag("html", "body", "head") | self.root, np.where(self.root, -1, self.tag[self.parent]),
            self.good, self.bad, self.above(self.good), self.above(self.bad),
            self.depth, log(chars), log(self.chars), log(tags), chars / tags, links / (chars + 1),
            self.subtree(self.punct) / (chars + 1), index, many, index / many, chars / (mates + 1), chars / (whole + 1), before / (whole + 1),
            log(paragraphs), log(items), log(paragraphs[self.parent]), (links / (chars + 1))[self.parent],
        ], axis=1).astype(np.float64)

    def stripped(self) -> Nodes:
        """The same pages without telling tags and tokens."""
        other = object.__new__(Nodes)
        other.__dict__.update(self.__dict__)
        telling = np.isin(self.tag, [TAG_ID[t] for t in ("article", "main", "nav", "footer", "header", "aside", "section", "form")])
        other.tag = np.where(telling, TAG_ID["div"], self.tag)
        other.good, other.bad = np.zeros_like(self.good), np.zeros_like(self.bad)
        return other

    def labels(self) -> np.ndarray:
        """1 main text, 0 not, -1 unknown, as far as the markup tells."""
        in_gold, noise = self.above(np.maximum(self.gold, 0)) + np.maximum(self.gold, 0), self.above(np.maximum(-self.gold, 0)) + np.maximum(-self.gold, 0)
        told = np.zeros(len(self.first), bool)
        np.logical_or.at(told, self.page, self.gold != 0)
        article = np.isin(self.tag, [TAG_ID["article"], TAG_ID["main"]]).astype(np.int64)
        inside, bad = self.above(article) + article, self.above(self.bad) + self.bad
        holds = self.subtree(article) > article
        weak = np.where(bad > 0, 0, np.where((inside > 0) & ~holds, 1, np.where(holds, 0, -1)))
        return np.where(told[self.page], ((in_gold > 0) & (noise == 0)).astype(int), weak)


@dataclass
class Trees:
    """Boosted regression trees of one depth on the logistic loss.

    ``split`` and ``cut`` hold feature and threshold of the inner nodes of each tree in heap
    order, ``leaf`` the values of its leaves.
    """

    base: float
    split: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for split, cut, leaf in zip(self.split, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, split[node]] > cut[node])
            z += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-z))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Second-order boosting with histogram splits."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    inner, width = (1 << depth) - 1, bins
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    z, out = np.full(len(y), base), ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p) + 1e-9
        node, split, cut = np.zeros(len(y), np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            gain = np.full(many, 1e-6)
            for f in range(x.shape[1]):
                slot = (node - first) * width + code[:, f]
                gs, hs = (np.bincount(slot, v, many * width).reshape(many, width) for v in (g, h))
                gl, hl = np.cumsum(gs, axis=1), np.cumsum(hs, axis=1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                won = gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)
                won[:, len(edges[f]):] = 0
                best = won.argmax(axis=1)
                better = won[np.arange(many), best] > gain
                gain[better] = won[np.arange(many), best][better]
                split[first:first + many][better] = f
                cut[first:first + many][better] = edges[f][best[better]] if len(edges[f]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(x)), split[node]] > cut[node])
        leaf = rate * np.bincount(node - inner, g, inner + 1) / (np.bincount(node - inner, h, inner + 1) + ridge)
        z += leaf[node - inner]
        for x_, y_ in zip(out, (split, cut, leaf), strict=True):
            x_.append(y_)
    return Trees(base, *(np.array(v) for v in out))


ABOVE, MAIN, NOISE = range(3)


def decode(p: Page, probability: np.ndarray) -> list[int]:
    """The most probable labelling of a page's tree without contradictions."""
    n = len(p.tag)
    main = np.log(np.clip(probability, 1e-6, 1 - 1e-6))
    other = np.log(np.clip(1 - probability, 1e-6, 1 - 1e-6))
    # nodes weigh by the text that their label decides
    weight = 1 + np.log1p(np.array(p.chars))
    up = np.stack([other * weight, main * weight, other * weight], axis=1).tolist()
    for i in range(n - 1, 0, -1):
        a, m, x = up[i]
        parent = up[p.parent[i]]
        parent[ABOVE] += max(a, m, x)
        parent[MAIN] += max(m, x)
        parent[NOISE] += x
    state = [ABOVE] * n
    state[0] = max((ABOVE, MAIN, NOISE), key=up[0].__getitem__)
    for i in range(1, n):
        above = state[p.parent[i]]
        state[i] = NOISE if above == NOISE else max((MAIN, NOISE) if above == MAIN else (ABOVE, MAIN, NOISE), key=up[i].__getitem__)
    return state


def blocks(p: Page, state: list[int]) -> str:
    out: list[str] = []
    now, piece = None, []
    for node, mark, text in p.pieces:
        if state[node] != MAIN:
            continue
        if mark != now and piece:
            out.append(" ".join("".join(piece).split()))
            piece = []
        now = mark
        piece.append(text)
    out.append(" ".join("".join(piece).split()))
    return "\n\n".join(x for x in out if x)


def extract(sources: list[str | None], trees: Trees) -> list[str]:
    pages = [parse(s or "") for s in sources]
    nodes = Nodes(pages)
    p = trees.probability(nodes.features())
    ends = np.r_[nodes.first, len(p)].tolist()
    return [blocks(page, decode(page, p[a:b])) for page, a, b in zip(pages, ends[:-1], ends[1:], strict=True)]


def template_pages(count: int = TEMPLATES, seed: int = 7) -> list[str]:
    """Made-up pages that mark their main text and their noise."""
    rnd, out = random.Random(seed), []
    word = lambda: "".join(rnd.choice("aeioubcdfglmnprstv") for _ in range(rnd.randint(2, 9)))
    line = lambda lo, hi: " ".join(word() for _ in range(rnd.randint(lo, hi)))
    prose = lambda: "".join(f"<p>{line(1, 70)}, {line(1, 30)}.</p>" for _ in range(rnd.randint(1, 14)))
    noise = {
        "menu": lambda: "<ul>" + "".join(f'<li><a href="/">{line(1, 3)}</a></li>' for _ in range(rnd.randint(2, 9))) + "</ul>",
        "sidebar": lambda: f"<h3>{line(1, 3)}</h3>" + "".join(f'<p><a href="/">{line(2, 8)}</a></p>' for _ in range(rnd.randint(1, 6))),
        "notice": lambda: f"<p>{line(4, 25)}.</p><button>{word()}</button>",
        "ad": lambda: line(3, 20) + ".",
        "comments": lambda: "".join(f'<div class="comment"><p>{line(3, 40)}.</p></div>' for _ in range(rnd.randint(1, 5))),
        "form": lambda: f"<form><label>{word()}</label><input><button>{word()}</button></form>",
        "footer": lambda: f"&copy; {line(2, 12)}.",
        "header": lambda: f'<a href="/">{line(1, 4)}</a>'}
    tag = {"menu": "nav", "sidebar": "aside", "footer": "footer", "header": "header"}
    for _ in range(count):
        plain = rnd.random() < 0.4  # no telling markup at all

        def part(kind: str, plain: bool = plain) -> str:
            name = "div" if plain or kind not in tag else tag[kind]
            mark = "" if plain or rnd.random() < 0.3 and kind in tag else f' class="{kind}"'
            return f"<{name}{mark} data-noise>{noise[kind]()}</{name}>"

        name = "div" if plain else rnd.choice(["article", "main", "div"])
        mark = ' class="content"' if name == "div" and not plain else ""
        inner = prose() + (part(rnd.choice(["ad", "sidebar"])) + prose() if rnd.random() < 0.3 else "")
        body = f"<{name}{mark} data-main><h1>{line(2, 8)}</h1>{inner}{part('comments') if rnd.random() < 0.3 else ''}</{name}>"
        first = [part(k) for k in ("header", "menu", "notice", "ad") if rnd.random() < 0.6]
        last = [part(k) for k in ("sidebar", "comments", "form", "footer") if rnd.random() < 0.6]
        out.append(f"<html><body>{''.join(first)}{body}{''.join(last)}</body></html>")
    return out


def _training_rows(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    nodes = Nodes(pages)
    y = nodes.labels()
    x = np.concatenate([nodes.features()[y >= 0], nodes.stripped().features()[y >= 0]])
    return x, np.r_[y[y >= 0], y[y >= 0]]


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_nodes: int = SAMPLE_NODES) -> Trees:
    prepare(pages.sparkSession)
    turn = F.xxhash64("page_id", "url")
    last = pages.select(turn.alias("turn")).orderBy("turn").limit(sample_pages).agg(F.max("turn")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _training_rows([parse(h or "") for h in b.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(y, pa.int32())], names=["x", "y"])

    x, y = _training_rows([parse(s) for s in template_pages()])
    if last is not None:
        chosen = pages.where(turn <= last).select("html", turn.alias("turn")).dropDuplicates(["turn"]).select("html")
        nodes = chosen.mapInArrow(run, "x array<double>, y int")
        got = nodes.select("x", "y").orderBy(F.xxhash64("x"), "y").limit(sample_nodes).collect()  # bounded sample
        if got:
            x, y = np.concatenate([x, np.array([r["x"] for r in got])]), np.r_[y, [r["y"] for r in got]]
    return boost(x, y.astype(float))


def main_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(train(rows, sample_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = extract(part.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    found = rows.mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
