"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a binary variable (content or not). Unary potentials come from its tag, the words of its class, id and
role, the length of its text and of the part that stands directly in it, its link density, its share of the page's text, and its paragraphs and headings; pairwise potentials tie it to its parent, by the kind of child. Sum-product
messages pass upward and then downward, which gives each element's exact content marginal. Weights are fitted by
gradient ascent on the likelihood of labelled pages (:mod:`tidemark.llm.html_pages`), with the same messages. Text whose
element has a marginal of at least one half is kept.

Output text: character references decoded, white space runs inside a block one space, trimmed, blocks in page order
joined by one space. Defined results: null and empty html give empty text, broken markup is repaired the way
browsers do in the common cases (unclosed elements, stray end tags; elements nested deeper than ``DEPTH`` count as part of
the one at that depth), repeated rows and extra columns do no harm, an empty table gives no rows. A page without any markup
is one block of text. Script, style and similar raw content is never text; what ``noscript``, ``canvas`` and ``select`` hold are elements like others.
"""

from __future__ import annotations

import html as _html
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_OPENING = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[a-z]+")
# fixed values: element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title".split())
DEPTH = 512
INLINE = frozenset("math mi mn mo mrow mfrac msqrt msub msup mtext object svg a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
SECTION = frozenset("article aside body div fieldset figure footer form header html main nav section table tbody td tr th ul ol dl center details".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


class Node:
    __slots__ = ("attrs", "heads", "kids", "link", "own", "paragraphs", "parent", "size", "tag")

    def __init__(self, tag: str, parent: int, attrs: str):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.kids: list[int] = []
        self.size = self.link = self.own = self.paragraphs = self.heads = 0


def parse(source: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """(nodes in page order, (node, text or "\\n" block edge) in page order)."""
    nodes = [Node("html", -1, "")]
    flow: list[tuple[int, str]] = []
    stack = _Open(nodes)
    pos, end, raw = 0, len(source), ""
    last = source.rfind(">")  # no tag ends behind it: an unfinished one there is dropped, as browsers do
    while pos < end:
        if raw:
            m = re.compile(rf"</{raw}\s*>", re.I).search(source, pos)
            pos, raw = (m.end() if m else end), ""
            continue
        if pos > last:
            tail = source[pos:]
            cut = _OPENING.search(tail)
            tail = tail[: cut.start()] if cut else tail
            flow.append((stack.top, _html.unescape(tail)))
            break
        m = _TOKEN.search(source, pos)
        text = source[pos : m.start() if m else end]
        if text:
            flow.append((stack.top, _html.unescape(text) if "&" in text else text))
        if not m:
            break
        pos = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if stack.beyond.get(tag):
                stack.beyond[tag] -= 1
            elif stack.count.get(tag, 0) > (tag == "html"):
                while len(stack.ids) > 1:
                    top = stack.pop()
                    if nodes[top].tag not in INLINE:
                        flow.append((stack.top, "\n"))
                    if nodes[top].tag == tag:
                        break
            elif tag not in INLINE:
                flow.append((stack.top, "\n"))
            continue
        if tag in VOID:
            flow.append((stack.top, " " if tag in ("wbr", "img") else "\n"))
            continue
        if tag in RAW:
            if not m.group(3).rstrip().endswith("/"):
                raw = tag
            flow.append((stack.top, " "))
            continue
        if tag in ("html", "body") and stack.count.get(tag):
            nodes[0].attrs += " " + m.group(3)
            continue
        if tag in CLOSES_P:
            stack.close({"p"}, frozenset(("button", "td", "th", "table", "div", "article", "section")))
            if tag in HEADINGS and nodes[stack.top].tag in HEADINGS:
                stack.pop()
        elif tag in SAME:
            stack.close(SAME[tag], SCOPE[tag])
        if tag not in INLINE:
            flow.append((stack.top, "\n"))
        if len(stack.ids) < DEPTH:
            up = nodes[stack.top]
            up.kids.append(len(nodes))
            up.heads += tag in HEADINGS
            nodes.append(Node(tag, stack.top, m.group(3)))
            stack.push(len(nodes) - 1)
        else:
            stack.beyond[tag] = stack.beyond.get(tag, 0) + 1
    for at, text in flow:
        n = len(text) - text.count(" ") - text.count("\n")
        if n:
            nodes[at].size += n
            nodes[at].own += n
            if nodes[at].tag == "a":
                nodes[at].link += n
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[nodes[i].parent]
        p.paragraphs += nodes[i].own > 0 and nodes[i].tag in ("p", "div")
        p.size += nodes[i].size
        p.link += nodes[i].size if nodes[i].tag == "a" else nodes[i].link
    return nodes, flow


class _Open:
    """The open elements, innermost last, how many there are of each tag, and the tags opened beyond ``DEPTH``."""

    def __init__(self, nodes: list[Node]):
        self.beyond: dict[str, int] = {}
        self.nodes, self.ids, self.count, self.top = nodes, [0], {"html": 1}, 0

    def push(self, i: int) -> None:
        self.ids.append(i)
        tag = self.nodes[i].tag
        self.count[tag] = self.count.get(tag, 0) + 1
        self.top = i

    def pop(self) -> int:
        i = self.ids.pop()
        self.count[self.nodes[i].tag] -= 1
        self.top = self.ids[-1]
        return i

    def close(self, tags: set[str], barrier: frozenset[str] | set[str]) -> None:
        """Close the nearest open element of ``tags``, unless a ``barrier`` element is nearer."""
        if not any(self.count.get(t) for t in tags):
            return
        for k in range(len(self.ids) - 1, 0, -1):
            tag = self.nodes[self.ids[k]].tag
            if tag in tags:
                while len(self.ids) > k:
                    self.pop()
                return
            if tag in barrier:
                return


# ---- features -----------------------------------------------------------------------------------------------

#: words that class, id and role attributes commonly use, by the part of a page they name (our own choice)
GROUPS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toc pagination pager tabs skip toolbar",
    "head": "header masthead banner topbar hero logo branding head top",
    "foot": "footer foot bottom copyright colophon contentinfo legal imprint",
    "side": "sidebar side aside rail widget widgets complementary column secondary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner adsense dfp outbrain taboola affiliate",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup banner warning disclaimer paywall toast message",
    "remark": "comment comments commentlist reply replies respond discussion disqus reader readers feedback responses thread",
    "share": "share sharing social follow twitter facebook like print email rss",
    "more": "related recommended recommendations more popular trending latest teaser teasers readmore list links tags tag categories archive",
    "form": "form search login input register contact poll survey",
    "meta": "meta byline author date time published caption credit info",
    "main": "article content post entry main story body text maincontent articlebody postbody prose page hentry copy",
    "hide": "hidden hide invisible none sr offscreen",
}
WORD_GROUPS: dict[str, list[str]] = {}
for _g, _words in GROUPS.items():
    for _w in _words.split():
        WORD_GROUPS.setdefault(_w, []).append(_g)
TAGS = "html head body div section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption aside nav header footer form fieldset button label address details summary a b i em strong span small time cite code noscript canvas select option".split()
NAMES = ["bias", *[f"tag:{t}" for t in TAGS], "tag:other", "tag:other inline", *[f"name:{g}" for g in GROUPS], "unnamed", *[f"size:{k}" for k in range(7)], *[f"link:{k}" for k in range(4)], "long&unlinked", "mostly links", *[f"own:{k}" for k in range(5)], *[f"paragraphs:{k}" for k in range(4)], "headed", "bare root", "whole page", "most of page", "says it all", "plain article", "plain words"]
INDEX = {n: i for i, n in enumerate(NAMES)}
KINDS = 3  # inline, block and sectioning children
CACHED, CACHED_ATTRS = 20_000, 120  # entries of a partition's cache of features, longest attributes that it keeps


def _words(attrs: str) -> set[str]:
    out = set()
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            for w in _NAME.findall(value):
                out.update(WORD_GROUPS.get(w, ()))
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("hide")
    return out


def features(nodes: list[Node], cache: dict) -> list[tuple[int, ...]]:
    return [active(x, cache, nodes[0].size) for x in nodes]


def active(node: Node, cache: dict, total: int) -> tuple[int, ...]:
    """Indexes of the features that are 1 at a node; ``total``: how much text the page has."""
    size = 0 if node.size == 0 else min(6, 1 + int(np.log2(node.size + 1)) // 2)
    own = 0 if node.own == 0 else min(4, 1 + int(np.log2(node.own + 1)) // 3)
    share = node.link / node.size if node.size else 0.0
    link = 0 if share == 0 else 1 if share < 0.25 else 2 if share < 0.6 else 3
    part = 2 if node.size and node.size == total else 1 if node.size > 0.6 * total else 0
    key = (node.tag, node.attrs, size, link, own, min(3, node.paragraphs), node.heads > 0, part)
    got = cache.get(key)
    if got is None:
        groups = _words(node.attrs)
        got = (0, INDEX.get(f"tag:{node.tag}", INDEX["tag:other inline" if node.tag in INLINE else "tag:other"]), *(INDEX[f"name:{g}"] for g in sorted(groups)), *(() if groups else (INDEX["unnamed"],)), INDEX[f"size:{size}"], INDEX[f"link:{link}"],
               *((INDEX["long&unlinked"],) if size >= 4 and link == 0 else ()), *((INDEX["mostly links"],) if link == 3 and size else ()),
               INDEX[f"own:{own}"], INDEX[f"paragraphs:{key[5]}"], *((INDEX["headed"],) if node.heads else ()), *((INDEX["bare root"],) if node.parent < 0 and own else ()),
               *((INDEX[("", "most of page", "whole page")[part]],) if part and node.parent >= 0 else ()), *((INDEX["says it all"],) if part == 2 and own else ()),
               *((INDEX["plain words"],) if own >= 3 and link == 0 and not groups else ()), *((INDEX["plain article"],) if node.tag in ("article", "main") and groups <= {"main"} else ()))
        if len(node.attrs) <= CACHED_ATTRS and len(cache) < CACHED:
            cache[key] = got
    return got


def kind(tag: str) -> int:
    return 0 if tag in INLINE else 2 if tag in SECTION else 1


# ---- the tree model -----------------------------------------------------------------------------------------


class TreeModel:
    """Weights of the unary features (for label 1) and log potentials pair[kind, parent label, child label]."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair
        self._u = unary.tolist()
        self._p = np.exp(pair).tolist()
        self.cache: dict = {}

    def messages(self, nodes: list[Node], feats: list[tuple[int, ...]]):
        """Upward then downward sum-product: (marginals of label 1, inside values, messages to parents, outside values)."""
        n = len(nodes)
        w = self._u
        inside = [(1.0, 1.0)] * n
        up = [(1.0, 1.0)] * n
        prod: list = [None] * n
        for i in range(n - 1, -1, -1):
            z = sum([w[f] for f in feats[i]])
            one = math.exp(min(max(z, -40.0), 40.0))
            a, b = prod[i] or (1.0, 1.0)
            x0, x1 = a, one * b
            s = x0 + x1
            x0, x1 = x0 / s, x1 / s
            inside[i] = (x0, x1)
            if i:
                p = self._p[kind(nodes[i].tag)]
                m0, m1 = p[0][0] * x0 + p[0][1] * x1, p[1][0] * x0 + p[1][1] * x1
                s = m0 + m1
                up[i] = (m0 / s, m1 / s)
                q = nodes[i].parent
                c = prod[q]
                t0, t1 = (up[i][0], up[i][1]) if c is None else (c[0] * up[i][0], c[1] * up[i][1])
                s = t0 + t1
                prod[q] = (t0 / s, t1 / s) if s < 1e-100 else (t0, t1)
        belief = [(0.0, 0.0)] * n
        out = [(1.0, 1.0)] * n
        belief[0] = inside[0]
        for i in range(1, n):
            q = nodes[i].parent
            # parent's belief without this child's message
            e0, e1 = belief[q][0] / max(up[i][0], 1e-300), belief[q][1] / max(up[i][1], 1e-300)
            s = e0 + e1
            e0, e1 = e0 / s, e1 / s
            out[i] = (e0, e1)
            p = self._p[kind(nodes[i].tag)]
            d0, d1 = e0 * p[0][0] + e1 * p[1][0], e0 * p[0][1] + e1 * p[1][1]
            b0, b1 = inside[i][0] * d0, inside[i][1] * d1
            s = b0 + b1
            belief[i] = (b0 / s, b1 / s)
        return belief, inside, out

    def marginals(self, nodes: list[Node]) -> list[float]:
        return [b[1] for b in self.messages(nodes, features(nodes, self.cache))[0]]

    def text(self, source: str | None) -> str:
        if not source:
            return ""
        nodes, flow = parse(source)
        keep = [m >= 0.5 for m in self.marginals(nodes)]
        return " ".join("".join([t if keep[i] else " " for i, t in flow]).split())


def train(pages: list[tuple[str, callable]], rounds: int = 160, rate: float = 0.5, ridge: float = 0.01) -> TreeModel:
    """Maximum likelihood on labelled pages: gradient = observed minus expected feature counts, expectations by messages.

    A page is (html, label): label(node chain) tells whether an element is content.
    """
    data = []
    for source, label in pages:
        nodes, _ = parse(source)
        y = label(nodes)
        data.append((nodes, features(nodes, {}), y))
    unary, pair = np.zeros(len(NAMES)), np.zeros((KINDS, 2, 2))
    su, sp = np.full(len(NAMES), 1e-6), np.full((KINDS, 2, 2), 1e-6)
    total = sum(len(n) for n, _, _ in data)
    for _ in range(rounds):
        model = TreeModel(unary, pair)
        gu, gp = [0.0] * len(NAMES), [[0.0] * 4 for _ in range(KINDS)]
        for nodes, feats, y in data:
            belief, inside, out = model.messages(nodes, feats)
            for i, f in enumerate(feats):
                d = y[i] - belief[i][1]
                for j in f:
                    gu[j] += d
                if i:
                    k = kind(nodes[i].tag)
                    (o0, o1), (x0, x1), ((p00, p01), (p10, p11)) = out[i], inside[i], model._p[k]
                    e = (o0 * x0 * p00, o0 * x1 * p01, o1 * x0 * p10, o1 * x1 * p11)
                    s = sum(e)
                    g = gp[k]
                    for j in range(4):
                        g[j] -= e[j] / s
                    g[2 * y[nodes[i].parent] + y[i]] += 1
        gu = np.array(gu) / total - ridge * unary / 100
        gp = np.array(gp).reshape(KINDS, 2, 2) / total - ridge * pair / 100
        su, sp = su + gu**2, sp + gp**2
        unary, pair = unary + rate * gu / np.sqrt(su), pair + rate * gp / np.sqrt(sp)
    return TreeModel(unary, pair)


_MODEL: list[TreeModel] = []


def default_model() -> TreeModel:
    """Trained once a process from the labelled pages of this package."""
    if not _MODEL:
        from tidemark.llm.html_pages import labelled_pages

        _MODEL.append(train(labelled_pages()))
    return _MODEL[0]


def extract_pages(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = (model.unary, model.pair)

    def run(batches):
        import pyarrow as pa

        m = TreeModel(*weights)
        for batch in batches:
            texts = [m.text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
