"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is parsed to a tree of elements. What stands directly in an element, text and inline elements
between two blocks or double line breaks, is a text node of its own with the element as its parent, also
outside <body> and in a page without tags; an element that holds one such run and nothing else is a text
node itself. Inline elements are part of their text node and
never decided apart. Each node has features: the text in its subtree and its density (text per tag, share of text in links, sentences), its depth and place among siblings, their
number and likeness, its tag, and whether words of its class, id and role stand for content or for
something else. Gradient-boosted trees give three probabilities: all of its text is main text
(content), none is (other), or some is (mixed).

Decoding chooses a state for every node at once: below `other` all is other; below `mixed` and
`content` anything but mixed below content is open. A text node is content or other, never mixed. The best sum of log probabilities over the whole tree
is found from the leaves upwards, so an ancestor and a descendant never contradict each other.

Training pages are made from real ones. Pages whose main text is marked by an <article> or <main>
element give the truth; each of a bounded sample is written anew several times, with the
semantic tags turned into plain ones with usual class names, and with menus, sidebars, notices,
adverts, forms and reader comments filled with text of other pages, so that the trees learn
structure and not one template.

Text: character references are decoded, white space inside a block becomes one space, blocks follow in
page order with one space between. Scripts, styles and the like have no text. Cases: null or empty
html, or a page without main text: empty text. A page without block elements is main text as a
whole. Unclosed and stray tags are mended as browsers do in
the common cases. If no page has marked main text, the trees fall back on the class names alone.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = 60  # sampled pages
COPIES = 6  # how often each is written anew
PAGE_BYTES = 30_000  # size of sampled pages at most

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript head title svg iframe object select textarea "
                   "button option canvas audio video datalist annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "q s samp small span strike strong sub sup time tt u var wbr math semantics mi mn mo "
                   "ms mtext mrow msup msub msubsup mmultiscripts mfrac msqrt mroot munder mover "
                   "munderover mstyle mpadded mphantom menclose mtable mtr mtd".split())
APART = frozenset(("mtr", "mtd"))  # inline, with white space around
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
                     "table ul x-main x-other".split())
HELPERS = ("x-main", "x-other")  # of training pages
SIBLINGS = {"li": ("ul", "ol", "menu"), "td": ("tr", "table"), "th": ("tr", "table"),
            "tr": ("table",), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}
GROUPS = ("p", "li", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form",
          "h1", "h2", "table", "ul", "blockquote", "body", "a", "#text")
# Usual words of class, id and role attributes.
CONTENT_WORDS = ("article", "content", "main", "post", "entry", "story", "body", "text", "blog",
                 "page", "hentry", "prose", "news")
OTHER_WORDS = ("nav", "menu", "header", "head", "footer", "foot", "side", "sidebar", "aside", "ad", "ads",
               "advert", "advertisement", "banner", "promo", "sponsor", "sponsored", "cookie",
               "notice", "consent", "popup", "modal", "alert", "comment", "comments", "reply", "replies",
               "respond", "discussion", "disqus", "form", "login", "search", "subscribe",
               "newsletter", "signup", "share", "social", "related", "recommended", "widget",
               "breadcrumb", "breadcrumbs", "pagination", "pager", "copyright", "legal", "tags",
               "toolbar", "skip", "masthead", "topbar", "rail", "outbrain", "gdpr", "navigation",
               "contentinfo", "complementary", "dialog", "feedback", "review", "reviews", "links")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


# --- the tree -------------------------------------------------------------------------------


class Node:
    __slots__ = ("tag", "words", "parent", "children", "marked", "text")

    def __init__(self, tag, words=(), parent=None):
        self.tag, self.words, self.parent = tag, words, parent
        self.children: list = []  # nodes and texts in order
        self.marked = None
        self.text = tag == "#text"


class Tree(HTMLParser):
    """Builds the tree of one page. The open elements are a stack, with the places of each tag in it, so
    that closing an element looks at no ancestor that stays open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.path, self.places = [self.root], {}

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p", stop=("table", "td", "th", "button"))
        elif tag in SIBLINGS:
            self._close(tag, stop=SIBLINGS[tag])
        if tag in ("td", "th"):
            self._close("td" if tag == "th" else "th", stop=SIBLINGS[tag])
        if tag in ("dt", "dd"):
            self._close("dd" if tag == "dt" else "dt", stop=("dl",))
        words = tuple(
            w.lower() for k, v in attrs if k in ("class", "id", "role", "itemprop") and v
            for w in TOKEN.findall(v)
        )
        node = Node(tag, words, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.path))
            self.path.append(node)
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close(tag, stop=())

    def handle_data(self, data):
        self.at.children.append(data)

    def _close(self, tag, stop):
        """Closes the last open element of the tag, unless one of `stop` was opened since."""
        places = self.places.get(tag)
        if not places or any(self.places.get(s) and self.places[s][-1] > places[-1] for s in stop):
            return
        at = places[-1]
        while len(self.path) > at:
            self.places[self.path.pop().tag].pop()
        self.at = self.path[-1]


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return boxed(tree.root)


def boxed(root: Node) -> Node:
    """Puts each run of text and inline elements into a text node. Only white space stays outside, and
    what is all of an element makes that element a text node."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node) and c.tag not in SILENT)
    blocks = set()  # elements that are blocks or hold one
    for node in reversed(order):
        if node.tag not in INLINE and (node.tag not in VOID or node.tag == "hr") or id(node) in blocks:
            blocks.add(id(node))
            if node.parent is not None:
                blocks.add(id(node.parent))
    for node in order:
        if id(node) not in blocks and node is not root:
            continue
        out, run, breaks = [], [], 0

        def close():
            if any(_has_text(c) for c in run):
                box = Node("#text", (), node)
                box.children = list(run)
                out.append(box)
            else:
                out.extend(run)
            run.clear()

        for c in node.children:
            if isinstance(c, Node) and id(c) in blocks:
                close()
                out.append(c)
                breaks = 0
                continue
            if isinstance(c, Node) and c.tag == "br":
                breaks += 1
            elif _has_text(c):
                if breaks > 1:
                    close()
                breaks = 0
            run.append(c)
        close()
        node.children = out
        if node.tag not in HELPERS:
            _joined(node)
    return root


def _joined(node: Node) -> None:
    """Makes an element with one text node and nothing else a text node."""
    inner = [c for c in node.children if isinstance(c, Node)]
    if len(inner) == 1 and inner[0].tag == "#text" and node.parent is not None:
        at = node.children.index(inner[0])
        node.children[at : at + 1] = inner[0].children
        node.text = True
        node.marked = inner[0].marked if node.marked is None else node.marked


def _pieces(items: list):
    """(text, whether in a link) of what is in a text node, with None where a word ends."""
    todo = [(c, False) for c in reversed(items)]
    while todo:
        item, linked = todo.pop()
        if isinstance(item, str):
            yield item, linked
        elif item.tag in SILENT:
            continue
        elif item.tag not in INLINE:
            yield None, linked
        else:
            if item.tag in APART:
                yield None, linked
            todo.extend((c, linked or item.tag == "a") for c in reversed(item.children))


def _has_text(item) -> bool:
    return any(t is not None and not t.isspace() and t for t, _ in _pieces([item]))


def _around(items: list) -> tuple:
    """Class words of the outermost inline elements that hold all of a text node."""
    words = ()
    for _ in range(4):
        full = [c for c in items if _has_text(c)]
        if len(full) != 1 or isinstance(full[0], str):
            break
        words += tuple(full[0].words)
        items = full[0].children
    return words


def nodes_of(root: Node) -> list[Node]:
    """Blocks and text nodes in page order, parents first; silent ones and what is in them are left out."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        if not node.text:
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node)
                        and c.tag not in SILENT and (c.tag == "#text" or c.tag not in VOID or c.tag == "hr"))
    return out


# --- features ----------------------------------------------------------------------------------

N_FEATURES = 20 + len(GROUPS)


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """(features, parents) of the nodes of one page; parent of the root: -1."""
    place = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    parent = np.array([place[id(x.parent)] if x.parent is not None else -1 for x in nodes])
    names = [tuple(x.words) for x in nodes]
    own = np.zeros((n, 5))  # characters, words, sentence ends, characters in links, tags
    for i, x in enumerate(nodes):
        own[i, 4] = 1
        if x.text:
            pieces = list(_pieces(x.children))
            words = "".join(" " if t is None else t for t, _ in pieces).split()
            own[i] = (sum(map(len, words)), len(words), sum(w[-1] in ".!?;,:" for w in words),
                      sum(len("".join(t.split())) for t, linked in pieces if linked and t), 1)
            names[i] += _around(x.children)
    in_link = np.zeros(n, bool)
    depth = np.zeros(n)
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or nodes[i].tag == "a"
        depth[i] = depth[parent[i]] + 1
    own[in_link, 3] = own[in_link, 0]
    total = own.copy()
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    x = np.zeros((n, N_FEATURES))
    whole = max(total[0, 0], 1)
    before, count = np.zeros(n), 0.0
    for i in range(n):
        before[i] = count
        count += own[i, 0]
    good = np.array([sum(w in CONTENT_WORDS for w in y) for y in names], float)
    bad = np.array([sum(w in OTHER_WORDS for w in y) for y in names], float)
    up_good, up_bad = good.copy(), bad.copy()
    for i in range(1, n):
        up_good[i] += up_good[parent[i]]
        up_bad[i] += up_bad[parent[i]]
    kids: dict[int, list[int]] = {}
    for i in range(1, n):
        kids.setdefault(int(parent[i]), []).append(i)
    for siblings in kids.values():
        tags = [nodes[i].tag for i in siblings]
        times = Counter(tags)
        longest = max(total[i, 0] for i in siblings)
        for k, i in enumerate(siblings):
            x[i, 0:4] = k, len(siblings), times[tags[k]], total[i, 0] / max(longest, 1)
    chars, words, stops, linked, tags = total.T
    x[:, 4] = np.log1p(chars)
    x[:, 5] = chars / np.maximum(tags, 1)
    x[:, 6] = linked / np.maximum(chars, 1)
    x[:, 7] = stops / np.maximum(words, 1)
    x[:, 8] = chars / whole
    x[:, 9] = before / whole
    x[:, 10] = depth
    x[:, 11] = np.log1p(own[:, 0])
    x[:, 12] = tags
    x[:, 13:17] = np.stack([good, bad, up_good, up_bad], axis=1)
    x[:, 17] = words
    x[1:, 18] = x[parent[1:], 6]
    x[1:, 19] = x[parent[1:], 8]
    for i, y in enumerate(nodes):
        for tag in (y.tag, y.parent.tag) if y.tag == "#text" else (y.tag,):
            if tag in GROUPS:
                x[i, 20 + GROUPS.index(tag)] = 1
    return x, parent


# --- boosted trees --------------------------------------------------------------------------------


class Boosted:
    """Gradient-boosted regression trees for three classes, over bins of each feature."""

    def __init__(self, rounds=40, depth=4, rate=0.2, bins=32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[tuple] = []  # per tree: (feature, cut, value) arrays of a full binary tree

    def fit(self, x: np.ndarray, y: np.ndarray):
        self.prior = np.log((np.bincount(y, minlength=3) + 1) / (len(y) + 3))
        edges = [np.unique(np.quantile(c, np.arange(1, self.bins) / self.bins)) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        scores = np.tile(self.prior, (len(y), 1))
        hot = np.eye(3)[y]
        for _ in range(self.rounds):
            p = _softmax(scores)
            for k in range(3):
                tree = self._grow(binned, edges, hot[:, k] - p[:, k], p[:, k] * (1 - p[:, k]))
                self.trees.append(tree)
                scores[:, k] += _walk(tree, x, self.depth)
        return self

    def _grow(self, binned, edges, g, h):
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(size)
        node = np.zeros(len(g), np.int64)
        for at in range(size):
            rows = np.flatnonzero(node == at)
            if len(rows) == 0:
                continue
            value[at] = self.rate * g[rows].sum() / (h[rows].sum() + 1.0)
            if at >= size // 2:
                continue
            best, most = None, 1e-6
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
            for f, e in enumerate(edges):
                if len(e) == 0:
                    continue
                b = binned[rows, f]
                gs = np.cumsum(np.bincount(b, g[rows], len(e) + 1))
                hs = np.cumsum(np.bincount(b, h[rows], len(e) + 1))
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
                j = int(gain[:-1].argmax())
                if gain[j] > most:
                    best, most = (f, j), gain[j]
            if best:
                feature[at], cut[at] = best[0], edges[best[0]][best[1]]
                node[rows] = 2 * at + 1 + (binned[rows, best[0]] > best[1])
            else:
                node[rows] = 2 * at + 1
        for at in range(1, size):  # nodes no row came to take their parent's value
            if value[at] == 0:
                value[at] = value[(at - 1) // 2]
        return feature, cut, value

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        scores = np.tile(self.prior, (len(x), 1))
        for i, tree in enumerate(self.trees):
            scores[:, i % 3] += _walk(tree, x, self.depth)
        return np.log(np.maximum(_softmax(scores), 1e-6))


def _walk(tree, x, depth):
    feature, cut, value = tree
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for _ in range(depth):
        at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
    return value[at]


def _softmax(s):
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


# --- decoding ---------------------------------------------------------------------------------------

CONTENT, OTHER, MIXED = 0, 1, 2
NEVER = -1e9


def decode(log_p: np.ndarray, parent: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The best state of every element. weight: how much each element counts."""
    n = len(parent)
    best, up = (log_p * weight[:, None]).tolist(), parent.tolist()
    choice = [None] * n
    for i in range(n - 1, 0, -1):
        content, other, mixed = best[i]
        below_content = CONTENT if content >= other else OTHER
        below_mixed = MIXED if mixed > max(content, other) else below_content
        choice[i] = (below_content, OTHER, below_mixed)
        above = best[up[i]]
        for s in (CONTENT, OTHER, MIXED):
            above[s] += best[i][choice[i][s]]
    state = np.full(n, MIXED)
    for i in range(1, n):
        state[i] = choice[i][state[up[i]]]
    return state


def main_texts(pages: list[str | None], model: Boosted) -> list[str]:
    """The main text of each page; the trees run once for the elements of all."""
    trees = [nodes_of(parse(html or "")) for html in pages]
    made = [features(nodes) for nodes in trees]
    if not made:
        return []
    log_p = model.log_probabilities(np.concatenate([x for x, _ in made]))
    out, at = [], 0
    for nodes, (x, parent) in zip(trees, made):
        text = np.array([n.text for n in nodes])
        if all(n.tag in ("#root", "#text", "hr") for n in nodes):  # no blocks: nothing is around the text
            state = np.full(len(nodes), CONTENT)
        else:
            page = log_p[at : at + len(nodes)].copy()
            page[text, MIXED] = NEVER
            state = decode(page, parent, 1 + np.sqrt(x[:, 17]))
        out.append(text_where(nodes, state))
        at += len(nodes)
    return out


def text_where(nodes: list[Node], state) -> str:
    """Text of the text nodes in state CONTENT, in page order, in blocks."""
    kept = {id(n) for n, s in zip(nodes, state) if s == CONTENT}
    out, todo = [], [nodes[0]]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif isinstance(item, tuple):
            out.append(" ")
        elif item.tag in SILENT:
            continue
        elif item.text and id(item) not in kept:
            out.append(" ")
        else:
            if item.tag not in INLINE and item.tag != "#text" or item.tag in APART:
                out.append(" ")
                todo.append(())
            todo.extend(reversed(item.children))
    return " ".join("".join(out).split())


# --- training pages -----------------------------------------------------------------------------------


def labelled(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes and their truth from `marked` (True: main text) of the nearest marked ancestor."""
    nodes = nodes_of(root)
    place = {id(n): i for i, n in enumerate(nodes)}
    main, own = np.zeros(len(nodes), bool), np.zeros((len(nodes), 2))
    for i, x in enumerate(nodes):
        above = main[place[id(x.parent)]] if x.parent is not None else False
        main[i] = above if x.marked is None else x.marked
        own[i, 0 if main[i] else 1] = x.text
    for i in range(len(nodes) - 1, 0, -1):
        own[place[id(nodes[i].parent)]] += own[i]
    label = np.where(own[:, 1] == 0, np.where(own[:, 0] > 0, CONTENT, np.where(main, CONTENT, OTHER)),
                     np.where(own[:, 0] == 0, OTHER, MIXED))
    return nodes, label


def rewritten(blocks: list[str], other: list[list[str]], rng: random.Random) -> str:
    """A page around the blocks of a main text; data-main tells the truth. `other`: texts."""
    def words(n):
        text = " ".join(rng.choice(other)).split() or ["text"]
        at = rng.randrange(len(text))
        return escape(" ".join((text + text)[at : at + n]))

    def links(n):
        return "<ul>" + "".join(
            f'<li><a href="/{i}">{words(rng.randint(1, 3))}</a></li>' for i in range(n)) + "</ul>"

    def box(tag, names, inside):
        if rng.random() < 0.5 and tag != "div":
            attr = f' class="{rng.choice(names)}"' if rng.random() < 0.5 else ""
            return f"<{tag}{attr}>{inside}</{tag}>"
        kind = rng.choice(("class", "class", "id"))
        return f'<div {kind}="{rng.choice(names)}">{inside}</div>'

    def paragraphs(n, low, high):
        return "".join(f"<p>{words(rng.randint(low, high))}</p>" for _ in range(n))

    def comments():
        one = "".join(box("div", ("comment", "comment-body", "reply", "review"),
                          f"<b>{words(2)}</b>" + paragraphs(rng.randint(1, 2), 4, 60))
                      for _ in range(rng.randint(1, 5)))
        return box("section", ("comments", "comment-list", "discussion", "responses replies"),
                   rng.choice(("", f"<h2>{words(2)}</h2>")) + one)

    def notice():
        return box("div", ("cookie-notice", "cookie-banner", "notice", "gdpr-consent", "alert", "popup"),
                   rng.choice((paragraphs(1, 5, 40), words(rng.randint(5, 30)))))

    def advert():
        return box(rng.choice(("div", "aside")), ("ad", "ads", "advert", "sponsored", "promo banner"),
                   rng.choice((paragraphs(1, 4, 30), words(rng.randint(3, 25)),
                               words(rng.randint(3, 25)) + paragraphs(1, 4, 30))))

    def loose():
        return "<hr>" + rng.choice((f"&copy; {words(rng.randint(2, 8))}", words(rng.randint(1, 6)),
                                    f"<a href='/'>{words(2)}</a> | <a href='/x'>{words(1)}</a>"))

    def form():
        return f"<form>{words(3)}<input><button>{words(1)}</button>{paragraphs(rng.randint(0, 1), 3, 20)}</form>"

    def sidebar():
        return box("aside", ("sidebar", "side", "related", "widget", "rail"),
                   f"<h3>{words(2)}</h3>" + rng.choice((links(rng.randint(2, 8)), paragraphs(2, 5, 40))))

    def menu():
        return box("nav", ("nav", "menu", "navigation", "breadcrumbs"), links(rng.randint(2, 9)))

    def header():
        return box("header", ("header", "masthead", "top header"), f"<a href='/'>{words(2)}</a>"
                   + rng.choice(("", menu(), f"<p>{words(8)}</p>", f"<h2>{words(4)}</h2>")))

    def footer():
        return box("footer", ("footer", "site-footer", "copyright"),
                   rng.choice((f"&copy; {words(8)}", paragraphs(1, 3, 30), links(4) + words(6))))

    rich = rng.choice((0, 0, 0.03, 0.15))  # share of words that begin an inline element

    def marked_up(text):
        if rng.random() < (0.04 if len(text.split()) > 4 else 0.25) * (rich > 0):
            return f'<a href="/{rng.randint(1, 99)}">{escape(text)}</a>'
        words_of, made, at = text.split(), [], 0
        while at < len(words_of):
            n = 1
            if rng.random() < rich:
                n = rng.randint(1, 6)
                tag = rng.choice(("a", "a", "a", "em", "strong", "code", "span", "b", "i", "sup", "cite"))
                attr = f' href="/{n}"' if tag == "a" else ""
                made.append(f"<{tag}{attr}>{escape(' '.join(words_of[at : at + n]))}</{tag}>")
            else:
                made.append(escape(words_of[at]))
            at += n
        return " ".join(made)

    def cells(text):
        few = re.findall(r"(?:\S+\s*){1,4}", text)
        rows = [few[i : i + 3] for i in range(0, len(few), 3)]
        return "<table>" + "".join("<tr>" + "".join(
            f"<{'th' if not i and rng.random() < 0.5 else 'td'}>{marked_up(c)}" for c in r) + "</tr>"
            for i, r in enumerate(rows)) + "</table>"

    extras = (menu, header, advert, notice, form, sidebar)
    if len(blocks) > 1 and rng.random() < 0.25:  # without its title
        blocks = blocks[1:]
    inner = []
    head = [f"<h1>{escape(blocks[0])}</h1>"] if rng.random() < 0.8 else [f"<p>{escape(blocks[0])}</p>"]
    style = rng.random()
    bare = rng.random() < 0.25  # text directly in its container, or in no container at all
    mostly = rng.choice((0.4, 1.0))
    if bare and rng.random() < 0.4:
        head = [escape(blocks[0]) + rng.choice(("<br>", "<br><br>"))]
    for b in blocks[1:]:
        if bare and rng.random() < mostly:
            inner.append(marked_up(b) + rng.choice(("<br>", "<br>", "<br><br>", "<hr>")))
            if rng.random() < 0.2:
                inner.append("<x-other>" + rng.choice((advert, notice))() + "</x-other>")
        elif style < 0.15:
            inner.append(f"<p><b>{marked_up(b)}<br>")
        elif rng.random() < 0.1:
            inner.append(f"<h2>{escape(' '.join(b.split()[:5]))}</h2><p>{marked_up(b)}</p>")
        elif rng.random() < 0.1:
            inner.append("<ul>" + "".join(f"<li>{marked_up(x)}</li>" for x in re.findall(r"(?:\S+\s*){1,9}", b)) + "</ul>")
        elif rng.random() < 0.1:
            inner.append(f"<blockquote>{marked_up(b)}</blockquote>")
        elif rng.random() < 0.06:
            inner.append(cells(b))
        elif rng.random() < 0.06:
            inner.append(rng.choice((f"<pre>{marked_up(b)}</pre>", f"<pre><code>{escape(b)}</code></pre>",
                                     f"<figure><img><figcaption>{marked_up(' '.join(b.split()[:12]))}</figcaption></figure><p>{marked_up(b)}</p>",
                                     f"<dl><dt>{words(2)}</dt><dd>{marked_up(b)}</dd></dl>")))
        elif style > 0.9:
            inner.append(f"<div>{marked_up(b)}</div>")
        else:
            inner.append(f"<p>{marked_up(b)}</p>")
        if rng.random() < 0.08:
            inner.append("<x-other>" + rng.choice((advert, form, notice, sidebar))() + "</x-other>")
    inside = "".join(head + inner)
    names = ("content", "post", "entry-content", "article-body", "story", "main-content", "post body",
             "text", "blog-post", "page-content")
    tag = rng.choice(("article", "main", "div", "div", "section"))
    attr = f' class="{rng.choice(names)}"' if tag == "div" and rng.random() < 0.85 or rng.random() < 0.4 else ""
    if rng.random() < 0.2:
        inside += "<x-other>" + comments() + "</x-other>"
    core = f"<{tag}{attr}><x-main>{inside}</x-main></{tag}>"
    if bare and rng.random() < 0.4:
        core = f"<x-main>{inside}</x-main>"
    before = "".join(f() for f in rng.sample(extras, rng.randint(0, 4)))
    after = "".join(f() for f in rng.sample((*extras, comments, footer, loose), rng.randint(0, 4)))
    if rng.random() < 0.3:
        core = f'<div class="{rng.choice(("wrapper", "container", "page", "layout"))}">{core}{rng.choice((sidebar, advert, comments))()}</div>'
    foot = footer() if rng.random() < 0.7 else ""
    if bare and rng.random() < 0.2:
        before = after = foot = ""
    if bare and rng.random() < 0.35:  # text behind the end of the page
        return f"<html><body>{before}{after}{foot}</body></html>{core}"
    return f"<html><body>{before}{core}{after}{foot}</body></html>"


def with_truth(html: str) -> tuple[list[Node], np.ndarray]:
    """The tree of a rewritten page: the two helper elements become marks of what is around them."""
    root = parse(html)
    todo = [root]
    while todo:
        node = todo.pop()
        out, items = [], [(c, None) for c in reversed(node.children)]
        while items:
            c, mark = items.pop()
            if isinstance(c, Node) and c.tag in HELPERS:
                items.extend((k, c.tag == "x-main") for k in reversed(c.children))
                continue
            if isinstance(c, Node):
                c.parent = node
                c.marked = mark if c.marked is None else c.marked
                if not c.text:
                    todo.append(c)
            out.append(c)
        node.children = out
        _joined(node)
    return labelled(root)


def marked_blocks(html: str) -> tuple[list[str], list[str]]:
    """(text nodes of the marked main text, others) of a page with <article> or <main>."""
    main, other, inside = [], [], set()
    for node in nodes_of(parse(html)):
        if node.tag in ("article", "main") or id(node.parent) in inside:
            inside.add(id(node))
        if node.text:
            text = "".join(" " if t is None else t for t, _ in _pieces(node.children))
            (main if id(node) in inside else other).append(" ".join(text.split()))
    return main, other


def fit(pages: list[str], copies: int = COPIES, seed: int = 4) -> Boosted:
    rng = random.Random(seed)
    mains, others = [], []
    for html in pages:
        main, other = marked_blocks(html)
        if main:
            mains.append(main)
            others.append(other + main)
    mains = mains or [["Title", "Some words of a main text.", "More of it, and an end."]]
    others = others or [["Some other words", "here and there"]]
    xs, ys = [], []
    for blocks in mains:
        for _ in range(copies if len(mains) > 20 else copies * 20):
            nodes, label = with_truth(rewritten(blocks, others, rng))
            xs.append(features(nodes)[0])
            ys.append(label)
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys))


# --- Spark --------------------------------------------------------------------------------------------


def train(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = PAGES) -> Boosted:
    """A model from the pages with marked main text with the smallest hash of their key."""
    few = pages.where(
        (F.octet_length(html) <= PAGE_BYTES) & F.lower(F.col(html)).rlike("<(article|main)[ >]")
    ).orderBy(F.xxhash64(F.col(key).cast("string")), F.xxhash64(html)).select(html).limit(sample)
    return fit([r[0] for r in few.collect()])


def extract(pages: DataFrame, model: Boosted, html: str = "html", keep: list[str] | None = None,
            text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows (their columns `keep`) with the main text and its length in code points."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    schema = pages.select(*keep, F.lit("").alias(text), F.lit(0).cast("long").alias(n_chars)).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = main_texts(part.column(part.num_columns - 1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep),
                     pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names,
                )

    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(run, schema)
