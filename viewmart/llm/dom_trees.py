"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every element of a page but inline ones is a node with features: its tag, tokens of its class, id and role and
those of its ancestors, depth, text, link and punctuation density of its subtree, and how it compares
with its siblings. Boosted trees give the log odds that a node holds main text. Decoding is
hierarchical: over the whole tree, the most likely set of kept nodes is found in which a node is kept only under a kept
parent, so an article inside a dropped sidebar, or a kept footer with dropped lines, cannot come out of
single guesses. The text of kept nodes is joined block by block.

The trees are trained here, on a sample of at most ``TRAINING_PAGES`` pages of ``TRAINING_LENGTH`` characters at most,
which are read in tasks. Pages carry no labels: those with one article or
main element label themselves, and the blocks of each are also taken apart by their semantic elements (article
against nav, aside, footer, form and the like) and set again into several layouts with other elements
and other names, whose parts are known. The sample is the only part that does not grow with the table; all pages are extracted whole,
where they lie, by trees of a fixed size.

Defined results: null html is the empty page, with empty text; broken markup is read as browsers would
read it in the main (unknown end tags ignored, open elements closed by their parent, a tag without end is text), in
time linear in its length however many tags lack an end and however deep elements nest; repeated rows and equal ids are
extracted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmart.llm.common import materialised

#: Pages of the training sample at most, characters of each at most, and layouts that each is set into.
TRAINING_PAGES, TRAINING_LENGTH, LAYOUTS = 200, 100_000, 4
TREES, DEPTH = 20, 5
#: Log odds that one node can have at most.
SURE = 6.0
#: Characters of pages looked at together.
TOGETHER = 2_000_000

# Elements of HTML by their role in parsing.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math title textarea select".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul".split()
)
#: An element that begins closes open ones of these tags up to the nearest of the second set.
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements that no end tag of an inner element reaches beyond.
SCOPES = frozenset("table td th html body article section nav aside header footer main form".split())

# Words in tags, classes, ids and roles, in groups that are one feature each.
GROUPS = {
    "content": "article body content entry main post story text",
    "menu": "breadcrumb menu nav navbar navigation pagination tabs toolbar",
    "head": "banner header masthead top topbar",
    "foot": "bottom copyright foot footer legal",
    "side": "aside rail related sidebar side widget recommended teaser",
    "advert": "ad ads advert advertisement adverts promo promoted sponsor sponsored",
    "notice": "alert consent cookie cookies gdpr modal notice notification overlay popup warning",
    "form": "button form input login newsletter search signup subscribe",
    "comment": "comment comments discussion disqus replies reply respond responses",
    "share": "follow like share sharing social tags meta",
}
GROUP_OF = {word: k for k, words in enumerate(GROUPS.values()) for word in words.split()}
TAGS = "article main section div p li ul nav aside header footer form h1 h2 h3 td table blockquote pre".split()
TAG_OF = {tag: k for k, tag in enumerate(TAGS)}

_NAME_ENDS = re.compile(r"[\s/>]")
_ATTRIBUTE_MARKS = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_POINTS = re.compile(r"[.,;:!?]")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    #: Groups of the node's own names, and of those above it.
    own: frozenset[int]
    above: frozenset[int]
    #: Text pieces directly in this node by their number in the page.
    pieces: list[int] = field(default_factory=list)
    end: int = 0  # number of the node after the subtree
    chars: int = 0
    link_chars: int = 0
    points: int = 0
    tags: int = 0


@dataclass
class Page:
    nodes: list[Node]
    #: Text blocks in order: node and text.
    blocks: list[tuple[int, str]]


def groups_of(tag: str, attributes: str) -> frozenset[int]:
    names = [] if tag in ("html", "body") else [tag]  # these hold everything
    if attributes:
        names += [a or b or c for _, a, b, c in _NAMES.findall(attributes)]
    return frozenset(GROUP_OF[w] for name in names for w in _WORDS.findall(name.lower()) if w in GROUP_OF)


_EMPTY: frozenset[int] = frozenset()


class Markup:
    """Tags, comments and declarations of an HTML text, found by one way forward.

    What a search ahead has found, or that it found nothing, is kept, so that a text full of ``<`` or quotes without an
    end is not searched again and again.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self._ahead: dict[str, int] = {}
        #: Places of quotes from which no tag ends.
        self._endless: set[int] = set()

    def _next(self, what: str, at: int) -> int:
        """Place of the next ``what`` (text, or a pattern by its name) from ``at``; the length if there is none."""
        known = self._ahead.get(what, -1)
        if known >= at:
            return known
        if what == "name end":
            found = _NAME_ENDS.search(self.source, at)
            place = found.start() if found else -1
        elif what == "mark":
            found = _ATTRIBUTE_MARKS.search(self.source, at)
            place = found.start() if found else -1
        else:
            place = self.source.find(what, at)
        self._ahead[what] = place = len(self.source) if place < 0 else place
        return place

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends attributes from ``at``, quoted ones left out; -1 if there is none."""
        source, walked = self.source, []
        mark = self._next("mark", at)
        while mark < len(source) and source[mark] != ">" and mark not in self._endless:
            walked.append(mark)
            closing = source.find(source[mark], mark + 1)
            if closing < 0:
                mark = len(source)
            else:
                found = _ATTRIBUTE_MARKS.search(source, closing + 1)
                mark = found.start() if found else len(source)
        if mark < len(source) and source[mark] == ">":
            return mark
        self._endless.update(walked)
        return -1

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it's an end tag, tag and attributes of the first markup from ``at``; no tag for
        comments and declarations."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            head = source[start + 1 : start + 4]
            if head == "!--":
                end = self._next("-->", start + 4)
                return start, min(end + 3, len(source)), False, "", ""
            if head[:1] in ("!", "?"):
                return start, min(self._next(">", start + 2) + 1, len(source)), False, "", ""
            ending = head[:1] == "/"
            name = start + 1 + ending
            if source[name : name + 1].isascii() and source[name : name + 1].isalpha():
                stop = self._next("name end", name)
                end = self._tag_end(stop) if stop < len(source) else -1
                if end >= 0:
                    return start, end + 1, ending, source[name:stop], source[stop:end]
            at = start + 1
        return None


_RULES = list(CLOSED_BY.items())
#: Of a tag: the rules that it plays a part in, and whether it is their border.
_ROLES = {
    tag: [(k, tag in border) for k, (_, (inner, border)) in enumerate(_RULES) if tag in inner or tag in border]
    for _, sets in _RULES
    for tag in sets[0] | sets[1]
}
_RULE_OF = {tag: k for k, (tag, _) in enumerate(_RULES)}


class OpenTags:
    """How many elements of a tag are open, in the innermost scope and altogether, and since the last border of each
    rule of ``CLOSED_BY``; told without a walk over the open elements."""

    def __init__(self) -> None:
        self.all: dict[str, int] = {}
        self.scopes: list[dict[str, int]] = [{}]
        self.since: list[list[int]] = [[0] for _ in _RULES]

    def opened(self, tag: str) -> None:
        self.all[tag] = self.all.get(tag, 0) + 1
        if tag in SCOPES:
            self.scopes.append({})
        else:
            self.scopes[-1][tag] = self.scopes[-1].get(tag, 0) + 1
        for k, border in _ROLES.get(tag, ()):
            if border:
                self.since[k].append(0)
            else:
                self.since[k][-1] += 1

    def closed(self, tag: str) -> None:
        self.all[tag] -= 1
        if tag in SCOPES:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        for k, border in _ROLES.get(tag, ()):
            if border:
                self.since[k].pop()
            else:
                self.since[k][-1] -= 1

    def ends(self, tag: str) -> bool:
        """True if an end tag has an element to close."""
        return (self.all if tag in SCOPES else self.scopes[-1]).get(tag, 0) > 0

    def gives_way(self, tag: str) -> frozenset[str]:
        """Tags of which an open element ends where ``tag`` begins; empty if none is open."""
        if tag in _RULE_OF:
            k = _RULE_OF[tag]
            return _RULES[k][1][0] if self.since[k][-1] else frozenset()
        return frozenset(["p"]) if tag in CLOSES_P and self.scopes[-1].get("p", 0) else frozenset()


def read_page(source: str) -> Page:
    """Nodes in the order of their beginnings, and text blocks, of an HTML text."""
    nodes = [Node("", -1, 0, _EMPTY, _EMPTY)]
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", 0)]  # open elements: tag, node that they are or lie in
    run: list[str] = []
    link_chars, links = 0, 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(run).split())
        run.clear()
        node = nodes[stack[-1][1]]
        if text:
            node.pieces.append(len(blocks))
            node.chars += len(text)
            node.link_chars += min(link_chars, len(text))
            node.points += len(_POINTS.findall(text))
            blocks.append((stack[-1][1], text))
        link_chars = 0

    def add(text: str) -> None:
        nonlocal link_chars
        if text:
            text = html.unescape(text) if "&" in text else text
            run.append(text)
            if links:
                link_chars += len(text.strip())

    def close(to: int) -> None:
        nonlocal links
        if any(tag not in INLINE for tag, _ in stack[to:]):
            flush()
        for tag, node in reversed(stack[to:]):
            opened.closed(tag)
            if tag == "a":
                links -= 1
            elif tag not in INLINE:
                nodes[node].end = len(nodes)
        del stack[to:]

    def close_nearest(tags: frozenset[str]) -> None:
        place = len(stack) - 1
        while stack[place][0] not in tags:
            place -= 1
        close(place)

    markup, opened = Markup(source), OpenTags()
    at, length = 0, len(source)
    while at < length:
        found = markup.after(at)
        if not found:
            add(source[at:])
            break
        start, end, ending, tag, attributes = found
        add(source[at:start])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            if opened.ends(tag):
                close_nearest(frozenset([tag]))
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                over = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = over.end() if over else length
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            if ended := opened.gives_way(tag):
                close_nearest(ended)
            # inline elements stay open in principle, but their node ends with the block
            while stack[-1][0] in INLINE:
                close(len(stack) - 1)
        node = stack[-1][1]
        nodes[node].tags += 1
        if tag in INLINE:
            if tag == "br":
                run.append(" ")
            elif tag not in VOID:
                links += tag == "a"
                stack.append((tag, node))
                opened.opened(tag)
            continue
        flush()
        if tag in VOID:
            continue
        above = nodes[node].above | nodes[node].own
        nodes.append(Node(tag, node, nodes[node].depth + 1, groups_of(tag, attributes), above))
        if not attributes.endswith("/"):
            stack.append((tag, len(nodes) - 1))
            opened.opened(tag)
        else:
            nodes[-1].end = len(nodes)
    flush()
    while len(stack) > 1:
        close(len(stack) - 1)
    nodes[0].end = len(nodes)
    return Page(nodes, blocks)


N_FEATURES = 14 + 2 * len(GROUPS)


def features(page: Page) -> np.ndarray:
    """One row per node of the page."""
    nodes = page.nodes
    n = len(nodes)
    chars, links, points, tags = (np.array([getattr(x, name) for x in nodes], float) for name in ("chars", "link_chars", "points", "tags"))
    own_chars = chars.copy()
    parent = np.array([x.parent for x in nodes])
    for i in range(n - 1, 0, -1):  # children come after their parent
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        points[p] += points[i]
        tags[p] += tags[i]
    siblings = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n)
    sibling_chars = np.bincount(parent[1:], chars[1:], minlength=n) if n > 1 else np.zeros(n)
    order = np.zeros(n)
    seen = np.zeros(n)
    for i in range(1, n):
        order[i] = seen[parent[i]]
        seen[parent[i]] += 1
    same: dict[tuple[int, str], int] = {}
    for x in nodes[1:]:
        same[x.parent, x.tag] = same.get((x.parent, x.tag), 0) + 1
    out = np.zeros((n, N_FEATURES))
    out[:, 0] = [TAG_OF.get(x.tag, len(TAGS)) for x in nodes]
    out[:, 1] = [x.depth for x in nodes]
    out[:, 2] = np.log1p(chars)
    out[:, 3] = np.log1p(own_chars)
    out[:, 4] = chars / (tags + 1)  # subtree density
    out[:, 5] = links / np.maximum(chars, 1)
    out[:, 6] = points / np.maximum(chars, 1)
    out[:, 7] = chars / max(chars[0], 1)
    around = np.maximum(parent, 0)
    out[:, 8] = siblings[around]
    out[:, 9] = order / np.maximum(siblings[around], 1)
    out[:, 10] = chars / np.maximum(sibling_chars[around], 1)
    out[:, 11] = [same.get((x.parent, x.tag), 1) for x in nodes] / np.maximum(siblings[around], 1)
    out[:, 12] = [x.end - i - 1 for i, x in enumerate(nodes)]
    out[:, 13] = chars[around] / max(chars[0], 1)
    for i, x in enumerate(nodes):
        for k in x.own:
            out[i, 14 + k] = 1
        for k in x.above:
            out[i, 14 + len(GROUPS) + k] = 1
    return out


def kept_nodes(page: Page, odds: np.ndarray) -> list[bool]:
    """The most likely kept nodes, each under a kept parent. ``odds``: log odds of keeping each node."""
    odds = np.clip(odds, -SURE, SURE).tolist()
    # gain of keeping a node against dropping its whole subtree
    gain = odds
    for i in range(len(page.nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[page.nodes[i].parent] += gain[i]
    kept = [False] * len(page.nodes)
    kept[0] = gain[0] > 0
    for i in range(1, len(page.nodes)):
        kept[i] = kept[page.nodes[i].parent] and gain[i] > 0
    return kept


def text_of(page: Page, kept: list[bool]) -> str:
    return "\n\n".join(text for node, text in page.blocks if kept[node])


# --- training pages ------------------------------------------------------------------------

#: Names for the parts of training layouts, as (tag, attributes).
MAIN = [
    ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="post-body"'), ("section", 'class="story-text"'),
    ("div", 'class="entry-content"'), ("article", 'class="post"'), ("div", 'class="article-body"'), ("div", ""), ("div", 'role="main"'),
]
OTHER = {
    "menu": [("nav", ""), ("div", 'class="menu"'), ("ul", 'class="navigation"'), ("div", 'role="navigation"'), ("nav", 'class="breadcrumb"')],
    "head": [("header", ""), ("div", 'class="site-header"'), ("div", 'id="masthead"'), ("div", 'role="banner"')],
    "foot": [("footer", ""), ("div", 'class="footer"'), ("div", 'id="site-footer"'), ("div", 'class="copyright"'), ("div", 'class="legal"')],
    "side": [("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="related"'), ("div", 'class="widget"'), ("aside", 'class="right-rail"')],
    "advert": [("div", 'class="ad"'), ("div", 'class="advert"'), ("div", 'id="sponsored"'), ("div", 'class="promo-box"'), ("section", 'class="ads"')],
    "notice": [("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'class="alert"'), ("div", 'class="popup"')],
    "form": [("form", ""), ("form", 'class="newsletter"'), ("div", 'class="subscribe"'), ("form", 'id="search"')],
    "comment": [("div", 'class="comments"'), ("section", 'id="comments"'), ("ol", 'class="comment-list"'), ("div", 'id="disqus_thread"')],
}


def layouts(blocks: list[str], seed: int, number: int) -> Iterator[tuple[str, str]]:
    """Pages made of a page's main blocks, each as (html, marker): the marker's element holds the main text."""
    rng = random.Random(seed)
    mark = "data-main"

    def piece(tag: str, attributes: str, inner: str) -> str:
        return f"<{tag} {attributes}>{inner}</{tag}>"

    def inline(text: str) -> str:
        """The text with some inline markup, in part left open."""
        words = html.escape(text).split(" ")
        for opening in ("<b>", "<em>", '<a href="/z">', "<br>"):
            if rng.random() < 0.2:
                at = rng.randrange(len(words))
                words[at] = opening + words[at]
                if rng.random() < 0.7 and opening != "<br>":
                    end = rng.randrange(at, min(len(words), at + 12))
                    words[end] += "</" + opening[1:].split(" ")[0].rstrip(">") + ">"
        return " ".join(words)

    def some(low: int, high: int) -> list[str]:
        return [html.escape(rng.choice(blocks)[: rng.choice([30, 80, 300, 1000])]) for _ in range(rng.randint(low, high))]

    def part(kind: str) -> str:
        tag, attributes = rng.choice(OTHER[kind])
        if kind == "menu":
            items = "".join(f'<li><a href="/x">{s[:12]}</a></li>' for s in some(3, 8))
            inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>"
        elif kind == "comment":
            inner = "".join(f'<div class="comment"><p>{s}</p></div>' for s in some(1, 6))
        elif kind == "form":
            inner = f"<p>{some(1, 1)[0][:60]}</p><label>{some(1, 1)[0][:20]}</label><input><button>Ok</button>"
        elif kind == "side":
            inner = "".join(f'<h3>{s[:30]}</h3><p><a href="/y">{s[:80]}</a></p>' for s in some(1, 4))
        elif rng.random() < 0.5:
            inner = some(1, 1)[0][:150]
        else:
            inner = "".join(f"<p>{s[:120]}</p>" for s in some(1, 3))
        return piece(tag, attributes, inner)

    for _ in range(number):
        head, *rest = blocks
        body = f"<h1>{html.escape(head)}</h1>" if rng.random() < 0.7 else f"<p>{html.escape(head)}</p>"
        inside = rng.random() < 0.3
        for k, block in enumerate(rest):
            tag = "p" if rng.random() < 0.9 else rng.choice(["h2", "blockquote", "div", "li"])
            body += piece(tag, "", inline(block))
            if inside and k == len(rest) // 2:
                body += part(rng.choice(["advert", "side", "notice", "form"]))
        tag, attributes = rng.choice(MAIN)
        middle = piece(tag, f'{attributes} {mark}="1"', body)
        before = [part(k) for k in ("head", "menu", "notice", "advert") if rng.random() < 0.6]
        after = [part(k) for k in ("side", "advert", "form", "comment", "foot") if rng.random() < 0.6]
        inner = "".join(before) + middle + "".join(after)
        if rng.random() < 0.5:
            inner = piece("div", rng.choice(['class="wrap"', 'id="page"', ""]), inner)
        yield f"<html><head><title>x</title></head><body>{inner}</body></html>", mark


def main_labels(page: Page, main: int) -> np.ndarray:
    """1 for nodes on the way to node ``main`` or in it, but for parts inside it that are no main text."""
    labels = np.zeros(len(page.nodes))
    labels[main : page.nodes[main].end] = 1
    other = {k for k, name in enumerate(GROUPS) if name != "content"}
    for i in range(main + 1, page.nodes[main].end):
        x = page.nodes[i]
        if x.own & other or not labels[x.parent]:
            labels[i] = 0
    at = main
    while at >= 0:
        labels[at] = 1
        at = page.nodes[at].parent
    return labels


def training_rows(source: str, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the nodes of a page that tells its main part, and of layouts made from it."""
    page = read_page(source)
    blocks = [
        text
        for node, text in page.blocks
        if not (page.nodes[node].own | page.nodes[node].above) - {GROUP_OF["content"]} and len(text) > 20
    ]
    if not blocks:
        return
    mains = [k for k, x in enumerate(page.nodes) if x.tag in ("article", "main")]
    if len(mains) == 1:  # the page tells its own main part
        yield features(page), main_labels(page, mains[0])
    for made, mark in layouts(blocks, seed, LAYOUTS):
        # the marker is found by its place, then the page is read without it
        before, _, after = made.partition(f' {mark}="1"')
        place = read_page(before + ">").nodes
        made_page = read_page(before + after)
        yield features(made_page), main_labels(made_page, len(place) - 1)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for seed, source in zip(batch["seed"].to_pylist(), batch["html"], strict=True):
            for rows, labels in training_rows(source.as_py(), seed):
                values = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), N_FEATURES)
                columns = [pa.array(labels), values.cast(pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "row"])


# --- the trees -----------------------------------------------------------------------------


@dataclass
class Trees:
    """Boosted trees as arrays: per tree, node k splits on feature[k] at threshold[k] (left: at most it)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    depth: int

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of rows."""
        total = np.zeros(len(rows))
        index = np.arange(len(rows))
        for t, weight in enumerate(self.weight):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                feature = self.feature[t][at]
                inner = feature >= 0
                go_left = rows[index, np.maximum(feature, 0)] <= self.threshold[t][at]
                at = np.where(inner, np.where(go_left, self.left[t][at], self.right[t][at]), at)
            total += weight * self.value[t][at]
        return 2 * total  # the loss is that of twice the margin


def fitted(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> Trees | None:
    """Trees trained on layouts of a sample of pages; None if there is nothing to learn from.

    Pages are read in tasks; only features of their nodes are written to the scratch folder.
    """
    # the different pages of the least hashes
    hashed = pages.where(F.length("html") <= TRAINING_LENGTH).select("html", F.xxhash64("html").alias("order"))
    least = hashed.select("order").distinct().orderBy("order").limit(training_pages)
    places = {r.order: k for k, r in enumerate(least.collect())}  # numbers of the sample
    if not places:
        return None
    seeds = pages.sparkSession.createDataFrame(list(places.items()), "order bigint, seed int")
    sample = hashed.join(F.broadcast(seeds), "order").dropDuplicates(["order"]).select("seed", "html")
    rows = materialised(sample.mapInArrow(_train, "label double, row array<double>"), "dom-training")
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    # in one order, so that the trees come out the same each time
    data = rows.coalesce(1).sortWithinPartitions("row", "label").select("label", array_to_vector("row").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3, minInstancesPerNode=10).fit(data)
    return _as_arrays(model)


def _as_arrays(model) -> Trees:
    trees = []
    for tree in model._java_obj.trees():
        nodes: list[list[float]] = []

        def visit(node, nodes=nodes) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, node.prediction()])
            if node.subtreeDepth():
                split = node.split()
                nodes[at][:2] = [split.featureIndex(), split.threshold()]
                nodes[at][2] = visit(node.leftChild())
                nodes[at][3] = visit(node.rightChild())
            return at

        visit(tree.rootNode())
        trees.append(nodes)
    width = max(map(len, trees))
    filled = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (width - len(t)) for t in trees])
    return Trees(
        filled[:, :, 0].astype(int),
        filled[:, :, 1],
        filled[:, :, 2].astype(int),
        filled[:, :, 3].astype(int),
        filled[:, :, 4],
        np.array(model.treeWeights),
        DEPTH,
    )


TEXTS = "page_id {page}, url string, text string, n_chars bigint"


def extracted(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars. Without trees, all text outside raw elements."""
    schema = TEXTS.format(page=pages.schema["page_id"].dataType.simpleString())

    def texts(sources: list[str]) -> list[str]:
        read = [read_page(s) for s in sources]
        if trees is None:
            return [text_of(p, [True] * len(p.nodes)) for p in read]
        odds = trees.odds(np.concatenate([features(p) for p in read]))
        ends = np.cumsum([len(p.nodes) for p in read])
        return [text_of(p, kept_nodes(p, odds[end - len(p.nodes) : end])) for p, end in zip(read, ends)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            group, size = [], 0
            for source in batch["html"]:
                source = source.as_py() or ""
                group.append(source)
                size += len(source)
                if size > TOGETHER:
                    out += texts(group)
                    group, size = [], 0
            if group:
                out += texts(group)
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
