"""Main text of web pages by a tree-structured graphical model.

Every DOM node is frame (what holds the parts of a page), main content, or other (menus,
adverts, footers and the like). Potentials between parent and child and evidence at each
node are learned from labelled pages; sum-product messages passed upward and downward
over the tree give each node's exact marginals. Text of nodes that are more likely
content than not is kept.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.slices import by_slices

#: About so many pages are learned from, those with the smallest hashes.
SAMPLE_PAGES = 4000

# The elements of HTML that have no end tag, hold raw text, or show none.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Elements whose start ends an open element of the given kinds, up to a boundary.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split()
)
#: Elements and words in class, id or role by which a page itself tells what is content and what is not.
CONTENT_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset(
    "nav header footer aside form menu dialog button select fieldset script style title noscript template iframe svg "
    "textarea head object".split()
)
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar "
    "navigation menu menus breadcrumb breadcrumbs header footer masthead comment comments reply replies disqus respond "
    "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login share sharing "
    "social related recommended recommendations widget toolbar pagination pager copyright form search complementary "
    "contentinfo banner dialog".split()
)
CONTENT_WORDS = frozenset("article articlebody content main maincontent entry post story text body".split())

TAG = regex.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = regex.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = regex.compile(r"[a-z]+")
FRAME, CONTENT, OTHER = STATES = range(3)
#: Pseudo-counts, per thousand labelled nodes, for what the labelled pages may not show.
PRIOR = 30.0
#: Tags that content and other parts of a page may hold alike.
COMMON_TAGS = "p li ul ol h div section table tr td dl dt dd figure figcaption span img".split()


class Node:
    __slots__ = ("tag", "other", "content", "parent", "chars", "linked")

    def __init__(self, tag: str, named: tuple[bool, bool], parent: int):
        self.tag, self.parent = tag, parent
        self.other, self.content = named
        self.chars = self.linked = 0


@functools.lru_cache(maxsize=10_000)
def named_by(attributes: str) -> tuple[bool, bool]:
    """Whether class, id or role have words for other parts, and for content."""
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role", "itemprop"):
            found.update(WORD.findall(unescape("".join(values)).lower()))
    return not found.isdisjoint(OTHER_WORDS), not found.isdisjoint(CONTENT_WORDS)


@functools.cache
def raw_end(name: str):
    return regex.compile(rf"</{name}[\s/>]", regex.IGNORECASE)


def parse(html: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """The nodes, parents before children, and the page in order: (node, text), or (node, None) for a block edge.

    Unclosed and stray tags are taken as browsers take them, in essence; a tag or comment
    cut off by the page's end is nothing.
    """
    nodes = [Node("#root", (False, False), -1)]
    flow: list[tuple[int, str | None]] = []
    stack = [0]
    places: dict[str, list[int]] = {}  # of each tag that is open, where on the stack

    def open_node(number: int) -> None:
        places.setdefault(nodes[number].tag, []).append(len(stack))
        stack.append(number)

    def close_to(place: int) -> None:
        for node in reversed(stack[place:]):
            places[nodes[node].tag].pop()
            if nodes[node].tag not in INLINE:
                flow.append((nodes[node].parent, None))
        del stack[place:]

    def innermost(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close_kind(kinds, boundary) -> None:
        place = innermost(kinds)
        if place > innermost(boundary):
            close_to(place)

    def text(start: int, end: int) -> None:
        if end > start:
            flow.append((stack[-1], unescape(html[start:end])))

    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            text(at, size)
            break
        follows = html[mark + 1 : mark + 2]
        if follows in ("!", "?"):
            text(at, mark)
            stop = "-->" if html.startswith("<!--", mark) else ">"
            end = html.find(stop, mark + 2)
            at = size if end < 0 else end + len(stop)
            continue
        if not (follows.isascii() and follows.isalpha() or follows == "/"):
            text(at, mark + 1)
            at = mark + 1
            continue
        text(at, mark)
        tag = TAG.match(html, mark)
        if not tag:
            end = html.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if closing:
            if places.get(name):
                close_to(places[name][-1])
            continue
        if name in ENDS_P:
            close_kind({"p"}, {"table", "td", "th", "button", "object"})
        if name in CLOSES:
            close_kind(*CLOSES[name])
        number = len(nodes)
        nodes.append(Node(name, named_by(attributes) if attributes else (False, False), stack[-1]))
        if name == "br":
            flow.append((stack[-1], " "))
        elif name not in INLINE:
            flow.append((number, None))
        closed = attributes.rstrip().endswith("/")
        if name in RAW and not (closed and name == "svg"):
            end = raw_end(name).search(html, at)
            open_node(number)
            if end is None:
                at = size
            else:
                at = end.start()
        elif name not in VOID and not closed:
            open_node(number)
    for node, piece in flow:
        if piece is not None and not piece.isspace():
            nodes[node].chars += len(piece)
    for node in reversed(nodes[1:]):
        parent = nodes[node.parent]
        linked = node.chars if node.tag == "a" else node.linked
        parent.chars += node.chars
        parent.linked += linked
    return nodes, flow


def kind(tag: str) -> str:
    return tag if regex.fullmatch("h[1-6]", tag) is None else "h"


def evidence(node: Node) -> tuple[str, ...]:
    """The categorical features of a node; an inline one has only those of its names."""
    found = []
    if node.tag not in INLINE:
        share = int(node.linked / node.chars * 4) if node.chars else 0
        size = int(math.log2(node.chars + 1)) // 2
        found += ["tag:" + kind(node.tag), f"links:{min(share, 3)}:{min(size, 5)}"]
    if node.other:
        found.append("word:other")
    elif node.content:
        found.append("word:content")
    return tuple(found)


def link(node: Node) -> str:
    return "inline" if node.tag in INLINE else "block"


def labels(nodes: list[Node]) -> list[int] | None:
    """What a page that marks its article says of each node; None for a page that marks none.

    Content lies under an article or main element, other under what is named so.
    """
    if not any(node.tag in CONTENT_TAGS for node in nodes):
        return None
    found = [FRAME] * len(nodes)
    for at, node in enumerate(nodes[1:], 1):
        if found[node.parent] == OTHER or node.tag in OTHER_TAGS or node.other:
            found[at] = OTHER
        elif found[node.parent] == CONTENT or node.tag in CONTENT_TAGS:
            found[at] = CONTENT
    return found


def observed(pages: Iterable[str | None]) -> Counter:
    """Counts that labelled pages give: (link, parent's label, label) and (feature, label, -1)."""
    counts: Counter = Counter()
    for html in pages:
        nodes, _ = parse(html or "")
        known = labels(nodes)
        for at, node in enumerate(nodes[1:] if known else (), 1):
            counts[link(node), known[node.parent], known[at]] += 1
            for feature in evidence(node):
                counts[feature, known[at], -1] += 1
    return counts


class Model:
    """Potentials: of a child given its parent's state, and of each feature given a state."""

    def __init__(self, counts: dict):
        total: Counter = Counter(counts)
        size = max(1.0, sum(n for key, n in counts.items() if key[2] >= 0) / 1000)
        for state in STATES:
            total["block", state, state] += PRIOR
            total["inline", state, state] += PRIOR * size
            for other in STATES:
                for kind_of_link in ("block", "inline"):
                    total[kind_of_link, state, other] += 0.1
        for change in ((FRAME, CONTENT), (FRAME, OTHER), (CONTENT, OTHER)):
            total["block", *change] += PRIOR * size / 4
        for tag in (*OTHER_TAGS, *COMMON_TAGS):
            total["tag:" + tag, OTHER, -1] += PRIOR * size
        for tag in (*CONTENT_TAGS, *COMMON_TAGS, "blockquote", "pre"):
            total["tag:" + tag, CONTENT, -1] += PRIOR * size
        total["tag:p", CONTENT, -1] += 4 * PRIOR * size
        for tag in ("html", "body", "div", "section", "table", "tr", "td"):
            total["tag:" + tag, FRAME, -1] += PRIOR * size
        total["word:other", OTHER, -1] += PRIOR * size
        total["word:content", CONTENT, -1] += PRIOR * size

        def share(row: list[float]) -> tuple[float, ...]:
            return tuple(value / sum(row) for value in row)

        self.pairs = {
            name: tuple(share([total[name, up, down] for down in STATES]) for up in STATES)
            for name in ("block", "inline")
        }
        nodes = [sum(n for key, n in total.items() if key[0] == "block" and key[2] == state) for state in STATES]
        nodes = [n + PRIOR * size * 40 for n in nodes]
        self.features = {
            feature: tuple((total[feature, state, -1] + 0.1) / nodes[state] for state in STATES)
            for feature in {key[0] for key in total if key[2] < 0}
        }
        # Sizes and link shares say little by themselves: a quarter of them is spread evenly.
        for feature in [f"links:{share}:{size}" for share in range(4) for size in range(6)]:
            seen = self.features.get(feature, (0.0, 0.0, 0.0))
            self.features[feature] = tuple(0.75 * value + 0.25 / 24 for value in seen)

    def potential(self, features: tuple[str, ...]) -> list[float]:
        found = [1.0, 1.0, 1.0]
        for feature in features:
            if (seen := self.features.get(feature)) is not None:
                found = [a * b for a, b in zip(found, seen)]
        return [value / max(found) for value in found]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of each node to be content; the root is frame.

        Upward, a node's belief is its evidence times its children's messages; downward,
        each node gets its parent's belief without its own message.
        """
        known: dict[tuple[str, ...], list[float]] = {}
        beliefs = []
        for node in nodes:
            features = evidence(node)
            if features not in known:
                known[features] = self.potential(features)
            beliefs.append(known[features])
        messages: list = [None] * len(nodes)
        for at in range(len(nodes) - 1, 0, -1):
            a, b, c = beliefs[at]
            (a0, b0, c0), (a1, b1, c1), (a2, b2, c2) = self.pairs[link(nodes[at])]
            x, y, z = a * a0 + b * b0 + c * c0, a * a1 + b * b1 + c * c1, a * a2 + b * b2 + c * c2
            messages[at] = (x, y, z)
            parent = nodes[at].parent
            a, b, c = beliefs[parent]
            a, b, c = a * x, b * y, c * z
            top = max(a, b, c)
            beliefs[parent] = (max(a / top, FLOOR), max(b / top, FLOOR), max(c / top, FLOOR))
        beliefs[0] = (1.0, 0.0, 0.0)
        content = [0.0] * len(nodes)
        for at in range(1, len(nodes)):
            parent = nodes[at].parent
            a, b, c = beliefs[parent]
            if parent:
                x, y, z = messages[at]
                a, b, c = a / x, b / y, c / z
            (a0, b0, c0), (a1, b1, c1), (a2, b2, c2) = self.pairs[link(nodes[at])]
            x, y, z = a * a0 + b * a1 + c * a2, a * b0 + b * b1 + c * b2, a * c0 + b * c1 + c * c2
            a, b, c = beliefs[at]
            a, b, c = a * x, b * y, c * z
            top = a + b + c
            beliefs[at] = (a / top, b / top, c / top)
            content[at] = b / top
        return content


#: Beliefs stay above it, so that a message can always be taken out of them again.
FLOOR = 1e-250


def main_text(html: str | None, model: Model) -> str:
    """The content blocks in page order, white space inside a block as one space, joined by two newlines."""
    nodes, flow = parse(html or "")
    content = model.marginals(nodes)
    blocks: list[list[str]] = [[]]
    for node, piece in flow:
        if piece is None:
            blocks.append([])
        elif content[node] >= 0.5 and nodes[node].tag not in RAW:
            blocks[-1].append(piece)
    texts = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(text for text in texts if text)


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Model:
    """Learn from about `sample_pages` pages, by hash of their id and html.

    Pages that mark their article label themselves; others teach nothing. Tasks count,
    and the driver gets one row per feature and label.
    """
    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{html}`").alias("html"))
    total = max(1, named.count())
    order = F.pmod(F.xxhash64("page_id", F.xxhash64("html")), F.lit(1 << 30))
    sample = named.where(order < int((1 << 30) * min(1.0, sample_pages / total))).select("html")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            counts += observed(batch["html"])
        yield pd.DataFrame([(*key, float(n)) for key, n in counts.items()], columns=["name", "one", "two", "n"])

    sums = sample.mapInPandas(count, "name string, one int, two int, n double").groupBy("name", "one", "two")
    return Model({tuple(row)[:3]: row["n"] for row in sums.agg(F.sum("n").alias("n")).collect()})


def extract(
    pages: DataFrame,
    model: Model | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    sample_pages: int = SAMPLE_PAGES,
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Without a model one is learned from the pages themselves. A null or empty html, or
    one without content, gives an empty text. Nothing of the content is cut off. Repeated
    rows, null ids and null urls are kept; other columns are not looked at.
    """
    model = model or fit(pages, page_id, html, sample_pages)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        yield from by_slices(batches, lambda htmls: [main_text(html, model) for html in htmls], pa.string())

    return pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), extracted(F.col(f"`{html}`")).alias("text")
    ).withColumn("n_chars", F.length("text").cast("bigint"))
