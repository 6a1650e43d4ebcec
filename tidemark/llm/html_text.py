"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. Elements whose kind is never article text (scripts, menus,
footers, forms and the like, and elements of such a ``role``) go first. Every remaining node gets
a density, its characters per tag adjusted by the share of link characters and link tags, and the
sum of its children's densities. The node with the largest sum is the best; the smallest density
on the way from the body to it is the threshold. Every node that reaches the threshold adds the
subtree with the largest sum below it, so that an article in several sections is found whole; an
element without elements must be as dense as the best.
What stands between such subtrees, their headings and paragraphs right beside them belong to it.

Names only weigh: a class or id that tells of boilerplate lowers the density of all below it (an
id that ends in another word hardly, as titles lend theirs to anchors; one on a heading not at all), and
an ``article`` or ``main`` has its sum raised. A name on an element that holds all ``main``, ``h1``
and outer ``article`` elements speaks of the layout and does not count. An ``article`` within an
``article`` is a reader's comment. Within the chosen subtrees a lowered part stays if it is still
as dense as ``SLACK`` of the threshold. In a page without sections, what precedes the ``h1`` and
misses the threshold is a notice.

Block elements and line breaks part text, inline elements do not. Character references are
decoded, runs of white space become one space. Null and empty pages, pages without text, and pages
whose ``article`` is there but empty give an empty text; an empty table gives no rows, repeated
rows are repeated, further columns are left out. Unclosed, misnested, very deep and very long
markup is read without recursion, and whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices

# Fixed values of HTML: elements without content, with raw content, and that part text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr img".split()
)
# Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre search section table ul".split()
)
ENDS_OWN = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
# Elements that are never part of an article.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select input textarea iframe object embed svg canvas dialog menu"
    " title xmp noembed noframes search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of class and id names that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion promoted banner"
    " sidebar sidebars sidenav nav navbar navigation navi menu menus breadcrumb breadcrumbs footer masthead topbar toolbar"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall"
    " comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations teaser"
    " widget widgets pagination pager skip hidden".split()
)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[\s_-]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = HEADINGS | frozenset("p blockquote pre ul ol dl figure table".split())
CONTENT = ("article", "main")
# Densities below a class or id that names boilerplate; below an id that only begins like one, often a heading's anchor.
LOWERED, ANCHOR = 0.1, 0.8
# What the sum of an ``article`` or ``main`` counts for.
RAISED = 4.0
# A lowered part of the article stays from this share of the threshold on.
SLACK = 0.4


class Node:
    __slots__ = ("tag", "parent", "children", "role", "weight", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", role: bool = False, weight: float = 1.0):
        self.tag, self.parent, self.children, self.role, self.weight = tag, parent, [], role, weight
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def within(self, tags: tuple[str, ...]) -> "Node | None":
        """The nearest of this node and its ancestors with one of ``tags``."""
        node = self
        while node is not None and node.tag not in tags:
            node = node.parent
        return node


def told(tag: str, attributes: str) -> tuple[bool, float]:
    """Whether attributes give an element a role outside the article, and what its names weigh."""
    outside, weight = False, 1.0
    if not attributes or tag in ("html", "body"):
        return outside, weight
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, text = name.lower(), html.unescape("".join(values)).lower()
        if name == "hidden" or name == "role" and text.strip() in ROLES:
            outside = tag not in CONTENT
        elif name == "class" or name == "id" and tag not in HEADINGS:
            for label in text.split():
                words = _WORDS.split(label)
                if words[0] not in ("with", "has", "no") and (MARKS.intersection(words) or label in ("header", "site-header", "page-header")):
                    weight = min(weight, ANCHOR if name == "id" and words[-1] not in MARKS else LOWERED)
    return outside, weight


def parsed(page: str) -> Node:
    """The page's elements and texts; texts are strings among the children."""
    root = Node("html", None)
    stack, opened = [root], Counter()
    at, end = 0, len(page)

    def close(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    while at < end:
        cut = page.find("<", at)
        if cut < 0:
            stack[-1].children.append(html.unescape(page[at:]))
            break
        found = _TAG.match(page, cut)
        if not found:  # a plain less-than sign, or a tag cut off by the end of the page
            stack[-1].children.append(html.unescape(page[at:cut + 1]))
            at = cut + 1
            continue
        if cut > at:
            stack[-1].children.append(html.unescape(page[at:cut]))
        at = found.end()
        closing, opening, attributes = found.group(1), found.group(2), found.group(3)
        if closing:
            tag = closing.lower()
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
        elif opening:
            tag = opening.lower()
            ends, borders = ({"p"}, {"td", "th", "table", "button"}) if tag in ENDS_P else ENDS_OWN.get(tag, (set(), set()))
            if any(opened[t] for t in ends):
                close(_outermost(stack, ends, borders))
            node = Node(tag, stack[-1], *told(tag, attributes))
            stack[-1].children.append(node)
            if tag in RAW:
                stop = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                node.children.append(page[at:stop.start() if stop else end])
                at = stop.end() if stop else end
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append(node)
                opened[tag] += 1
    return root


def _outermost(stack: list[Node], tags: set[str], borders: set[str]) -> int:
    """Depth of the outermost open element of ``tags`` within the next border."""
    result = len(stack)
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in borders:
            break
        if stack[depth].tag in tags:
            result = depth
    return result


def ordered(root: Node) -> list[Node]:
    """All elements, parents before children, in page order."""
    result, todo = [], [root]
    while todo:
        node = todo.pop()
        result.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return result


def pruned(root: Node) -> None:
    """Removes elements of a kind or role that is never article text; an article's own header stays."""
    gone = {
        id(n) for n in ordered(root)
        if n.parent is not None and (n.tag in DROPPED or n.role or n.tag == "header" and n.within(CONTENT) is None)
    }
    for parent in {id(n.parent): n.parent for n in ordered(root) if id(n) in gone}.values():
        parent.children = [c for c in parent.children if id(c) not in gone]


def inherited(nodes: list[Node]) -> None:
    """Hands weights down; names on what holds every landmark of the page do not count."""
    inside: dict[int, bool] = {}
    held: Counter = Counter()
    landmarks = 0
    for node in nodes:
        above = node.parent is not None and inside[id(node.parent)]
        inside[id(node)] = above or node.tag == "article"
        if node.tag == "article" and above:
            node.weight = min(node.weight, LOWERED)
        if node.tag in ("main", "h1") and not above or node.tag == "article" and not above and node.weight == 1.0:
            landmarks += 1
            held[id(node)] += 1
    for node in reversed(nodes):
        if node.parent is not None:
            held[id(node.parent)] += held[id(node)]
    for node in nodes:
        own = 1.0 if landmarks and held[id(node)] == landmarks else node.weight
        node.weight = min(own, node.parent.weight) if node.parent is not None else own


def measured(root: Node) -> list[Node]:
    """Counts characters and tags, and those of links, below every node."""
    nodes = ordered(root)
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    return nodes


def weighed(nodes: list[Node], link_share: float) -> None:
    """Composite density of every node, and the sum of its children's."""
    for node in nodes:
        chars, tags = node.chars, node.tags or 1
        if not chars:
            node.density = 0.0
            continue
        plain = (chars - node.link_chars) or 1
        base = math.log(math.log(chars / plain * node.link_chars + link_share * chars + math.e))
        ratio = math.log(max(chars / (node.link_chars or 1) * tags / (node.link_tags or 1), 1.0))
        node.density = node.weight * chars / tags * (ratio / base if base > 1e-9 else 1.0)
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node)) * (RAISED if node.tag in CONTENT else 1.0)


def value(node: Node) -> float:
    """What nodes are chosen by: the sum, and below all sums a leaf's own density."""
    return node.total or node.density * 1e-6


def best_below(nodes: list[Node]) -> dict[int, Node]:
    """By a node's identity, the node with the largest sum at or below it; the first of equals."""
    best: dict[int, Node] = {}
    for node in reversed(nodes):
        found = node
        for child in node.children:
            if isinstance(child, Node) and value(best[id(child)]) > value(found):
                found = best[id(child)]
        best[id(node)] = found
    return best


def chosen(root: Node, link_share: float) -> tuple[list, float]:
    """What makes up the article, in page order, and the threshold."""
    nodes = measured(root)
    inherited(nodes)
    weighed(nodes, link_share)
    body = next((n for n in nodes if n.tag == "body"), root)
    if not body.chars:
        return [root], 0.0
    articles = [n for n in nodes if n.tag in CONTENT and n.weight == 1.0]
    if articles and not any(n.chars for n in articles):
        return [], 0.0
    below = best_below(nodes)
    best = below[id(body)]
    # Names weigh against the best subtree only: if that is lowered itself, nothing gains by it.
    seen = {id(n): n.density * min(1.0, best.weight / n.weight) for n in nodes}
    threshold, sparse, node = best.density, best.chars, best
    while node is not None and node is not body.parent:
        threshold, sparse, node = min(threshold, seen[id(node)]), min(sparse, node.chars / (node.tags or 1)), node.parent
    kept = {id(best)}
    todo = [c for c in body.children if isinstance(c, Node)]
    while todo:
        node = todo.pop()
        # With few characters the logarithm's base nears 1 and lifts any density, so the plain one counts too.
        dense = node.chars / (node.tags or 1) >= SLACK * sparse
        if dense and node.tag not in INLINE and seen[id(node)] >= (threshold if node.total else max(threshold, best.density)):
            kept.add(id(below[id(node)]))
        todo += [c for c in node.children if isinstance(c, Node)]
    return whole(root, body, kept, threshold), threshold


def whole(root: Node, body: Node, kept: set[int], threshold: float) -> list:
    """The children, of the node that holds all of ``kept``, that span them and what belongs to them."""
    holds: Counter = Counter()
    nodes = ordered(root)
    for node in reversed(nodes):
        holds[id(node)] += id(node) in kept
        if node.parent is not None:
            holds[id(node.parent)] += holds[id(node)]
    around = root
    while id(around) not in kept:
        inner = next((c for c in around.children if isinstance(c, Node) and holds[id(c)] == holds[id(root)]), None)
        if inner is None:
            break
        around = inner
    if id(around) in kept:
        if around in (body, root):
            start = next((i for i, c in enumerate(around.children) if isinstance(c, Node) and c.tag == "h1"), 0)
            return [c for i, c in enumerate(around.children) if i >= start or not isinstance(c, str) and c.density >= threshold]
        if around.parent is None:
            return [around]
        inner, around = around, around.parent
        first = last = next(i for i, c in enumerate(around.children) if c is inner)
    else:
        spots = [i for i, c in enumerate(around.children) if isinstance(c, Node) and holds[id(c)]]
        first, last = spots[0], spots[-1]
    at = first - 1
    while at >= 0 and _prose(around.children[at]):
        if isinstance(around.children[at], Node) and around.children[at].tag in HEADINGS:
            first = at
        at -= 1
    while around not in (body, root) and last + 1 < len(around.children) and _prose(around.children[last + 1]):
        last += 1
    return around.children[first:last + 1]


def _prose(child) -> bool:
    return not child.strip() if isinstance(child, str) else child.tag in PROSE


def text_of(nodes: list, threshold: float = 0.0) -> str:
    """Text of the subtrees without lowered parts that miss the threshold: white space to one space, blocks parted by one space."""
    out: list[str] = []
    usual = max((n.weight for n in nodes if isinstance(n, Node)), default=1.0)
    todo: list = [(n, usual) for n in reversed(nodes)]
    while todo:
        item, above = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if item.weight < above and item.density < SLACK * threshold:
            continue
        parts = item.tag not in INLINE
        if parts:
            todo.append((" ", above))
        todo += [(c, item.weight) for c in reversed(item.children)]
        if parts:
            out.append(" ")
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parsed(page)
    every = measured(root)[0]
    share = every.link_chars / (every.chars or 1)
    pruned(root)
    return text_of(*chosen(root, share))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars per page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    texts = rows.mapInArrow(_extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
