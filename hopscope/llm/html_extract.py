"""Main text of web pages by tag-path ratios.

A page is cut into text blocks. Blocks inside elements that are never content
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments, by tag, role, class or id) are set aside. A class or id counts only for blocks, and
if it doesn't merely say what a layout has (``has-sidebar``) or qualify a part of
an article (``article-header``), and if the elements of that name hold less than
``MOST`` of the page's ratio-weighted text and of its articles' (``NEARLY_ALL``
for comments, adverts and the like). For the rest, text outside links and punctuation are summed for each root-to-leaf tag path; a
path's ratio is its mean text length times its mean punctuation count, each
with its spread over the path's blocks. The ratios are smoothed along the page
with a Gaussian, fused with the blocks' own paths, and blocks above a share of
the spread are content nodes. The content is the smallest element that holds
the content nodes' parents; article elements around them win, all those whose paths
pass, or a main element if it weighs most. Of its blocks, headings and paths that
pass are the text, in page order: a path (a list's or table's own) passes if its
best smoothed ratio, less its share of links, is over the bar. Paths that have
half of their text outside links pass whatever their ratio, so that short plain
items are kept: among plain text the ratios choose the element, not the blocks.

Defined results: a null or empty html, or a page without text, gives an empty
text; markup that doesn't close is closed as browsers do for paragraphs, items
and cells, else by the end of what surrounds it; white space inside a block
becomes one space, blocks are joined by a newline; unknown elements are inline,
and an inline element never ends a block: text of one that is never content is
left out of it; work and memory follow the page's length at any depth, since
paths are numbered and open elements are found by tag; repeated rows are extracted
each; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Share of the spread of smoothed ratios that makes a content node.
THRESHOLD = 0.5
SIGMA = 1.0

#: HTML's void elements, and those that make blocks. All others, unknown ones too, are inline.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that never hold main text.
APART = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input svg canvas iframe object audio video dialog menu".split()
)
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words in a class or id that say the same.
APART_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|ads?|advert\w*|sponsor\w*|promo\w*|banner|"
    r"cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|"
    r"comments?|commentlist|disqus|respond|reply|replies|widget|toolbar|pagination|pager|copyright|legal|disclaimer|skip)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
#: Class or id names that only say what a layout has.
LAYOUT_NAMES = re.compile(r"(?:^|[_-])(?:has|no|not|with|without|hide)(?:$|[_-])|(?:^|[_-])widgets?[_-]|[_-]widgets?$", re.IGNORECASE)
#: Words that in an article qualify its own parts, if more than the word is in the name.
PART_NAMES = re.compile(r"(?:^|[_-])(?:header|masthead|banner|notices?|alert|overlay|search|legal|disclaimer|copyright|skip)(?:$|[_-]|\d)", re.IGNORECASE)
#: Names of what may be longer than the content.
LONG_NAMES = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletter|subscribe|signup|related|recommended|comments?|commentlist|disqus|respond|reply|replies)(?:$|[_-]|\d)",
    re.IGNORECASE,
)
#: Shares of a page's ratio-weighted text from which a name doesn't set elements apart.
MOST, NEARLY_ALL = 0.5, 0.9
#: A start tag of the key closes an open element of the value.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "tbody": {"thead", "tbody"},
}
#: Elements that an implied end never leaves.
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
#: End tags of these close everything inside; others stop at them.
STRONG = frozenset("html body article main section nav header footer aside table div form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")


def _names(attrs: dict, article: bool) -> list[str]:
    """The class and id names that say that an element is no content."""
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    names = [n for n in names if APART_NAMES.search(n) and not LAYOUT_NAMES.search(n)]
    if article:
        rest = [PART_NAMES.sub("-", n) for n in names]
        names = [n for n, r in zip(names, rest, strict=True) if not r.strip("-_") and n.lower() != "header" or APART_NAMES.search(r)]
    return names


class Node:
    """An open or closed element. ``key`` numbers its tag path, ``outer`` is the
    outermost article or main element around it, ``listed`` the place of the
    nearest list or table; ``last`` is the place of the last element inside;
    ``depth`` is where in the stack that element begins that is never content."""

    __slots__ = ("apart", "key", "order", "last", "parent", "tag", "block", "article", "outer", "headed", "told", "listed", "header", "hard", "depth", "marks")

    def __init__(self, tag: str, attrs: dict, parent: Node | None, order: int, depth: int, paths: dict, ignored: frozenset[str] = frozenset()):
        article = bool(parent and parent.article)
        self.block = tag in BLOCK or parent is None
        hard = tag in APART and tag != "header" or (attrs.get("role") or "").lower() in APART_ROLES or "hidden" in attrs
        # What is set within a line of text, and a quotation in an article, is not told by its name.
        named = self.block and tag not in ("body", "html", "article", "main") and not (article and tag == "blockquote")
        mine = [(n, article) for n in _names(attrs, article) if n not in ignored] if named else []
        self.tag, self.parent, self.order, self.last = tag, parent, order, order
        self.hard = hard or bool(parent and parent.hard)
        self.depth = parent.depth if parent and parent.hard else depth if hard else 0
        self.marks: frozenset = parent.marks if parent else frozenset()
        if not self.marks.issuperset(mine):
            self.marks = self.marks.union(mine)
        self.apart = self.hard or bool(self.marks)
        self.article = tag in ("article", "main") or article
        self.outer = parent.outer if parent and parent.outer else self if self.article else None
        self.headed = tag in HEADINGS or bool(parent and parent.headed)
        self.told = self.headed or tag == "p" or bool(parent and parent.told)
        self.listed = order if tag in ("ul", "ol", "dl", "table") else parent.listed if parent else 0
        self.header = tag == "header" or bool(parent and parent.header)
        self.key = parent.key if parent else 0
        if self.block and parent:
            own = (self.key, tag, " ".join(sorted((attrs.get("class") or "").split())))
            self.key = paths.setdefault(own, len(paths) + 1)


class Blocks(HTMLParser):
    """Cuts a page into blocks (node, text, characters in links)."""

    def __init__(self, ignored: frozenset[str] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.ignored = ignored
        self.paths: dict[tuple, int] = {}
        self.stack: list[Node] = [Node("", {}, None, 0, 0, self.paths)]
        self.places: dict[str, list[int]] = defaultdict(list)  # of open elements in the stack, by tag
        self.blocks: list[tuple[Node, str, int]] = []
        self.held: list[str] = []
        self.owner: Node | None = None
        self.linked = self.links = self.count = 0

    def innermost(self, tags) -> int:
        """Place in the stack of the innermost open element of these tags; 0: none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                self.blocks.append((self.owner, text, min(self.linked, len(text))))
            self.held, self.owner, self.linked = [], None, 0

    def pop_to(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.links -= node.tag == "a"
            node.last = self.count
            self.places[node.tag].pop()
            if node.block and not node.parent.hard:
                self.flush()
        del self.stack[depth:]

    def close_implied(self, tag: str) -> None:
        closing = CLOSES.get(tag, frozenset())
        if tag in BLOCK:
            closing = {*closing, "p", *(HEADINGS if tag in HEADINGS else ())}
        walls = WALLS.get(tag, STRONG - {"head"})
        # Nothing in an element that is never content closes what is around it.
        while (at := self.innermost(closing)) > max(self.innermost(walls), self.stack[-1].depth - 1):
            self.pop_to(at)
            if tag not in ("tr", "td", "th"):
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        within = self.stack[-1].hard
        if tag in VOID:
            if tag in ("br", "wbr"):
                self.held.append(" " if tag == "br" and not within else "")
            elif tag == "hr" and not within:
                self.close_implied("div")
                self.flush()
            return
        self.close_implied(tag)
        self.count += 1
        node = Node(tag, dict(attrs), self.stack[-1], self.count, len(self.stack), self.paths, self.ignored)
        if node.block and not node.parent.hard:
            self.flush()
        self.links += tag == "a"
        self.places[tag].append(len(self.stack))
        self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        at = self.innermost((tag,))
        if tag == "p" and not at:
            if not self.stack[-1].hard:
                self.flush()
        elif at and (tag in STRONG or at > self.innermost(STRONG)):
            self.pop_to(at)

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if node.hard:  # a script or a button within a line doesn't end the block
            return
        if data.strip():
            if self.owner is None:
                self.owner = node
                while not self.owner.block:
                    self.owner = self.owner.parent
            if self.links:
                self.linked += len(data.strip())
        self.held.append(data)


def _spread(values: list[float]) -> float:
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def ratios(blocks: list[tuple[Node, str, int]]) -> list[float]:
    """The smoothed, fused path ratio of each block."""
    lengths, marks = defaultdict(list), defaultdict(list)
    for node, text, linked in blocks:
        lengths[node.key].append(len(text) - linked)
        marks[node.key].append(len(PUNCTUATION.findall(text)) * (1 - linked / len(text)))
    path = {}
    for key, n in lengths.items():
        p = marks[key]
        mean_n, mean_p = sum(n) / len(n), sum(p) / len(p)
        path[key] = math.log1p((mean_n + _spread(n)) * (mean_p + _spread(p) + 0.1))
    raw = [path[node.key] for node, _, _ in blocks]
    reach = math.ceil(2 * SIGMA)
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(raw)):
        near = [(raw[i + d], kernel[d + reach]) for d in range(-reach, reach + 1) if 0 <= i + d < len(raw)]
        out.append((raw[i] + sum(r * k for r, k in near) / sum(k for _, k in near)) / 2)
    return out


def _read(html: str, ignored: frozenset[str] = frozenset()) -> list[tuple[Node, str, int]]:
    """The page's blocks, without what tags and roles set apart. Of an article's own header, headings
    and paragraphs stay."""
    parser = Blocks(ignored)
    parser.feed(html)
    parser.close()
    parser.flush()
    parser.pop_to(1)
    parser.stack[0].last = parser.count
    return [b for b in parser.blocks if not b[0].hard and (not b[0].header or b[0].article and b[0].told)]


def _misnamed(blocks: list[tuple[Node, str, int]]) -> frozenset[str]:
    """Names whose elements hold too much of the page's ratio-weighted text, or
    of that in articles which they surround, to be no content."""
    marked = {name for node, _, _ in blocks for name, _ in node.marks}
    if not marked:
        return frozenset()
    total = in_articles = 0.0
    held, around = defaultdict(float), defaultdict(float)
    for (node, text, linked), s in zip(blocks, ratios(blocks), strict=True):
        w = s * (len(text) - linked + 1)
        total += w
        in_articles += w * node.article
        for name in {n for n, _ in node.marks}:
            held[name] += w
        for name in {n for n, within in node.marks if node.article and not within}:
            around[name] += w
    limit = {n: NEARLY_ALL if LONG_NAMES.search(n) else MOST for n in marked}
    return frozenset(n for n in marked if held[n] >= limit[n] * total or n in around and around[n] >= limit[n] * in_articles)


def _path(node: Node) -> tuple[int, int]:
    """A block's path, in a list or table of its own."""
    return node.key, node.listed


def _passing(blocks: list[tuple[Node, str, int]], score: list[float]) -> set[tuple[int, int]]:
    """Paths whose best smoothed ratio, less the share of links in the path's
    text, is over the bar, and paths of plain text, which have half of their
    text at least outside links."""
    top, chars, links = defaultdict(float), defaultdict(int), defaultdict(int)
    for (node, text, linked), s in zip(blocks, score, strict=True):
        path = _path(node)
        top[path] = max(top[path], s)
        chars[path] += len(text)
        links[path] += linked
    bar = THRESHOLD * _spread(score)
    return {k for k in top if 2 * links[k] <= chars[k] or top[k] * (1 - links[k] / chars[k]) >= bar}


def main_text(html: str | None) -> str:
    blocks = _read(html or "")
    if misnamed := _misnamed(blocks):
        blocks = _read(html or "", misnamed)
    if all(b[0].apart for b in blocks):  # names leave nothing
        blocks = _read(html or "", frozenset(name for b in blocks for name, _ in b[0].marks) | misnamed)
    blocks = [b for b in blocks if not b[0].apart]
    if not blocks:
        return ""
    score = ratios(blocks)
    passing = _passing(blocks, score)
    bar = THRESHOLD * _spread(score)
    top = max(score)
    nodes = [(b, s) for b, s in zip(blocks, score, strict=True) if s >= max(bar, top / 2)]
    # Outermost article or main elements win if they hold content nodes, each whose paths pass.
    weight: dict[Node, float] = defaultdict(float)
    for (node, text, _), s in zip(blocks, score, strict=True):
        if node.outer and s >= bar and _path(node) in passing:
            weight[node.outer] += s * len(text)
    if weight and any(b[0].article for b, _ in nodes):
        best = max(weight, key=lambda n: (weight[n], -n.order))
        inside = lambda node: node.outer in weight and node.outer.tag == best.tag
    else:
        # The smallest element around the parents of all content nodes.
        parents = [b[0].parent or b[0] for b, _ in nodes]
        low, high = min(n.order for n in parents), max(n.order for n in parents)
        around = parents[0]
        while not around.order <= low <= high <= around.last:
            around = around.parent
        inside = lambda node: around.order <= node.order <= around.last
    return "\n".join(text for node, text, _ in blocks if inside(node) and (_path(node) in passing or node.headed))


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The pages, all columns as they were, with their main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = pa.array([main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], done], [*batch.schema.names[:-1], text])

    keep: list[Column] = [F.col(c) for c in pages.columns if c != text]
    ready = pages.select(*keep, F.col(html).alias("__html"))
    schema = T.StructType([*ready.schema.fields[:-1], T.StructField(text, T.StringType(), False)])
    return ready.mapInArrow(run, schema)
