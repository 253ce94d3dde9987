"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of blocks: text between tags that break lines. Each block has its word
count, its link density, those of its neighbours, and what the enclosing tags say. A decision tree,
grown on the small labelled table below, marks the blocks of the article. Tags and names are weighed by
the text they hold: a form or a named element around the article is no frame, and a small element
named like an article does not turn the rest of the page away.

Defined results: null, empty or text-free pages give an empty text; unclosed tags end with the tag
around them, an unfinished tag at the end is dropped; rows are independent, so repeated rows give
repeated results; all columns but the html pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    r"|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>\"'<]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z))",
    re.DOTALL,
)
#: Tags whose content is no markup, up to their closing tag; tags whose content is not shown.
_RAW = {
    name: re.compile(rf"<(/?){name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE)
    for name in ("script", "style", "textarea", "title")
}
_SVG_END = re.compile(r"</svg(?=[\s/>])", re.IGNORECASE)
_HIDDEN = frozenset("noscript template select svg iframe object canvas".split())
_NAMED = re.compile(
    r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE
)
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr label input button".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_FRAME_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
_MAIN_TAGS = frozenset("article main".split())
#: Words in a class, id or role that name what is not the article, and what is.
_FRAME_WORDS = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|sidebar|side|footer|"
    r"header|masthead|breadcrumbs?|cookies?|consent|notice|popup|modal|overlay|alert|newsletter|"
    r"subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*|comments?|"
    r"respond|replies|reply|disqus|widget|toolbar|pagination|pager|tags|search|contentinfo|"
    r"complementary|navigation|copyright|legal|disclaimer|teaser)(?=$|[_-])",
    re.IGNORECASE,
)
_MAIN_WORDS = re.compile(
    r"(?:^|[\s_-])(?:article|content|entry|post|story|main|body)(?=$|[\s_-])", re.IGNORECASE
)
#: Names that say what an element has or is about, not what it is; heads of an article.
_STATEMENT = re.compile(r"(?:has|with|without|no|category|tag|format|status|type)[_-]", re.IGNORECASE)
_HEAD = re.compile(r"(?:^|[_-])(?:header|masthead)(?=$|[_-])", re.IGNORECASE)
_OWN_HEAD = re.compile(r"(?:article|entry|post|story)[_-](?:header|masthead)$", re.IGNORECASE)
#: Frames that stay frames however much they hold.
_NEVER_MAIN = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|sponsor\w*|nav\w*|menu|footer|breadcrumbs?|cookies?|consent|"
    r"newsletter|subscribe|subscription|signup|related|recommend\w*|comments?|respond|replies|"
    r"reply|disqus|contentinfo|complementary|copyright)(?=$|[_-])",
    re.IGNORECASE,
)
#: Tags whose opening ends an open one of the same kind.
_CLOSED_BY = {
    "p": frozenset(
        "p div ul ol dl table h1 h2 h3 h4 h5 h6 article section aside nav header footer form pre "
        "blockquote hr main address figure fieldset".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_STRUCTURE = _FRAME_TAGS | _MAIN_TAGS | frozenset("div section body html table ul ol dl".split())

#: Tags that the search for hidden elements follows; those that cannot be within select or svg.
_BREAKS = _STRUCTURE | _HEADINGS | _CLOSED_BY["p"] | frozenset("li dt dd tr td th".split())
_FOLLOWED = _BREAKS | _HIDDEN | frozenset(["foreignobject", "option", "optgroup"])


@dataclass
class Tag:
    start: int
    end: int
    #: Empty for comments, declarations and raw elements.
    name: str = ""
    closing: bool = False
    attributes: str = ""

    @property
    def empty(self) -> bool:
        return self.attributes.rstrip().endswith("/")


def _tags(page: str) -> list[Tag]:
    """The page's tags; a raw element is one of them with its content."""
    tags, at, in_svg = [], 0, False
    while found := _TOKEN.search(page, at):
        at = found.end()
        tag = Tag(found.start(), at, (found.group(2) or "").lower(), bool(found.group(1)),
                  found.group(3) or "")
        if tag.name == "svg" and not tag.empty:
            in_svg = not tag.closing
        elif tag.name in _RAW and not tag.closing:
            close = _RAW[tag.name].search(page, at)
            # written as empty, it has content only if its closing tag is the next of its kind
            while close and not close.group(1) and not tag.empty:
                close = _RAW[tag.name].search(page, close.end())
            closed = bool(close and close.group(1))
            svg_end = _SVG_END.search(page, at) if in_svg else None
            if svg_end and closed and close.start() > svg_end.start():
                closed = False
            if closed:
                at = close.end()
            elif not tag.empty and not svg_end:
                at = len(page)
            tag = Tag(tag.start, at)
        tags.append(tag)
    return tags


def _hidden(tags: list[Tag], size: int) -> dict[int, int]:
    """Numbers of the tags that open hidden content, and where it ends in the page of that size.

    Content is hidden up to a closing tag that comes while the element is open. An element that ends
    with another around it, or by content that it cannot hold, was empty; a select ends with its
    last option.
    """
    ends: dict[int, int] = {}
    if not any(t.name in _HIDDEN for t in tags):
        return ends
    stack: list[tuple[str, int]] = []
    options: dict[int, int] = {}

    def leave(depth: int, at: int) -> None:
        for name, k in stack[depth:]:
            if name == "select" and k in options:
                last = tags[options[k]]
                ends[k] = last.end if last.closing else at
        del stack[depth:]

    for k, tag in enumerate(tags):
        name = tag.name
        if name not in _FOLLOWED or name in _VOID and name != "hr":
            continue
        names = [n for n, _ in stack]
        if name in ("option", "optgroup"):
            if "select" in names:
                options[stack[len(names) - 1 - names[::-1].index("select")][1]] = k
            continue
        if tag.closing:
            if name in names:
                depth = len(names) - 1 - names[::-1].index(name)
                opened = stack[depth][1]
                leave(depth + 1, tag.start)
                stack.pop()
                if name in _HIDDEN:
                    ends[opened] = tag.end
            continue
        if names and names[-1] == "select" and name in _BREAKS | {"select"} and name != "hr":
            leave(len(stack) - 1, tag.start)
        elif names and names[-1] == "svg" and name in _BREAKS:
            while stack and stack[-1][0] == "svg":
                stack.pop()
        for depth in range(len(stack) - 1, -1, -1):
            opened = stack[depth][0]
            if opened in _STRUCTURE or opened in _HIDDEN:
                break
            if name in _CLOSED_BY.get(opened, ()):
                leave(depth, tag.start)
                break
        if not tag.empty and name != "hr":
            stack.append((name, k))
    leave(0, size)
    return ends


@dataclass(eq=False)
class Element:
    """An open tag, what it says of its text, and how much text without links it holds."""

    name: str
    frame: bool = False
    main: bool = False
    #: A frame that may turn out to hold the article; an article or main element; a container.
    may_wrap: bool = False
    certain: bool = False
    container: bool = False
    holds_main: bool = False
    words: int = 0
    prose: int = 0


@dataclass
class Block:
    text: str
    words: int
    linked: int
    frame: bool
    main: bool
    heading: bool
    within: tuple[Element, ...] = ()


def _frame_names(names: list[str], in_main: bool, in_certain: bool) -> list[str]:
    """The names that make an element a frame, by where it stands."""
    found = []
    for name in names:
        hit = _FRAME_WORDS.search(name)
        if not hit or _STATEMENT.match(name) or _OWN_HEAD.search(name):
            continue
        if in_main and _HEAD.search(name):
            continue
        # in an article, post-social is a part of the post; social and social-links are not
        if in_certain and (hit.start() or (hit.end() < len(name) and hit.group().lower() == "side")):
            continue
        found.append(name)
    return found


def _element(name: str, attributes: str, open_tags: list[Element]) -> Element:
    named = [(k.lower(), (a or b or c).split()) for k, a, b, c in _NAMED.findall(attributes)]
    names = [n for _, values in named for n in values]
    in_main = any(e.main and e.container for e in open_tags)
    in_certain = any(e.certain for e in open_tags)
    certain = name in _MAIN_TAGS or any(k == "role" and "main" in values for k, values in named)
    if certain or name in ("body", "html"):
        return Element(name, False, certain or bool(_MAIN_WORDS.search(" ".join(names))), False,
                       certain, certain)
    by_name = _frame_names(names, in_main, in_certain)
    # a header within the article holds its headline, not the site's
    by_tag = name in _FRAME_TAGS and not (name == "header" and in_main)
    frame = by_tag or bool(by_name)
    may_wrap = frame and (not by_tag or name == "form") and not any(map(_NEVER_MAIN.search, by_name))
    main = bool(names) and not frame and bool(_MAIN_WORDS.search(" ".join(names)))
    return Element(name, frame, main, may_wrap, False, name in _STRUCTURE)


def _settle(blocks: list[Block]) -> None:
    """What the page as a whole says of its elements, then of each block.

    A form or a named element that holds the article is no frame. Elements named like an article
    count if they hold most of the text outside frames; article and main elements, if they hold a
    quarter of it. Without such, no block is in the article by its tags.
    """
    total = prose = 0
    for b in blocks:
        free = b.words - b.linked
        long = free if b.words >= 10 and b.linked * 3 <= b.words else 0
        total, prose = total + free, prose + long
        certain = False
        for e in reversed(b.within):
            e.words, e.prose, e.holds_main = e.words + free, e.prose + long, e.holds_main or certain
            certain = certain or e.certain
    for e in {e for b in blocks for e in b.within if e.may_wrap}:
        if (e.holds_main and e.words * 2 > total) or (e.prose >= 40 and e.prose * 3 >= prose * 2):
            e.frame = False
    outside = in_main = in_certain = 0
    for b in blocks:
        b.frame = any(e.frame for e in b.within)
        if not b.frame:
            free = b.words - b.linked
            outside += free
            in_certain += free if any(e.certain for e in b.within) else 0
            in_main += free if any(e.main and e.container for e in b.within) else 0
    tags, named = in_certain * 4 >= outside and in_certain, in_main * 2 >= outside and in_main
    for b in blocks:
        b.main = any(e.main if named or not e.container else tags and e.certain for e in b.within)
        b.main = b.main and bool(tags or named)


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in page order."""
    blocks = list(_found_blocks(page))
    _settle(blocks)
    return blocks


def _found_blocks(page: str) -> Iterator[Block]:
    """The blocks with the elements they stand in; these say yet nothing of frames."""
    open_tags: list[Element] = []
    parts: list[str] = []
    linked: list[str] = []
    links = 0
    at = 0

    def finish() -> Iterator[Block]:
        words = "".join(parts).split()
        if words:
            in_links = len(" ".join(linked).split()) if linked else 0
            heading = any(e.name in _HEADINGS for e in open_tags)
            within = tuple(e for e in open_tags if e.frame or e.main)
            yield Block(" ".join(words), len(words), in_links, False, False, heading, within)
        parts.clear()
        linked.clear()

    tags = _tags(page)
    hidden = _hidden(tags, len(page))
    for k, tag in enumerate(tags):
        if tag.start < at:
            continue
        if tag.start > at:
            text = html.unescape(page[at : tag.start])
            parts.append(text)
            if links:
                linked.append(text)
        at = hidden.get(k, tag.end)
        name, closing = tag.name, tag.closing
        if not name or name in _HIDDEN:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE:
            yield from finish()
        if name in _VOID:
            continue
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        if closing:
            if name in _INLINE:
                names = [e.name for e in open_tags]
                if name in names and not _STRUCTURE.intersection(names[len(names) - names[::-1].index(name):]):
                    del open_tags[len(names) - 1 - names[::-1].index(name)]
            else:
                names = [e.name for e in open_tags]
                if name in names:
                    del open_tags[len(names) - 1 - names[::-1].index(name) :]
                    links = sum(e.name == "a" for e in open_tags)
            continue
        if tag.empty:
            continue
        for depth in range(len(open_tags) - 1, -1, -1):
            opened = open_tags[depth].name
            if opened in _STRUCTURE:
                break
            if name in _CLOSED_BY.get(opened, ()):
                del open_tags[depth:]
                links = sum(e.name == "a" for e in open_tags) + (name == "a")
                break
        open_tags.append(_element(name, tag.attributes, open_tags))
    if at < len(page) and not page.startswith("<", at):
        text = html.unescape(page[at:])
        parts.append(text)
        if links:
            linked.append(text)
    yield from finish()


#: Labelled blocks: words, link density, words and link density of the block before and the block
#: after, within a page frame (menu, advert, footer, ...), within an article element, whether the
#: page has an article element, heading; then 1 for article text.
LABELLED = """
words density before before_density after after_density frame main page_main heading article
1 1.0 0 0.0 1 1.0 1 0 1 0 0
1 1.0 1 1.0 1 1.0 1 0 1 0 0
2 1.0 1 1.0 6 0.0 1 0 1 0 0
1 1.0 1 1.0 1 1.0 1 0 0 0 0
3 1.0 3 1.0 2 1.0 0 0 0 0 0
2 0.9 2 1.0 2 1.0 0 0 0 0 0
6 0.0 1 1.0 8 0.0 1 0 1 0 0
12 0.1 1 1.0 9 0.0 1 0 1 0 0
40 0.0 2 1.0 7 0.0 1 0 1 0 0
25 0.2 60 0.0 0 0.0 1 0 1 0 0
12 0.0 75 0.0 0 0.0 1 0 1 0 0
9 0.0 5 0.0 0 0.0 1 0 1 0 0
120 0.0 30 0.0 12 0.0 1 0 0 0 0
60 0.0 80 0.0 20 0.0 1 1 1 0 0
15 0.0 40 0.0 22 0.0 1 1 1 0 0
3 0.0 90 0.0 15 0.0 1 1 1 1 0
4 1.0 70 0.0 4 1.0 1 1 1 0 0
30 0.0 20 0.0 9 0.0 1 0 0 0 0
8 0.0 6 0.0 8 0.0 0 1 1 1 1
8 0.0 8 0.0 60 0.0 0 1 1 0 1
60 0.0 8 0.0 45 0.0 0 1 1 0 1
45 0.0 60 0.0 3 0.0 0 1 1 0 1
3 0.0 45 0.0 70 0.0 0 1 1 0 1
1 0.0 20 0.0 30 0.0 0 1 1 0 1
1 0.0 3 0.0 12 0.0 0 1 1 0 1
2 0.5 60 0.0 40 0.0 0 1 1 0 1
6 1.0 50 0.0 60 0.0 0 1 1 0 1
1 1.0 12 0.0 80 0.0 0 1 1 1 1
300 0.02 60 0.0 90 0.0 0 1 1 0 1
70 0.4 60 0.0 12 0.0 0 1 1 0 1
5 0.0 1 1.0 30 0.0 0 0 1 0 0
30 0.0 4 1.0 8 0.0 0 0 1 0 0
90 0.0 4 1.0 8 0.0 0 0 1 0 0
9 0.0 80 0.0 0 0.0 0 0 1 0 0
7 0.0 0 0.0 1 1.0 0 0 1 1 0
4 0.0 0 0.0 3 1.0 0 0 1 1 0
60 0.0 6 0.0 55 0.0 0 0 0 0 1
55 0.1 60 0.0 70 0.0 0 0 0 0 1
30 0.0 25 0.0 40 0.0 0 0 0 0 1
18 0.0 60 0.0 45 0.1 0 0 0 0 1
5 0.0 70 0.0 60 0.0 0 0 0 0 1
7 0.0 2 1.0 60 0.0 0 0 0 1 1
4 0.0 30 0.0 25 0.0 0 0 0 1 1
120 0.05 2 1.0 3 1.0 0 0 0 0 1
6 0.0 0 0.0 0 0.0 0 0 0 0 1
12 0.0 9 0.0 0 0.0 0 0 0 0 1
9 0.0 0 0.0 12 0.0 0 0 0 0 1
20 0.8 4 1.0 5 1.0 0 0 0 0 0
30 0.7 3 1.0 10 0.9 0 0 0 0 0
300 0.0 150 0.0 200 0.0 0 0 1 0 1
200 0.02 300 0.0 180 0.0 0 0 1 0 1
250 0.0 200 0.0 9 0.0 0 0 1 0 1
400 0.0 250 0.0 300 0.0 1 0 0 0 1
350 0.02 400 0.0 280 0.0 1 0 0 0 1
400 0.0 250 0.0 300 0.0 1 0 1 0 0
350 0.02 90 0.0 60 0.0 1 1 1 0 0
300 0.8 40 1.0 20 0.9 1 0 0 0 0
8 0.0 300 0.0 0 0.0 1 0 0 0 0
25 0.0 400 0.0 4 1.0 1 0 0 0 0
60 0.0 250 0.0 300 0.0 1 0 0 0 0
420 0.0 20 0.0 30 0.0 1 0 0 0 1
130 0.0 60 0.0 45 0.0 1 0 1 0 0
150 0.0 90 0.0 110 0.0 1 1 1 0 0
8 0.0 6 1.0 60 0.0 1 0 0 0 0
10 0.0 1 1.0 80 0.0 1 0 1 0 0
20 0.0 1 1.0 120 0.0 1 1 1 0 0
2 1.0 3 1.0 90 0.0 1 0 1 0 0
40 0.0 90 0.0 70 0.0 1 1 1 0 0
12 0.0 1 1.0 40 0.0 1 0 0 0 0
6 0.0 4 1.0 60 0.0 0 0 1 0 0
25 0.0 2 1.0 90 0.0 0 0 1 0 0
90 0.0 60 0.0 45 0.0 0 0 1 0 0
7 0.0 0 0.0 60 0.0 0 0 1 1 0
15 1.0 2 1.0 60 0.0 0 0 0 0 0
2 1.0 1 1.0 50 0.0 0 0 0 0 0
5 0.0 90 0.0 14 0.0 0 1 1 0 1
33 0.0 102 0.0 20 0.0 0 1 1 0 1
13 0.0 6 0.0 3 0.0 0 1 1 0 1
26 0.0 9 0.0 12 0.0 0 1 1 0 1
120 0.0 85 0.0 30 0.0 0 1 1 0 1
9 0.0 200 0.0 2 0.0 0 1 1 0 1
40 0.0 2 1.0 7 1.0 0 1 1 0 1
4 0.0 5 1.0 6 1.0 0 1 1 0 1
7 0.0 1 1.0 9 0.0 0 1 1 1 1
2 0.0 80 0.0 0 0.0 0 1 1 0 1
20 0.0 100 0.0 10 1.0 0 1 1 0 1
6 0.0 90 0.0 25 0.0 0 0 0 0 1
25 0.0 120 0.0 8 0.0 0 0 0 0 1
40 0.1 2 1.0 3 1.0 0 0 0 0 1
8 0.0 2 1.0 14 0.0 0 0 0 1 1
8 0.6 60 0.0 3 1.0 0 0 0 0 0
10 0.9 8 0.9 30 0.0 0 0 0 0 0
"""


class Tree:
    """A decision tree by Gini impurity; splits are ``feature <= threshold``."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, depth: int = 6):
        self.share = float(labels.mean())
        self.feature = None
        if depth == 0 or self.share in (0.0, 1.0):
            return
        best = (self._impurity(labels) * len(labels) - 1e-9, None, None)
        for feature in range(features.shape[1]):
            values = np.unique(features[:, feature])
            for threshold in (values[1:] + values[:-1]) / 2:
                left = features[:, feature] <= threshold
                cost = left.sum() * self._impurity(labels[left])
                cost += (~left).sum() * self._impurity(labels[~left])
                if cost < best[0] - 1e-12:
                    best = (cost, feature, threshold)
        if best[1] is None:
            return
        _, self.feature, self.threshold = best
        left = features[:, self.feature] <= self.threshold
        self.below = Tree(features[left], labels[left], depth - 1)
        self.above = Tree(features[~left], labels[~left], depth - 1)

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        share = labels.mean()
        return 2 * share * (1 - share)

    def predict(self, row: tuple[float, ...]) -> bool:
        node = self
        while node.feature is not None:
            node = node.below if row[node.feature] <= node.threshold else node.above
        return node.share >= 0.5


def trained_tree() -> Tree:
    rows = [line.split() for line in LABELLED.strip().splitlines()[1:]]
    table = np.array(rows, float)
    return Tree(table[:, :-1], table[:, -1])


def main_text(page: str, tree: Tree) -> str:
    blocks = blocks_of(page)
    page_main = float(any(b.main for b in blocks))
    shape = [(b.words, b.linked / b.words if b.words else 0.0) for b in blocks]
    shape = [(0, 0.0), *shape, (0, 0.0)]
    kept = []
    for k, block in enumerate(blocks):
        row = (*shape[k + 1], *shape[k], *shape[k + 2], float(block.frame), float(block.main),
               page_main, float(block.heading))
        if tree.predict(row):
            kept.append(block.text)
    return "\n".join(kept)


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns but the html, and the main text."""
    others = [c for c in pages.columns if c not in (html_col, text_col)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained_tree()
        for batch in batches:
            texts = [main_text(p or "", tree) for p in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(texts, pa.string())],
                [*others, text_col],
            )

    schema = pages.select(*others).schema.add(text_col, "string")
    return pages.select(*others, html_col).mapInArrow(extract, schema)
