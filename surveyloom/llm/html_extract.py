"""Main text of web pages by minimum-cut labelling.

A page is a sequence of text blocks. A linear classifier over the tags, names and links of a block gives the cost of calling it
content or boilerplate (terminal capacities); neighbours and blocks whose elements have one parent are tied by smoothness edges.
The minimum cut, found by max-flow, is the labelling of least total cost. What is never read as text (scripts, styles, forms,
hidden elements) and what its tag, role or name lists as menu, notice, advert, comment or the like is boilerplate for certain, unless
the listed element is a wrapper around the page's article; everything else can be outweighed.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator, Set
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements, attributes and classes with a known part in a page.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
NEVER = set("script style noscript template iframe object svg canvas math head title textarea select option optgroup datalist button form fieldset input audio video map dialog".split())
LISTED_TAGS = set("nav aside menu footer".split())
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS_PARAGRAPH = set("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
LISTED_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
LISTED_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies disclaimer disqus"
    " footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup popups promo promoted promotion recommended related"
    " replies respond share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets".split()
)
CONTENT_NAMES = set("article articlebody body content entry main post story text".split())

#: Capacities are in hundredths of a nat. CERTAIN outweighs any sum of the others.
CERTAIN = 10**9
#: Weights of the classifier: inside an article or main element, outside it where a page has one (more so if that holds most of the
#: page's text), inside an element named as content (where a page has no main), a heading, a paragraph, a character of text (up
#: to 200), the share of text in links (of a heading, which may link to its own page), and the bias.
IN_MAIN, IN_CONTENT, HEADING, PARAGRAPH, CHARACTER, LINKED, LINKED_HEADING, BIAS = 250, 300, 60, 60, 2, -600, -300, -120
OUTSIDE, OUTSIDE_MOST = -250, -450
#: A listed element around all of main and most of the text of a page: its name tells little.
WRAPPER = -250
#: A cut between neighbours, and between neighbours whose elements have one parent.
NEIGHBOUR, SIBLING = 30, 60

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    parent: int
    never: bool
    main: bool
    content: bool
    #: The innermost listed element that it is in or is (0: none).
    listed: int = 0
    #: The parent of the innermost element that ends blocks.
    place: int = 0


@dataclass(slots=True)
class Block:
    parent: int
    never: bool
    main: bool
    content: bool
    listed: int
    heading: bool
    paragraph: bool
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


class Page(NamedTuple):
    """Text blocks in page order, and each listed element with the listed element around it (0: none), outer ones first."""

    blocks: list[Block]
    listed: dict[int, int]


class _Open:
    """The open elements. What is asked of them takes no longer in a deep page: the places of each tag are kept."""

    def __init__(self) -> None:
        self.stack = [Element("", 0, 0, False, False, False)]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def has(self, *tags: str) -> bool:
        return any(self.places.get(tag) for tag in tags)

    def _last(self, tags: tuple[str, ...]) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def close(self, tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """End the innermost element of `tags` and all within it, unless an element of `scope` stands between."""
        at = self._last(tags)
        if at > self._last(scope):
            while len(self.stack) > at:
                self.places[self.stack.pop().tag].pop()


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _element(tag: str, source: str, number: int, parent: Element) -> Element:
    own = _attributes(source) if not parent.never and ("=" in source or source.strip()) else {}
    main = parent.main or tag in MAIN
    never, listed, content = parent.never or tag in NEVER, tag in LISTED_TAGS, parent.content
    if own:
        names = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{own.get('class', '')} {own.get('id', '')}").lower()))
        page = tag in ("html", "body")
        main = main or own.get("role") in MAIN or own.get("itemprop") == "articleBody"
        never = never or "hidden" in own or own.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", own.get("style", "")))
        listed = listed or own.get("role") in LISTED_ROLES or (not page and tag not in MAIN and bool(names & LISTED_NAMES))
        content = content or bool(names & CONTENT_NAMES and not page)
    # The header of a page is not the header of its article.
    listed = listed or (tag == "header" and not main)
    place = parent.place if tag in INLINE else parent.number
    return Element(tag, number, parent.number, never, main, content, number if listed else parent.listed, place)


def read_page(source: str) -> Page:
    """The text blocks of a page; tags that only style text do not end a block, every other tag does."""
    open_, out, current, number = _Open(), [], None, 0
    within: dict[int, int] = {}
    close = open_.close

    def add(text: str) -> None:
        nonlocal current
        top = open_.stack[-1]
        if current is None or current.never != top.never or current.listed != top.listed:
            if not text.strip():
                return
            current = Block(top.place, top.never, top.main, top.content, top.listed, open_.has(*HEADINGS), open_.has("p"))
            out.append(current)
        decoded = text if top.never else html.unescape(text)
        current.pieces.append(decoded)
        if not top.never and open_.has("a"):
            current.linked += len(decoded.strip())

    at = 0
    while at < len(source):
        found = _TOKEN.search(source, at)
        if found is None:
            add(source[at:])
            break
        if found.start() > at:
            add(source[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag == "br":
            if current is not None:
                current.pieces.append(" ")
            continue
        if tag not in INLINE:
            current = None
        if found[1]:
            close((tag,), ("table",) if tag not in ("table", "body", "html") else ())
            continue
        if tag in ENDS_PARAGRAPH:
            close(("p",), ("button", "table", "td", "th", "object"))
        if tag in SAME_ENDS:
            close(SAME_ENDS[tag][:1], SCOPES[tag])
            for other in SAME_ENDS[tag][1:]:
                close((other,), SCOPES[tag])
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
            at = end.end()
            current = current if tag in INLINE else None
            continue
        if tag in VOID:
            continue
        number += 1
        parent = open_.stack[-1]
        open_.push(_element(tag, found[3], number, parent))
        if open_.stack[-1].listed == number:
            within[number] = parent.listed
    for block in out:
        block.text = " ".join("".join(block.pieces).split())
    return Page([b for b in out if b.text], within)


def wrappers(page: Page) -> set[int]:
    """Listed elements that hold all of main and more than half of the text outside links, and lie in no other listed one but such.

    The name of such an element (`with-sidebar`) tells little. 0, no listed element, is one of them.
    """
    plain, mains = Counter(), Counter()
    for block in page.blocks:
        if not block.never:
            plain[block.listed] += max(len(block.text) - block.linked, 0)
            mains[block.listed] += block.main
    all_plain, all_mains = sum(plain.values()), sum(mains.values())
    for number, around in reversed(page.listed.items()):
        plain[around] += plain[number]
        mains[around] += mains[number]
    out = {0}
    for number, around in page.listed.items():
        if around in out and 2 * plain[number] > all_plain and mains[number] == all_mains:
            out.add(number)
    return out


def outside_weight(page: Page) -> int | None:
    """What speaks against a block outside main; None if the page has no main."""
    shown = [b for b in page.blocks if not b.never]
    if not any(b.main for b in shown):
        return None
    plain = [0, 0]
    for block in shown:
        plain[block.main] += max(len(block.text) - block.linked, 0)
    return OUTSIDE_MOST if plain[1] > plain[0] else OUTSIDE


def evidence(block: Block, outside: int | None, around: Set[int] = frozenset({0})) -> int:
    """Hundredths of a nat in favour of content; `around` are the wrappers of the page."""
    if block.never or block.listed not in around:
        return -CERTAIN
    size = len(block.text)
    score = BIAS + CHARACTER * min(size, 200) + (LINKED_HEADING if block.heading else LINKED) * min(block.linked, size) // size
    score += IN_CONTENT * block.content if outside is None else (IN_MAIN if block.main else outside)
    if block.listed:
        score += WRAPPER
    return score + HEADING * block.heading + PARAGRAPH * block.paragraph


class Flow:
    """Max-flow by shortest augmenting paths in layers; nodes 0 (source) and 1 (sink) are the terminals."""

    def __init__(self, nodes: int):
        self.edges: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def connect(self, a: int, b: int, forth: int, back: int) -> None:
        for x, y, capacity in ((a, b, forth), (b, a, back)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.room.append(capacity)

    def _levels(self) -> list[int]:
        level = [-1] * len(self.edges)
        level[0] = 0
        queue = deque([0])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self) -> list[bool]:
        """Which nodes stay with the source in the minimum cut."""
        while (level := self._levels())[1] >= 0:
            following = [0] * len(self.edges)
            path: list[int] = []
            node = 0
            while True:
                if node == 1:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    path, node = [], 0
                while following[node] < len(self.edges[node]):
                    e = self.edges[node][following[node]]
                    if self.room[e] and level[self.to[e]] == level[node] + 1:
                        break
                    following[node] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    node = self.to[e ^ 1]
                    following[node] += 1
                    continue
                path.append(e)
                node = self.to[e]
        return [x >= 0 for x in level]


def content_blocks(page: Page) -> list[bool]:
    """Which blocks are content: the source side of the minimum cut."""
    outside, around, found = outside_weight(page), wrappers(page), page.blocks
    flow = Flow(len(found) + 2)
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        score = evidence(block, outside, around)
        flow.connect(0, i + 2, max(score, 0), 0) if score >= 0 else flow.connect(i + 2, 1, -score, 0)
        if i:
            flow.connect(i + 1, i + 2, NEIGHBOUR, NEIGHBOUR)
        if block.parent in last:
            flow.connect(last[block.parent] + 2, i + 2, SIBLING, SIBLING)
        last[block.parent] = i
    return flow.source_side()[2:]


def main_text(source: str | None) -> str:
    """The content blocks of a page, one on a line."""
    page = read_page(source or "")
    return "\n".join(b.text for b, keep in zip(page.blocks, content_blocks(page)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html).

    White space of a block is one space, character references are decoded, blocks are joined by a line feed. A null or empty
    html gives an empty text; page_id and url pass through, nulls and repeated rows included. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source) for source in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
