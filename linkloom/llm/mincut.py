"""Main text of web pages by minimum-cut labelling.

A page is read into text blocks, the stretches between block-level tags. Each block
has a cost for either label from a small linear classifier over its ancestors, links,
length and wording. Blocks are nodes between a source (content) and a sink
(boilerplate): costs are the capacities to the terminals, and blocks that follow each
other or share a parent are tied by edges that weigh less the further apart they stand
in the tree. The minimum cut is the labelling of least total cost. Nodes whose cost
exceeds all their ties keep their label in every minimum cut and are settled first;
maximum flow decides the rest.

A page is one row's work, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is never text of the page: those read as raw text up to their closing tag or the page's end,
# and ordinary ones, which end with their parent, and before the next block if they have no closing tag.
RAW = "script|style|title|noscript|iframe|textarea"
SKIPPED = frozenset("template object svg select button audio video canvas".split())
MATH = frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split()
)
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
# Opening tags that end an svg around them, and a skipped element without a closing tag.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
# Parts of an svg that hold other markup.
EMBEDDING = frozenset("foreignobject desc title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag that ends an open one of the second set, unless one of the third stands between.
ENDS_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
           "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ())}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])([^>]*)>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>)|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z""",
    re.S | re.I,
)
_SKIPPED_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])|\Z)|<(/?)({'|'.join(sorted(SKIPPED))})(?=[\s/>])", re.S | re.I
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)

# Weights of ancestors. Those in STICKY hold for all that stands inside them; a form's ends at an article or main element.
TAGS = {"article": 4.0, "main": 4.0, "nav": -6.0, "footer": -6.0, "aside": -6.0, "form": -6.0, "menu": -6.0, "dialog": -6.0,
        "header": -4.0, "fieldset": -4.0, "address": -2.0, "figcaption": 0.5}
STICKY = frozenset({"nav", "footer", "aside", "form", "menu", "dialog"})
SOFT_ROLES = frozenset({"search", "form", "dialog"})
ROLES = {"navigation": -6.0, "banner": -5.0, "contentinfo": -6.0, "complementary": -6.0, "search": -6.0, "form": -6.0, "dialog": -6.0,
         "alert": -5.0, "menu": -6.0, "menubar": -6.0, "main": 4.0, "article": 4.0}
NEGATIVE = re.compile(
    r"(?<!has[-_])(?<!with[-_])(?<!no[-_])(?:^|(?<=[-_ ]))(?:nav|navbar|navigation|menu|menus|sidebar|side|footer|foot|header|masthead|banner|ad|ads|adv|advert|adverts|advertisement|promo|"
    r"sponsor|sponsored|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|share|sharing|social|comment|comments|reply|replies|"
    r"respond|disqus|discussion|related|recommended|breadcrumb|breadcrumbs|subscribe|subscription|newsletter|signup|login|search|widget|widgets|"
    r"toolbar|pagination|pager|copyright|legal|disclaimer|tags|skip|hidden|form)(?=$|[-_ \d])"
)
# Words of it that an article standing inside does not undo, unless it is large; a main element does.
FIRM = frozenset(
    "nav navbar navigation menu menus sidebar footer ad ads advert adverts advertisement promo sponsor sponsored cookie cookies consent popup modal "
    "share sharing comment comments reply replies respond disqus related recommended newsletter widget widgets breadcrumb breadcrumbs".split()
)
# Those of them that name readers' comments, which may well be most of a page.
TALK = frozenset("comment comments reply replies respond disqus".split())
# How far a marker holds for what stands inside, from nowhere to everywhere.
NOT, IN_FORM, IN_WORD, IN_TALK, ALWAYS = range(5)
# An element that holds this share of the page's unlinked text is a wrapper of the page, whatever its marker says: one around
# a heading, article or main element, and any other. An article of the last share undoes firm words.
WRAPPER, BARE_WRAPPER, LARGE = 0.5, 0.8, 0.25
POSITIVE = re.compile(r"(?:^|[-_ ])(?:article|content|post|entry|story|main|body|text|hentry|blog)(?=$|[-_ \d])")
WORDING = re.compile(r"©|\ball rights reserved\b|\badvertisement\b|\bsponsored\b|\bcookies?\b|\bsign up\b|\bsubscribe\b|\blog ?in\b|\bread more\b", re.I)

# Ties: weight of an edge between blocks one parent apart, and the whole units of flow per unit of cost.
TIE = 0.75
UNITS = 1000


@lru_cache(maxsize=20_000)
def _marker(tag: str, attributes: str) -> tuple[float, int, str]:
    """What an element says about the blocks inside it, how far that holds, and whether it is an article or main element."""
    weight, holds, kind = TAGS.get(tag, 0.0), NOT if tag not in STICKY else IN_FORM if tag == "form" else ALWAYS, tag if tag in ("article", "main") else ""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return weight, holds, kind
    for name, *values, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if hidden or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return -8.0, ALWAYS, ""
        if name == "role" and value in ROLES:
            weight += ROLES[value]
            if ROLES[value] <= -6:
                holds = max(holds, IN_FORM if value in SOFT_ROLES else ALWAYS)
            elif value in ("article", "main"):
                kind = value
        elif name in ("class", "id", "aria-label") and tag not in ("html", "body"):
            bad, good = NEGATIVE.search(value), POSITIVE.search(value)
            if bad and bad[0] == "header" and good:
                continue  # an entry's header holds its title
            if bad:
                weight -= 5.0
                if bad[0] in FIRM and not good:
                    holds = max(holds, IN_TALK if bad[0] in TALK else IN_WORD)
            elif good:
                weight += 2.0
    return weight, holds, kind


@dataclass
class Block:
    text: str
    cost: float
    path: tuple[int, ...]


@dataclass
class Element:
    parent: int
    weight: float
    holds: int
    kind: str
    always: bool  # inside of what holds everywhere
    plain: int = 0  # characters of unlinked text
    leads: bool = False  # holds a heading of the first level, an article or a main element
    head: bool = False  # holds a heading of the first level or a main element


class _Reader:
    """Collects a page's blocks, with the open elements at each."""

    def __init__(self):
        # open elements: tag, number
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.elements = [Element(0, 0.0, NOT, "", False)]
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        # place of the outermost open skipped element in the stack, and whether it has a closing tag
        self.skipped, self.closed = 0, False

    def text(self, raw: str) -> None:
        if self.skipped:
            return
        if self.links:
            self.linked += len(raw) - raw.count(" ")
        self.parts.append(raw)

    def flush(self) -> None:
        if self.parts:
            words = unescape("".join(self.parts)).split()
            if words:
                self.add(words)
            self.parts.clear()
        self.linked = 0

    def add(self, words: list[str]) -> None:
        text = " ".join(words)
        # the block belongs to its nearest block-level ancestor
        chain = [e for e in self.stack if e[0] not in INLINE]
        tag, number = chain[-1]
        shown = len(text) - len(words) + 1
        density = min(1.0, self.linked / max(1, shown))
        cost = min(2.0, 0.4 * len(words).bit_length()) - 0.3
        if density > 0.3:
            cost -= 4.0 * density
        if text[-1] in ".!?…\"”»":
            cost += 0.5
        if tag in ("li", "td", "th", "dt", "label", "option"):
            cost -= 0.5
        if WORDING.search(text):
            cost -= 2.0 if len(words) < 30 else 0.3
        self.blocks.append(Block(text, cost, tuple(e[1] for e in chain)))
        element = self.elements[number]
        if not element.always:
            element.plain += max(0, shown - self.linked)
            element.leads = element.leads or tag == "h1"
            element.head = element.head or tag == "h1"

    def in_svg(self) -> bool:
        """Whether the place is inside an svg, and not in a part of it that holds other markup."""
        for e in reversed(self.stack[self.skipped:] if self.skipped else []):
            if e[0] == "svg" or e[0] in EMBEDDING:
                return e[0] == "svg"
        return False

    def skip(self, tag: str, attributes: str, closed: bool) -> None:
        """Open a skipped element."""
        if attributes.endswith("/") and (tag == "svg" or not closed):
            return
        if tag in ("button", "select"):
            self.close_to([tag], ())
        self.skipped, self.closed = len(self.stack), closed
        self.stack.append((tag, 0))

    def open(self, tag: str, attributes: str) -> None:
        if self.skipped and tag in BLOCKS and (not self.closed or self.stack[self.skipped][0] == "svg" and self.in_svg()):
            self.drop(self.skipped)
        if self.skipped:
            if tag not in VOID and not attributes.endswith("/"):
                self.links += tag == "a"
                self.stack.append((tag, 0))
            return
        if tag in MATH and attributes.endswith("/"):
            return
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag not in INLINE:
            if tag in ENDS_BY:
                ends, stops = ENDS_BY[tag]
                self.close_to(ends.split(), stops)
            else:
                self.close_to(["p"], ("td", "th", "li", "div", "section", "article", "body"))
        if tag == "p":
            self.close_to(["p"], ("td", "th", "li", "div", "section", "article", "body"))
        self.links += tag == "a"
        weight, holds, kind = _marker(tag, attributes)
        if tag == "header" and any(e[0] in ("article", "main") for e in self.stack):
            weight = 0.0  # an article's own header holds its title
        parent = self.stack[-1][1]
        self.stack.append((tag, len(self.elements)))
        self.elements.append(Element(parent, weight, holds, kind, holds == ALWAYS or self.elements[parent].always))

    def settle(self) -> list[Block]:
        """The blocks, with what their ancestors say added to their costs, which takes the whole page's text."""
        elements = self.elements
        for e in reversed(elements[1:]):
            outer = elements[e.parent]
            if not outer.always:
                outer.plain += e.plain
                outer.leads = outer.leads or e.leads or e.kind != ""
                outer.head = outer.head or e.head or e.kind == "main"
        total = elements[0].plain
        costs, held = [0.0], [NOT]
        for e in elements[1:]:
            weight, holds, outer, sticky = e.weight, e.holds, costs[e.parent], held[e.parent]
            if NOT < holds < ALWAYS and _wraps(e, total):
                weight, holds = max(weight, 0.0), NOT
            if sticky < ALWAYS and (e.kind == "main" or e.kind == "article" and (sticky == IN_FORM or sticky == IN_WORD and e.plain >= LARGE * total)):
                sticky = NOT
            # inner markers count more than outer ones, but little lifts a block out of a menu
            inner = 0.5 * outer + weight if weight else outer
            costs.append(min(inner, outer) if sticky else inner)
            held.append(max(sticky, holds))
        for block in self.blocks:
            block.cost += costs[block.path[-1]]
        return self.blocks

    def close_to(self, tags: list[str], stops: tuple[str, ...]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                self.drop(k)
                return
            if self.stack[k][0] in stops:
                return

    def close(self, tag: str) -> None:
        if self.skipped:
            for k in range(len(self.stack) - 1, self.skipped - 1, -1):
                if self.stack[k][0] == tag:
                    self.drop(k)
                    return
            if tag in INLINE and self.closed or all(e[0] != tag for e in self.stack[:self.skipped]):
                return
            self.drop(self.skipped)
        if tag not in INLINE:
            self.flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                self.drop(k)
                return
            if tag in INLINE and self.stack[k][0] not in INLINE:
                return

    def drop(self, k: int) -> None:
        self.links -= sum(e[0] == "a" for e in self.stack[k:])
        del self.stack[k:]
        if k <= self.skipped:
            self.skipped = 0


def _wraps(e: Element, total: int) -> bool:
    """Whether an element holds most of the page's text; one named after comments needs the page's heading, too."""
    if e.holds == IN_TALK:
        return e.head and e.plain > WRAPPER * total
    return e.plain > (WRAPPER if e.leads else BARE_WRAPPER) * total


def _closed(html: str) -> set[int]:
    """Places of the skipped elements' opening tags that have a closing tag of their own."""
    waiting: dict[str, list[int]] = {tag: [] for tag in SKIPPED}
    found = set()
    for tag in _SKIPPED_TAG.finditer(html):
        if tag[3]:
            same = waiting[tag[3].lower()]
            if not tag[2]:
                same.append(tag.start())
            elif same:
                found.add(same.pop())
    return found


def blocks(html: str) -> list[Block]:
    reader, at = _Reader(), 0
    closed: set[int] | None = None
    while found := _TOKEN.search(html, at):
        start = found.start()
        if start > at:
            reader.text(html[at:start])
        at = found.end()
        tag = found[4]
        if tag is None:
            if found[1] and found[2].endswith("/") and reader.in_svg():
                at = found.end(2) + 1  # in an svg these end where they begin
            continue
        tag = tag.lower()
        if found[3]:
            reader.close(tag)
        elif tag in SKIPPED and not reader.skipped:
            if closed is None:
                closed = _closed(html)
            reader.skip(tag, found[5][:-1], start in closed)
        else:
            attributes = found[5][:-1]
            reader.open(tag, attributes)
            if attributes.endswith("/") and tag not in VOID and tag not in INLINE and reader.stack[-1][0] == tag and tag in ("div", "p", "span"):
                reader.close(tag)
    if at < len(html):
        reader.text(html[at:])
    reader.flush()
    return reader.settle()


def ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges between neighbours and between blocks of one parent, lighter with distance in the tree."""
    made: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for k, block in enumerate(found):
        parent = block.path[-2] if len(block.path) > 1 else block.path[-1]
        for other in {k - 1, last.get(parent, k)} - {-1, k}:
            path = found[other].path
            common = 0
            for a, b in zip(path, block.path, strict=False):
                if a != b:
                    break
                common += 1
            steps = len(path) + len(block.path) - 2 * common
            made[other, k] = round(UNITS * TIE / max(1, steps - 1) ** 2)
        last[parent] = k
    return [(a, b, w) for (a, b), w in made.items() if w]


def label(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labelling of least cost: a node pays its cost's size if labelled against its sign, an edge if it is cut.

    True is the source's side; a node that both labels suit alike goes to the sink's.
    """
    costs = list(costs)
    near: list[dict[int, int]] = [{} for _ in costs]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    fixed: list[bool | None] = [None] * len(costs)
    waiting = deque(range(len(costs)))
    while waiting:
        k = waiting.popleft()
        if fixed[k] is None and abs(costs[k]) > sum(near[k].values()):
            fixed[k] = costs[k] > 0
            for other, w in near[k].items():
                costs[other] += w if fixed[k] else -w
                del near[other][k]
                waiting.append(other)
            near[k] = {}
    rest = [k for k in range(len(costs)) if fixed[k] is None]
    if rest:
        reached = _source_side(rest, costs, near)
        for k in rest:
            fixed[k] = k in reached
    return [bool(f) for f in fixed]


def _source_side(nodes: list[int], costs: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow, by shortest augmenting paths."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {k: dict(near[k]) for k in nodes}
    left[source] = {k: costs[k] for k in nodes if costs[k] > 0}
    left[sink] = {}
    for k in nodes:
        if costs[k] < 0:
            left[k][sink] = -costs[k]
    while True:
        came = {source: source}
        line = deque([source])
        while line and sink not in came:
            k = line.popleft()
            for other, room in left[k].items():
                if room > 0 and other not in came:
                    came[other] = k
                    line.append(other)
        if sink not in came:
            return set(came)
        path, k = [], sink
        while k != source:
            path.append((came[k], k))
            k = came[k]
        flow = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= flow
            left[b][a] = left[b].get(a, 0) + flow


def main_text(html: str | None) -> str:
    """The page's content blocks in order, joined by an empty line. Null and empty pages give an empty text."""
    found = blocks(html) if html else []
    if not found:
        return ""
    kept = label([round(UNITS * b.cost) for b in found], ties(found))
    return "\n\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of ``pages(page_id, url, html)``: page_id, url, text, n_chars; a row per row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [main_text(html) for html in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
