"""Main-text extraction by minimum-cut labelling.

A page becomes its text blocks in page order. A linear classifier over tag,
class, length and link features gives each block a cost per label; these are
the capacities to source (content) and sink (boilerplate). Smoothness edges
tie neighbouring blocks and blocks of the same container, the more the closer
they are in the DOM. The blocks left on the source side of the minimum cut
are the main text.

The evidence of a block is that of the strongest element around it, not a sum:
a boilerplate element inside the article outweighs the article, and an article
inside boilerplate (a teaser, a comment) counts for nothing. A tag or name that
speaks of boilerplate is void on an element around the page's largest article
or main element, as that is a wrapper; on pages with neither it counts the less
the more of the page's text it holds. Without evidence the cost is small, and
the blocks around decide.

Defined results:

* null or empty html, or a page without a content block: empty text;
* script, style, title, comments and other unseen text never form blocks;
  what else stands in a head is part of the page, as ``</head>`` and ``<body>``
  can be left out;
* an unseen element without its end hides the rest of the page if it holds raw
  text (``RAW``), else nothing;
* formulas (``math``) are text, without their annotations;
* ``br`` and any white space inside a block become one space, blocks are
  trimmed, empty blocks are dropped, the rest are joined by a line break;
* tags that are never closed end with their parent or the page;
* repeated rows and null ids: each row gives its own result; empty table:
  empty result; other columns are ignored.

Each page is one graph, solved inside one row; its size is that of the page.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm.common import bound_batches, pick

# Element kinds of the HTML standard.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre
search section select summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
UNSEEN = RAW | frozenset("template noscript object svg canvas audio video annotation annotation-xml".split())
# An opening tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
          "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
BARRIER = {"li": {"ul", "ol", "menu", "dir"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}, "optgroup": {"select"}}

# Classifier: evidence in hundredths, positive for content.
TAG_COST = {"article": 250, "main": 200, "nav": -900, "footer": -900, "aside": -900, "form": -900, "menu": -900,
            "button": -900, "select": -900, "label": -500, "dialog": -900, "search": -900, "fieldset": -900, "header": -600}
ROLE_COST = {"navigation": -900, "banner": -900, "contentinfo": -900, "complementary": -900, "search": -900, "form": -900,
             "dialog": -900, "alert": -900, "alertdialog": -900, "menu": -900, "menubar": -900, "main": 200, "article": 250}
BOILERPLATE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
notice overlay pagination pager popup promo promoted promotion recommended related respond share sharing sidebar signup social
sponsor sponsored subscribe subscription toolbar widget""".split())
# Names that are ordinary words too: they do not count in longer names.
WORD_NAMES = frozenset("banner comment header menu modal notice overlay promotion recommended related respond share sharing social".split())
HEAD_NAMES = frozenset("banner header masthead".split())
CONTENT_NAMES = frozenset("article articlebody content entry main post story text".split())
DENIALS = frozenset("free has have hide no non with without".split())
NAME_COST, CONTENT_NAME_COST = -900, 100
START_COST = -30      # of a block without any evidence
WORD_COST = 12        # per word, up to
WORDS_MOST = 40
HEADING_COST = 60
LINK_COST = -500      # times the share of characters in links
NEAR, FAR = 120, 30   # edge capacities: same container, elsewhere

_TAG = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
_ATTR = re.compile(r"""([a-zA-Z-]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")


def _name_cost(name: str) -> tuple[int, int]:
    """What one class or id says: (against content, for content)."""
    words = [w for w in _SPLIT.split(name) if w]
    if DENIALS.intersection(words):
        return 0, 0
    bad, good = BOILERPLATE_NAMES.intersection(words), CONTENT_NAMES.intersection(words)
    if len(words) > 2:
        bad -= WORD_NAMES
    if good and bad <= HEAD_NAMES:
        return 0, CONTENT_NAME_COST  # the head of the text itself
    return (NAME_COST, 0) if bad else (0, CONTENT_NAME_COST if good else 0)


@lru_cache(maxsize=4096)
def _attribute_cost(attrs: str) -> tuple[int, int, bool]:
    """Evidence of an element's attributes: against content, for content, and
    whether it is hidden."""
    against, forth, hidden = 0, 0, False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            for x in value.split():
                bad, good = _name_cost(x)
                against, forth = min(against, bad), max(forth, good)
        elif name == "role":
            cost = ROLE_COST.get(value, 0)
            against, forth = min(against, cost), max(forth, cost)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
    return against, forth, hidden


class Elements:
    """The block elements of a page, numbered in page order (0 is the page):
    each one's parent, evidence and text."""

    def __init__(self):
        self.parent, self.against, self.forth, self.hidden = [0], [0], [0], [False]
        self.marks, self.chars = [False], [0]

    def add(self, tag: str, attrs: str, parent: int, in_text: bool) -> int:
        cost = TAG_COST.get(tag, 0)
        against, forth, hidden = _attribute_cost(attrs) if attrs.strip() else (0, 0, False)
        if tag == "header" and (in_text or forth):
            cost = 0  # the head of the article itself
        self.parent.append(parent)
        self.marks.append((tag in ("article", "main") or forth > CONTENT_NAME_COST) and not against)
        self.against.append(min(cost, against))
        self.forth.append(max(cost, forth))
        self.hidden.append(hidden)
        self.chars.append(0)
        return len(self.parent) - 1

    def evidence(self) -> list[int]:
        """Of every element, with what is around it; see the module doc."""
        n = len(self.parent)
        for e in range(n - 1, 0, -1):
            self.chars[self.parent[e]] += self.chars[e]
        largest = max((e for e in range(n) if self.marks[e]), key=lambda e: self.chars[e], default=None)
        wrappers, e = {0}, largest or 0
        while e:
            wrappers.add(e)
            e = self.parent[e]
        out = [0]
        for e in range(1, n):
            around, against = out[self.parent[e]], self.against[e]
            if e in wrappers:
                against = 0
            elif largest is None:
                share = self.chars[e] / max(1, self.chars[0])
                against = int(against * min(1.0, 2 * (1 - share)))
            if self.hidden[e]:
                against = NAME_COST
            if against < 0 or around < 0:
                out.append(min(around, against, 0))
            else:
                out.append(max(around, self.forth[e]))
        return out


@lru_cache(maxsize=64)
def _marks(tag: str) -> re.Pattern:
    """Opening and closing tags of ``tag``, and the text that holds no tags."""
    return re.compile(rf"""<!--(?s:.*?)(?:-->|\Z)|<(?:script|style)\b(?s:.*?)(?:</(?:script|style)[^>]*+>|\Z)"""
                      rf"""|<(/?){re.escape(tag)}(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)""", re.I)


def _ends(page: str, tag: str) -> dict[int, int]:
    """Where each closed element ``tag`` of a page starts and ends."""
    ends, open_at = {}, []
    for m in _marks(tag).finditer(page):
        if m[1]:
            if open_at:
                ends[open_at.pop()] = m.end()
        elif m[2] and not m[2].endswith("/>"):
            open_at.append(m.start())
    return ends


class Block:
    """Text of one block, its cost and the container it stands in."""

    __slots__ = ("text", "cost", "container", "depth")

    def __init__(self, text: str, cost: int, container: int, depth: int):
        self.text, self.cost, self.container, self.depth = text, cost, container, depth


def blocks(page: str) -> list[Block]:
    """The visible text blocks of a page, in page order."""
    out: list[Block] = []
    elements = Elements()
    own: list[int] = []  # element of each block
    stack = [("", 0)]    # (tag, number of the element)
    opened = {"": 1}
    link, part, linked = False, [], 0
    ends: dict[str, dict[int, int]] = {}
    heading = 0

    def pop() -> None:
        nonlocal heading
        tag = stack.pop()[0]
        opened[tag] -= 1
        heading -= tag in HEADINGS

    def flush() -> None:
        nonlocal part, linked
        if part:
            raw = "".join(part)
            text = " ".join(unescape(raw).split())
            if text:
                cost = START_COST + WORD_COST * min(WORDS_MOST, text.count(" ") + 1)
                cost += HEADING_COST * (heading > 0) + LINK_COST * linked // max(1, len(raw))
                # A paragraph stands in its parent, as do its neighbours.
                at = stack[-2] if len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS) else stack[-1]
                out.append(Block(text, cost, at[1], len(stack)))
                own.append(stack[-1][1])
                elements.chars[stack[-1][1]] += len(text)
            part, linked = [], 0

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            part.append(page[at:])
            linked += (n - at) * link
            break
        if m.start() > at:
            part.append(page[at:m.start()])
            linked += (m.start() - at) * link
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), m[1] or m[4]
        if tag == "a":
            link = not closing
        elif tag == "br":
            part.append(" ")
        elif tag in UNSEEN:
            if not closing:
                attrs = m[3] or m[6] or ""
                if attrs.endswith("/"):
                    continue
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                    at = end.end() if end else n
                else:
                    if tag not in ends:
                        ends[tag] = _ends(page, tag)
                    at = ends[tag].get(m.start(), at)
        elif tag in BLOCKS:
            flush()
            link = False
            if tag == "body" or tag == "html":
                continue
            if closing:
                if opened.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            while stack[-1][0] == "p" or stack[-1][0] in HEADINGS and tag in HEADINGS:
                pop()
            if tag in CLOSES and any(opened.get(x) for x in CLOSES[tag]):
                stop = BARRIER.get(tag, set())
                depth = len(stack) - 1
                while depth and stack[depth][0] not in CLOSES[tag] and stack[depth][0] not in stop:
                    depth -= 1
                if depth and stack[depth][0] in CLOSES[tag]:
                    while len(stack) > depth:
                        pop()
            if tag in VOID:
                continue
            in_text = bool(opened.get("article") or opened.get("main"))
            stack.append((tag, elements.add(tag, m[3] or m[6] or "", stack[-1][1], in_text)))
            opened[tag] = opened.get(tag, 0) + 1
            heading += tag in HEADINGS
    flush()
    around = elements.evidence()
    for b, e in zip(out, own, strict=True):
        b.cost += around[e]
    return out


def edges(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges (block, block, capacity): page neighbours, closer
    ones more, and each block with the last one before it in its container."""
    out, last = [], {}
    for i, b in enumerate(found):
        before = last.get(b.container)
        if i:
            near = found[i - 1].container == b.container
            out.append((i - 1, i, NEAR if near else FAR // (1 + abs(found[i - 1].depth - b.depth))))
        if before is not None and before != i - 1:
            out.append((before, i, NEAR // 2))
        last[b.container] = i
    return out


def min_cut(costs: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source, by maximum flow (blocking flows in
    level graphs). A positive cost is the capacity from the source, a
    negative one that to the sink; the smallest source side of equal cuts."""
    n = len(costs)
    if all(c > 0 for c in costs) or not any(c > 0 for c in costs):
        return [c > 0 for c in costs]  # one terminal has no capacity: no flow
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(there)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            add(source, i, c, 0)
        elif c < 0:
            add(i, sink, -c, 0)
    for a, b, c in ties:
        if c:
            add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        todo = deque([source])
        while todo:
            a = todo.popleft()
            for e in out[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    todo.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                keep = next(i for i, e in enumerate(path) if not cap[e])
                a = to[path[keep] ^ 1]
                del path[keep:]
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if cap[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    keep = min_cut([b.cost for b in found], edges(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """A row per page: ``page_id``, ``url``, ``text``, ``n_chars``."""
    bound_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pick(pages, page_id="page_id", url="url", html="html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
