"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of text blocks.  A small linear classifier over a
block's place and text gives the costs of calling it content or boilerplate:
the capacities to the two terminals.  Neighbouring blocks, and blocks that
stand close in the document tree, are joined by edges whose capacity is the
cost of labelling them differently.  The minimum cut is the cheapest labelling.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without text of the page.
SILENT = frozenset("script style noscript template head title svg math iframe object embed canvas audio video map "
                   "select option datalist button textarea input label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul".split())
#: Elements and roles that are never the article; words of a class or id that speak against it or for it.
OUTSIDE = frozenset("nav footer aside menu dialog".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                          "toolbar tablist".split())
#: Elements and roles that speak against the article as such words do; some pages wrap all they have in one.
DOUBTED, DOUBTED_ROLES = frozenset("form fieldset".split()), frozenset("form note status".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation menu menus submenu topbar toolbar breadcrumb breadcrumbs crumbs pagination pager tabs "
    "sidebar sidebars aside rail widget widgets footer foot masthead "
    "cookie cookies consent gdpr notice notices notification alert banner popup modal overlay paywall disclaimer "
    "newsletter subscribe subscription signup signin login register form search searchbox "
    "comment comments commentlist commenter respond reply replies discussion disqus "
    "share sharing social follow related recommended recommendations trending popular teaser teasers copyright legal".split())
INSIDE_WORDS = frozenset("article content main post entry story text body prose story-body articlebody".split())
HEADER = frozenset("header".split())
COMMENT_WORDS = frozenset("comment comments commentlist commenter respond reply replies discussion disqus".split())
#: An element with more than this share of a page's text is a wrapper: what its class, id or form says is no sign.
#: Comments never are, however many there are.
WRAPPER = 0.6
#: Marking elements that a text remembers, the nearest.
NESTED = 8
#: Capacities: weights of the classifier and of the smoothness edges.
WEIGHTS = {"bias": -0.4, "inside": 3.0, "heading": 0.9, "paragraph": 1.0, "length": 1.6, "sentences": 0.7, "links": -4.0,
           "list": -0.5, "top": -0.6, "legal": -2.5, "word": -4.5, "header": -4.5}
ADJACENT, SIBLING, NEAR = 0.5, 0.8, 0.5
HARD = 10 ** 9
SCALE = 1000
LEGAL = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|\bcookies?\b.{0,80}\b(accept|consent|policy)", re.IGNORECASE)


class Block:
    """A text with its place: the numbers of its holder's parent and grandparent, and the elements whose words mark it."""
    __slots__ = ("text", "linked", "tag", "depth", "parent", "grand", "outside", "inside", "header", "marks")

    def __init__(self, text: str, linked: int, tag: str, depth: int, parent: int, grand: int, outside: bool, inside: bool, header: bool, marks: tuple):
        self.text, self.linked, self.tag, self.depth, self.parent, self.grand = text, linked, tag, depth, parent, grand
        self.outside, self.inside, self.header, self.marks = outside, inside, header, marks


class Open(NamedTuple):
    """An open element with what its texts inherit; ``holder`` is the nearest block element."""
    tag: str
    holder: str = ""
    number: int = 0
    parent: int = 0
    grand: int = 0
    depth: int = 0
    outside: bool = False
    inside: bool = False
    header: bool = False
    silent: bool = False
    linked: bool = False
    #: (kind, number) of the nearest elements around that words speak against.
    marks: tuple = ()


def _words(value: str) -> set[str]:
    return set(re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))


class Blocks(HTMLParser):
    """Text blocks of a page in order, with the numbers of their nearest ancestors."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[Open] = [Open("")]
        self.number, self.parts, self.linked = 0, [], 0
        self.tags: Counter[str] = Counter()
        #: Per marking element the characters of text without links in it, and the page's.
        self.prose: Counter[int] = Counter()
        self.all_prose = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.open[-1]
                self.blocks.append(Block(text, self.linked, top.holder, top.depth, top.parent, top.grand, top.outside, top.inside, top.header, top.marks))
                if not top.outside:
                    plain = max(len(text) - self.linked, 0)
                    self.all_prose += plain
                    for _, number in top.marks:
                        self.prose[number] += plain
            self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.flush()
            closes = ("p",) if tag != "li" else ("p", "li")
            closes = {"dd": ("p", "dt", "dd"), "dt": ("p", "dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
                      "tr": ("td", "th", "tr")}.get(tag, closes)
            for c in closes:
                if self.tags[c]:
                    self._implied(c, tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        top = self.open[-1]
        outside, inside, header, marks = top.outside, top.inside, top.header, top.marks
        words: set[str] = set()
        main, doubted = tag in ("article", "main"), tag in DOUBTED
        for k, v in attrs:
            if k in ("class", "id") and v:
                words |= _words(v)
            elif k == "role" and v:
                outside = outside or v.strip().lower() in OUTSIDE_ROLES
                doubted = doubted or v.strip().lower() in DOUBTED_ROLES
                main = main or v.strip().lower() in ("main", "article")
            elif k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and re.search(r"display\s*:\s*none", v):
                outside = True
        if tag in OUTSIDE:
            outside = True
        self.number += 1
        if main:
            marks = ()  # whatever its wrappers say
        elif tag not in ("html", "body") and (doubted or words & OUTSIDE_WORDS):
            inside = False  # such as comments within the article
            kind = "comment" if words & COMMENT_WORDS else "word"
            marks = (*marks, (kind, self.number))[-NESTED:]
        inside = inside or main or bool(words & INSIDE_WORDS)
        header = header or tag in HEADER
        if words & HEADER and tag not in ("html", "body", "article", "main") and tag not in HEADER:
            marks = (*marks, ("header", self.number))[-NESTED:]
        holder, parent, grand, depth, own = top.holder, top.parent, top.grand, top.depth, top.number
        if tag in BLOCK:
            holder, parent, grand, depth, own = tag, top.number, top.parent, depth + 1, self.number
        self.open.append(Open(tag, holder, own, parent, grand, depth, outside, inside, header, top.silent or tag in SILENT, top.linked or tag == "a", marks))
        self.tags[tag] += 1

    def _close(self, i: int) -> None:
        for x in self.open[i:]:
            self.tags[x.tag] -= 1
        del self.open[i:]

    def _implied(self, tag: str, by: str) -> None:
        """A new block ends an open element of the kinds it can't stand in, unless a container lies between."""
        for i in range(len(self.open) - 1, 0, -1):
            t = self.open[i].tag
            if t == tag:
                self._close(i)
                return
            if t in BLOCK and t not in ("p", "dt", "dd", "td", "th", "li") or t in ("ul", "ol") and by == "li":
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        if not self.tags[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close(i)
                return
            if self.open[i].tag in BLOCK and tag not in BLOCK:
                return  # an inline end tag does not close a block

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if not top.silent:
            self.parts.append(data)
            if top.linked:
                self.linked += len(data.strip())


def blocks(html: str) -> list[Block]:
    parser = Blocks()
    # A tag cut off by the end of the page is markup, not text.
    parser.feed(re.sub(r"<[A-Za-z/!][^<>]*\Z", "", html))
    parser.close()
    parser.flush()
    wrappers = {n for n, size in parser.prose.items() if size > WRAPPER * parser.all_prose}
    for b in parser.blocks:
        b.marks = tuple(m for m in b.marks if m[0] == "comment" or m[1] not in wrappers)
    return parser.blocks


def costs(found: list[Block]) -> list[int]:
    """The classifier: positive is the cost of calling the block boilerplate, negative of calling it content."""
    out = []
    for b in found:
        heading = len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()
        if b.outside:
            out.append(-HARD)
            continue
        n = len(b.text)
        x = WEIGHTS["bias"] + WEIGHTS["inside"] * b.inside + WEIGHTS["links"] * min(1.0, b.linked / n)
        x += WEIGHTS["heading"] * heading + WEIGHTS["paragraph"] * (b.tag in ("p", "blockquote", "pre"))
        x += WEIGHTS["length"] * min(1.0, n / 200) + WEIGHTS["sentences"] * (b.text[-1] in ".!?…:\"”»")
        x += WEIGHTS["list"] * (b.tag == "li") + WEIGHTS["top"] * (b.depth <= 2 and not b.inside)
        kinds = {kind for kind, _ in b.marks}
        x += WEIGHTS["word"] * bool(kinds & {"word", "comment"}) + WEIGHTS["header"] * ((b.header or "header" in kinds) and not (b.inside and b.tag == "h1"))
        x += WEIGHTS["legal"] * bool(LEGAL.search(b.text) and n < 300 and not b.inside)
        out.append(round(SCALE * x))
    return out


def edges(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness: each block with the next, more strongly under one parent; and with the last before it in its container."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            same = found[i - 1].parent == b.parent
            out.append((i - 1, i, round(SCALE * (SIBLING if same else ADJACENT))))
        near = b.grand if b.tag in ("li", "td", "th", "dd", "dt") else b.parent
        if near in last and last[near] < i - 1:
            out.append((last[near], i, round(SCALE * NEAR)))
        last[near] = i
    return out


def minimum_cut(cost: list[int], smooth: list[tuple[int, int, int]]) -> list[bool]:
    """Maximum flow by levels and blocking flows; True for the blocks on the content side of the cut.

    A block joins one terminal, by what its costs differ; equal costs lean to boilerplate.
    """
    n = len(cost)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(u: int, v: int, there: int, back: int) -> None:
        at[u].append(len(to))
        to.append(v)
        room.append(there)
        at[v].append(len(to))
        to.append(u)
        room.append(back)

    for i, c in enumerate(cost):
        if c > 0:
            edge(source, i, c, 0)
        elif c < 0:
            edge(i, sink, -c, 0)
    for u, v, w in smooth:
        edge(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in at[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        step = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(j for j, e in enumerate(path) if not room[e])
                u = to[path[k] ^ 1]
                del path[k:]
            while step[u] < len(at[u]) and not (room[at[u][step[u]]] and level[to[at[u][step[u]]]] == level[u] + 1):
                step[u] += 1
            if step[u] < len(at[u]):
                path.append(at[u][step[u]])
                u = to[path[-1]]
            elif path:
                u = to[path.pop() ^ 1]
                step[u] += 1
            else:
                break


def main_text(html: str) -> str:
    found = blocks(html)
    keep = minimum_cut(costs(found), edges(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html.

    Null and empty html, and pages without content, give an empty text.  Broken
    markup is read as browsers do: open elements end with the page.  Repeated
    rows and null ids are pages of their own; an empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
