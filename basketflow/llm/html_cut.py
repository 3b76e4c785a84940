"""Main-text extraction by minimum-cut labelling of a page's blocks.

A tolerant tokenizer turns the page into text blocks (runs of text between
block tags) below their open elements.  A log-linear classifier over element kinds, attribute
words, place after the article, forms of notices and remarks, link density and length gives
each block a content cost and a boilerplate cost: these become the capacities
to the two terminals.  Neighbouring blocks and blocks with a near common
ancestor are joined by smoothness edges.  The maximum flow separates the
blocks; those on the content side of the minimum cut are the main text.

Boilerplate words on html, body and the elements that contain the article tell
of the page's layout, not of its text, and do not count (see ``_around_article``).

Comments, scripts, styles, forms, and other unrendered or input elements carry
no text.  Markup need not be well formed: an unclosed element ends with its
parent, a stray end tag is ignored, a page may end anywhere.  A null or empty
page gives the empty text.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import fresh, strings, with_fields

# Element kinds of HTML.
SILENT = frozenset("script style template noscript iframe object svg math canvas head title textarea select "
                   "option button form input audio video map datalist".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                  "section summary table caption tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SIBLING_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDING = frozenset("p li dt dd tr td th option".split())      # end by themselves where another begins
TELLING = frozenset("article main p li nav header footer aside menu dialog".split()) | HEADINGS
SCOPE = frozenset("table ul ol dl nav article section div body aside footer header main".split())

# Words in class, id and role attributes.
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert "
    "advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal newsletter "
    "subscribe signup login share sharing social related recommended comment comments respond reply replies disqus "
    "pagination pager copyright legal search toolbar skip responses reactions discussion feedback guestbook commenters".split())
BOILERPLATE_STEMS = ("comment", "sidebar", "cookie", "advert", "newsletter", "footer", "breadcrumb", "navbar", "popup",
                     "subscri", "sponsor", "masthead")          # also inside longer words
_AD_BOX = re.compile(r"ad(s|v|verts?)?(box|slot|unit|wrap|wrapper|container|content|space|block|zone|area|bar|holder|frame|panel|"
                     r"place|banner|label|sense|module|section|region)s?")
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
STATES = frozenset("has have with without no is not show hide open closed".split())   # "has-comments" tells of a layout

# Classifier weights (log odds of content; positive is content).
BIAS = 1.5
WEIGHTS = {"article": 3.0, "main": 2.5, "p": 0.8, "heading": 0.4, "li": -0.3, "nav": -6.0, "header": -5.0,
           "footer": -6.0, "aside": -6.0, "menu": -6.0, "dialog": -6.0, "content_word": 1.5, "boilerplate_word": -7.0,
           "bare_header": -6.0, "links": -4.0, "length": 0.35, "after": -2.5, "notice": -6.0, "remark": -5.0}
NOTE = 400                 # a notice is shorter
# How a copyright notice and a reader's remark begin.
_NOTICE = re.compile(r"(©|\(c\)\s|copyright\b.{0,40}\b(19|20)\d\d\b|all rights reserved)", re.I)
_REMARK = re.compile(r"(reply|report|permalink|\d+ (comments?|responses|replies)\b|[\w.\- ]{1,40} (says|said|wrote|replied|commented)( on\b[^.]{0,60}\d{4}[^.]{0,20})?:"
                     r"|[\w.\- ]{1,40} (on|at) \w+ \d{1,2}, \d{4}( at \d|:|$)|[\w.\- ]{1,40},? \d+ (minutes?|hours?|days?|weeks?|months?|years?) ago\b)", re.I)
ADJACENT = 0.8             # smoothness between neighbours under one parent
SCALE = 1000               # capacities are integers

_RAW_END = {n: re.compile(rf"</{n}\s*(?:>|\Z)|</{n}[\s/][^>]*(?:>|\Z)", re.I) for n in RAW}
# A quote opens a value only directly after "=" and only if it is closed; any other one is an ordinary character.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_NAME = r"[^\s/>][^\s/>=]*+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    rf"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+)(?:>|\Z)|[^<]+|<",
                    re.S)
_ATTR = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE}))?")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    at: _Element               # innermost element open at its end
    text: str
    linked: int                # characters inside links
    after: bool = False        # follows the last block of the page's article


class _Element:
    """An open element; what holds for all that is above it is carried down, so a block needs no walk up."""

    __slots__ = ("name", "number", "marks", "first", "parent", "block", "depth", "kinds", "inner", "heading", "held",
                 "blocks", "bad", "good", "in_main")

    def __init__(self, name: str, number: int, marks: frozenset, first: frozenset, parent: _Element | None):
        self.name, self.number, self.marks, self.first, self.parent = name, number, marks, first, parent
        self.block = self if name in BLOCK else parent.block if parent else None    # nearest block element
        self.depth = (parent.depth if parent else 0) + (name in BLOCK)
        kinds = parent.kinds if parent else frozenset()
        # a header inside the article is judged by its heading
        of_article = name == "header" and not kinds.isdisjoint(("article", "main"))
        self.inner = self if of_article else parent.inner if parent else None
        self.kinds = kinds if of_article or name in kinds or name not in TELLING else kinds | {name}
        self.heading = False
        self.held = self.blocks = 0                  # characters outside links, and blocks, inside
        self.bad = self.good = self.in_main = False  # boilerplate or content words on it or above

    def above(self) -> Iterator[_Element]:
        e: _Element | None = self
        while e is not None:
            yield e
            e = e.parent


_OUTSIDE = _Element("", -1, frozenset(), frozenset(), None)      # of text outside all elements


def _stemmed(words) -> bool:
    return any(stem in w for w in words for stem in BOILERPLATE_STEMS)


def _marks(attributes: str) -> tuple[frozenset, frozenset]:
    """Words of the class, id and role attributes, and the first word of each of their names; a hidden element is
    marked too."""
    if not attributes or ("=" not in attributes and "hidden" not in attributes.lower()):
        return frozenset(), frozenset()
    out: set[str] = set()
    first: set[str] = set()
    seen: set[str] = set()
    for key, value in _ATTR.findall(attributes):
        key = key.lower()
        if key in seen:                              # the first of equal attributes counts
            continue
        seen.add(key)
        if key == "hidden" or key == "aria-hidden" and value.strip("\"'").strip().lower() == "true":
            out.add("popup")
        elif key in ("class", "id", "role"):
            for one in value.lower().split():
                words = _WORD.findall(one)
                out.update(words)
                first.update(words[:1])
                if _stemmed(words) or any(_AD_BOX.fullmatch(w) for w in words):
                    out.add("sidebar")
    return frozenset(out), frozenset(first)


def _around_article(elements: list[_Element], total: int) -> set[int]:
    """Numbers of the elements whose boilerplate words do not count: html, body, and the article with all around it.

    ``elements``: those that hold a block, in page order; ``total``: all characters outside links.  The article is the
    main element and the longest article element that is not itself a comment or the like; on pages with neither, the
    longest element named as content, else the one of the first heading.  Without such an element only those that
    hold more than half of the text are taken to contain the article.
    """
    half = total / 2

    def own(e: _Element) -> bool:                    # boilerplate by its own names, "has-comments" aside
        first = e.first - STATES
        return not first & CONTENT_WORDS and (bool(first & BOILERPLATE_WORDS) or _stemmed(first))

    def longest(es: list[_Element]) -> list[_Element]:
        return [max(es, key=lambda e: (e.held, -e.number))] if es else []

    out = {e.number for e in elements if e.name in ("html", "body")
           or e.name == "article" and not (e.first & BOILERPLATE_WORDS or _stemmed(e.first))}
    mains = longest([e for e in elements if e.name == "main"])
    for e in elements:
        e.in_main = bool(mains) and (e is mains[0] or e.parent is not None and e.parent.in_main)
    articles = [e for e in elements if e.name == "article" and (not own(e) or e.held > half)]
    certain = mains + longest([e for e in articles if e.in_main] or articles)
    for e in certain:
        out.update(x.number for x in e.above())
    if not certain:
        named = [e for e in elements if e.first & CONTENT_WORDS and not own(e)] or [e for e in elements if e.name == "h1"]
        for e in longest(named):
            out.update(x.number for x in e.above() if x.held > half)
    return out


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, white space collapsed, references decoded.

    Linear in the page: an end tag or an implied end looks at the open elements only if counters of
    open names say that there is something to close.
    """
    stack: list[_Element] = []
    opened: dict[str, int] = {}                      # open elements by name
    inline: list[dict[str, int]] = [{}]              # of each open block element: inline ones opened in it
    scopes: list[dict[str, int]] = [{}]              # of each open scope: elements in it that may end by themselves
    elements: list[_Element] = []
    out: list[Block] = []
    held: list[str] = []
    linked = silent = links = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                out.append(Block(stack[-1] if stack else _OUTSIDE, text, linked))
            held.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal silent, links
        while len(stack) > at:
            e = stack[-1]
            if e.name in BLOCK:
                flush()
                inline.pop()
            else:
                inline[-1][e.name] -= 1
            stack.pop()
            opened[e.name] -= 1
            if e.name in SCOPE:
                scopes.pop()
            elif e.name in ENDING:
                scopes[-1][e.name] -= 1
            silent -= e.name in SILENT
            links -= e.name == "a"

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        name = m[2]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                if not silent:
                    held.append(m[0])
                    if links:
                        linked += len(m[0])
            elif m[0].startswith("<![CDATA[") and not silent:
                held.append(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
            continue
        name = name.lower()
        if m[1]:
            # an inline end tag does not reach beyond the block it stands in
            here = opened if name in BLOCK or name in SILENT else inline[-1]
            if here.get(name):
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                close(k)
            continue
        if name in BLOCK:
            flush()
        if name in CLOSES_P or name in SIBLING_END:
            ends = SIBLING_END.get(name, ())
            ending = (*ends, "p") if name in CLOSES_P else ends
            while any(scopes[-1].get(x) for x in ending):
                k = len(stack) - 1
                while stack[k].name not in ending:
                    k -= 1
                close(k)
                if stack and stack[-1].name not in ends:
                    break
        if name in VOID:
            if name == "br" and not silent:
                held.append(" ")
            continue
        e = _Element(name, len(elements), *_marks(m[3]), stack[-1] if stack else None)
        elements.append(e)
        stack.append(e)
        opened[name] = opened.get(name, 0) + 1
        if name in BLOCK:
            inline.append({})
        else:
            inline[-1][name] = inline[-1].get(name, 0) + 1
        if name in SCOPE:
            scopes.append({})
        elif name in ENDING:
            scopes[-1][name] = scopes[-1].get(name, 0) + 1
        if name in HEADINGS and e.inner is not None:
            e.inner.heading = True
        silent += name in SILENT
        links += name == "a"
        if name in RAW:                              # raw text up to its own end tag
            stop = _RAW_END[name].search(page, pos)
            pos = stop.end() if stop else end
            close(len(stack) - 1)
    close(0)
    flush()
    _carry(elements, out)
    return out


def _carry(elements: list[_Element], out: list[Block]) -> None:
    """Sums up the elements' texts, carries their words down and marks the blocks after the article."""
    total = 0
    for b in out:
        n = max(0, len(b.text) - b.linked)
        b.at.held += n
        b.at.blocks += 1
        total += n
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.held += e.held
            e.parent.blocks += e.blocks
    elements = [e for e in elements if e.blocks]
    spared = _around_article(elements, total) if any(e.marks & BOILERPLATE_WORDS for e in elements) else set()
    for e in elements:
        up = e.parent
        e.bad = up is not None and up.bad or e.number not in spared and not e.marks.isdisjoint(BOILERPLATE_WORDS)
        e.good = up is not None and up.good or not e.marks.isdisjoint(CONTENT_WORDS)
    ends = [i for i, b in enumerate(out) if not b.at.kinds.isdisjoint(("article", "main"))]
    if ends:
        for b in out[ends[-1] + 1:]:
            b.after = True


def log_odds(b: Block) -> float:
    """Log odds that a block is content."""
    e = b.at
    z = BIAS
    for kind in ("article", "main", "p", "li", "nav", "header", "footer", "aside", "menu", "dialog"):
        if kind in e.kinds:
            z += WEIGHTS[kind]
    if e.inner is not None and not e.inner.heading and "header" not in e.kinds:
        z += WEIGHTS["bare_header"]
    if not e.kinds.isdisjoint(HEADINGS):
        z += WEIGHTS["heading"]
    if e.bad:
        z += WEIGHTS["boilerplate_word"]
    elif e.good:
        z += WEIGHTS["content_word"]
    if b.after:
        z += WEIGHTS["after"]
    if e.kinds.isdisjoint(("article", "main")):
        if len(b.text) < NOTE and _NOTICE.match(b.text):
            z += WEIGHTS["notice"]
        if _REMARK.match(b.text):
            z += WEIGHTS["remark"]
    z += WEIGHTS["links"] * min(1.0, b.linked / len(b.text))
    return z + WEIGHTS["length"] * (math.log1p(len(b.text)) - 4.0)


def _smoothness(a: Block, b: Block) -> float:
    """Higher for blocks whose nearest common ancestor is near."""
    x, y, away = a.at.block, b.at.block, 0
    while x is not y:
        dx, dy = x.depth if x else 0, y.depth if y else 0
        if dx >= dy:
            x, away = x.parent.block if x.parent else None, away + 1
        if dy >= dx:
            y, away = y.parent.block if y.parent else None, away + 1
    return ADJACENT / (1 + max(0, away - 2))


def min_cut(content: list[int], boilerplate: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for nodes on the content side of a minimum cut (Dinic's algorithm).

    ``content[i]`` is paid if node ``i`` is labelled boilerplate,
    ``boilerplate[i]`` if it is labelled content, an edge's weight if its ends
    get different labels.
    """
    n = len(content)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forward: int, backward: int) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forward)
        out[b].append(len(to))
        to.append(a)
        cap.append(backward)

    for i in range(n):
        both = min(content[i], boilerplate[i])       # this much flows straight through
        if content[i] > both:
            link(s, i, content[i] - both, 0)
        elif boilerplate[i] > both:
            link(i, t, boilerplate[i] - both, 0)
    for a, b, w in edges:
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:                                  # blocking flow without recursion
            if u == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                cut = next(k for k, e in enumerate(path) if cap[e] == 0)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[u] < len(out[u]):
                e = out[u][nxt[u]]
                if cap[e] > 0 and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(out[u]):
                path.append(e)
                u = to[e]
            elif u == s:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def extract(page: str | None) -> str:
    """Main text of a page: its content blocks joined by an empty line."""
    if not page:
        return ""
    bs = blocks(page)
    odds = [log_odds(b) for b in bs]
    content = [round(SCALE * max(0.0, z)) for z in odds]
    boilerplate = [round(SCALE * max(0.0, -z)) for z in odds]
    edges = [(i, i + 1, round(SCALE * _smoothness(bs[i], bs[i + 1]))) for i in range(len(bs) - 1)]
    last: dict[int, int] = {}                        # DOM proximity beyond neighbours: next block of the same parent
    for i, b in enumerate(bs):
        up = b.at.block.parent.block if b.at.block and b.at.block.parent else None
        parent = up.number if up else -1
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, round(SCALE * _smoothness(bs[last[parent]], b))))
        last[parent] = i
    keep = min_cut(content, boilerplate, edges)
    return "\n\n".join(b.text for b, k in zip(bs, keep, strict=True) if k)


def extract_pages(df: DataFrame, html_col: str = "html", out_col: str = "text", keep_html: bool = False) -> DataFrame:
    """Add the main text (replaces a column of that name)."""
    schema = with_fields(df.schema, [T.StructField(out_col, T.StringType())], () if keep_html else (html_col,))
    carried = [n for n in schema.names if n != out_col]
    given = fresh(df, "html_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in strings(batch.column(given))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(texts, pa.string())],
                                             names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{html_col}`").cast("string").alias(given)) \
        .mapInArrow(run, schema)
