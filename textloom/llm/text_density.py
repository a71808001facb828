"""Main-text extraction by composite text density.

For every DOM node: characters per tag, adjusted for links (Sun, Song and Liao, "DOM Based Content
Extraction via Text Density"). A node's density sum adds its children's densities and that of its
own direct text. Of all nodes, body included, the one with the largest sum seeds the article; the subtree grows
along the path to the body while each parent is at least as dense as the whole body. Blocks beside that path are taken
too if most of their text is no link and their density or density sum reaches the least density on the path; a <section>
beside a chosen <section> always is. The tags article and main decide nothing. Elements that are never article text
(menus, headers, footers, adverts, comments ...) count for the body's density but can't be chosen. What marks them is their
tag, role, or a class or id made of words of a list; the mark of a word or a form doesn't hold where the node has most of
the page's unlinked text and a larger density sum than any unmarked node outside. A class or id that only contains such a word
("user-comments", "ad-slot", "with-sidebar") is a suspicion, which the node's own shape decides (``confirmed``). A block of links alone is a
menu, whatever its class.

Defined results: null or empty html, or html without text, gives ""; broken or cut markup is read
as far as it goes; text outside any tag belongs to the body; ties go to the outer node, then to the
first in page order.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm.staging import only

#: Raw-text elements: dropped with all they hold.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|canvas|select|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't end a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
BOILER_TAGS = frozenset("nav header footer aside form button menu dialog fieldset input optgroup option datalist "
                        "figcaption audio video head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
#: Words that mark what isn't article text: a class or id is such a word, or made of such words only ("cookie-notice").
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars aside widget widgets header masthead footer comment comments disqus reply "
    "replies respond reactions related recommended recommendations share sharing social toolbar pagination pager skip copyright "
    "legal disclaimer".split())
#: Words that as a part of a longer name say little about the block (a legal history, an article's header).
WEAK_WORDS = frozenset("header masthead legal share sharing social copyright disclaimer reply replies respond reactions skip aside".split())
#: Kinds of ``boiler``: by a word, or a form, which may wrap a whole page, so that the density sums may overrule it; by anything else; a
#: name that only contains a word.
MARKED, FIRM, SUSPECT = 1, 2, 3
WRAPPERS = frozenset(("form", "fieldset"))
#: A node with more than this share of the page's unlinked text holds most of it.
MOST_TEXT = 2 / 3
#: Suspected blocks: entries of one shape that make a list, and the share of the page's unlinked text that one with a button may hold.
ENTRIES, CONTROL_TEXT = 3, 1 / 3
#: A menu: at least so many links, which hold so much of the text.
MENU_LINKS, MENU_SHARE = 3, 0.9
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("form button input".split())
#: A start tag on the left closes an open element on the right.
_P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                       "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table td th tr ul dd dt body".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
#: An unclosed element above one of these is not closed from inside it.
SCOPES = frozenset("table td th ul ol dl body article section div main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + RAW + r")\b[^>]*>.*?(?:</\1\s*[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")


class _Node:
    __slots__ = ("tag", "parent", "parts", "boiler", "chars", "tags", "link_chars", "link_tags", "own", "own_tags", "density", "total", "best", "most", "free",
                 "attrs", "controls", "links", "squares")

    def __init__(self, tag: str, parent: _Node | None, boiler: int, attrs: str = ""):
        self.tag, self.parent, self.boiler, self.attrs = tag, parent, boiler, attrs
        self.controls = self.links = self.squares = 0  # form controls, links, and squared characters of each block, in the subtree
        self.parts: list = []  # text and child nodes in page order; None for a line break inside a block
        self.chars = self.tags = self.link_chars = self.link_tags = self.own = self.own_tags = 0
        self.density = self.total = 0.0
        self.most = self.free = 0.0  # the largest density sum below, marks aside, and below no mark
        self.best: _Node | None = None  # the largest density sum below, this node included


def _mark(tag: str, attrs: str) -> int:
    """``MARKED``, ``FIRM``, ``SUSPECT`` or 0 by an element's own tag and attributes."""
    mark = 0 if tag not in BOILER_TAGS else MARKED if tag in WRAPPERS else FIRM
    if not attrs or tag in ("body", "html", "article", "main"):
        return mark
    for m in _ATTR.finditer(attrs):
        kind = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if kind == "role":
            if value.strip() in BOILER_ROLES:
                return FIRM
        elif kind == "hidden" or kind == "aria-hidden":
            if kind == "hidden" or value == "true":
                return FIRM
        elif mark != FIRM and mark != MARKED:
            for words in map(_WORD.findall, value.split()):
                if words and BOILER_WORDS.issuperset(words):
                    mark = MARKED
                    break
                if any(w in BOILER_WORDS and w not in WEAK_WORDS for w in words):
                    mark = SUSPECT
    return mark


def parse(page: str) -> tuple[_Node, list[_Node]]:
    """A light DOM: the root, and every node in page order. Tolerates unclosed and stray tags."""
    root = _Node("body", None, 0)
    nodes, at, pos = [root], root, 0
    for m in _TOKEN.finditer(page):
        if m.start() > pos:
            at.parts.append(page[pos:m.start()])
        pos = m.end()
        name = m[3]
        if name is None:
            continue
        tag = name.lower()
        if tag in ("html", "body"):
            if not m[2]:  # what a head that was never closed holds ends here
                at = root if tag == "body" else at
            continue
        if m[2]:
            up = at
            while up is not root and up.tag != tag:
                if up.tag in SCOPES and tag in INLINE:
                    up = root
                    break
                up = up.parent
            if up is not root:
                at = up.parent
            continue
        if tag in _P_CLOSERS:
            up = at
            while up is not root and up.tag != "p" and (up.tag in INLINE or up.tag in _P_CLOSERS and up.tag not in SCOPES and tag == "p" and up.tag[0] != "h"):
                up = up.parent
            if up.tag == "p":
                at = up.parent
            elif at.tag in INLINE:  # a block inside an unclosed inline element: the inline one ends
                while at is not root and at.tag in INLINE:
                    at = at.parent
        if tag in CLOSES:
            up = at
            while up is not root and up.tag not in CLOSES[tag] and up.tag not in ("ul", "ol", "dl", "table", "select"):
                up = up.parent
            if up.tag in CLOSES[tag]:
                at = up.parent
        if tag == "br" or tag == "hr":
            at.parts.append(None)
        node = _Node(tag, at, _mark(tag, m[4]), m[4])
        at.parts.append(node)
        nodes.append(node)
        if tag not in VOID and not m[4].endswith("/"):
            at = node
    if pos < len(page):
        at.parts.append(page[pos:])
    return root, nodes


def _composite(node: _Node, body_chars: int, body_links: int) -> float:
    """Characters per tag, damped by the share of linked characters and tags."""
    if not node.chars:
        return 0.0
    chars, tags = node.chars, max(node.tags, 1)
    link_chars, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(chars - node.link_chars, 1)
    base = math.log(chars / plain * node.link_chars + body_links / max(body_chars, 1) * chars + math.e)
    gain = math.log(max(chars / link_chars * tags / link_tags, 1.0) + 1.0) / max(math.log(base + 1.0), 0.1)
    return chars / tags * gain


def measure(nodes: list[_Node]) -> None:
    """Fill counts, densities and density sums, children before parents."""
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                n = len(part) - part.count(" ") - part.count("\n") if not part.isspace() else 0
                node.own += n
                node.chars += n
            elif part is not None:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
                node.controls += part.controls
                node.links += part.links
                node.squares += part.squares
                if part.tag in INLINE:  # inline text is the block's own text
                    node.own += part.own
                    node.own_tags += part.own_tags + 1
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
            node.links += 1
        elif node.tag in CONTROLS:
            node.controls += 1
        if node.tag not in INLINE:
            node.squares += node.own * node.own
    body = nodes[0]
    for node in nodes[1:]:
        if node.boiler == SUSPECT:
            node.boiler = MARKED if confirmed(node, body) else 0
        if not node.boiler and is_menu(node, body):
            node.boiler = MARKED
    for node in reversed(nodes):
        node.density = _composite(node, body.chars, body.link_chars)
        below = [p for p in node.parts if isinstance(p, _Node)]
        node.total = node.own / (node.own_tags + 1) + sum(p.density for p in below if p.tag not in INLINE)
        sums = [node.total if node.tag not in INLINE else 0.0]
        node.most = max(sums + [p.most for p in below])
        node.free = 0.0 if node.boiler else max(sums + [p.free for p in below])
    overrule(body)
    for node in nodes[1:]:
        node.boiler = node.parent.boiler or node.boiler
    for node in nodes:
        if not node.boiler:
            node.total -= sum(p.density for p in node.parts if isinstance(p, _Node) and p.tag not in INLINE and p.boiler)


def is_menu(node: _Node, body: _Node) -> bool:
    """Links and hardly anything else, on a page that has more unlinked text than that. A paragraph is no menu."""
    return (node.links >= MENU_LINKS and node.tag not in INLINE and node.tag != "p" and node.link_chars >= MENU_SHARE * node.chars
            and body.chars - body.link_chars > node.chars)


def confirmed(node: _Node, body: _Node) -> bool:
    """Whether a suspected block is boilerplate by its shape.

    It is if most of its text is links; if it has a button or field and little of the page's text; if it is a list of entries of one
    shape, as comments are; or if its blocks are short against the page's. Block lengths are averaged over characters (the
    length of the block that a character lies in), so a page's long paragraphs set its length, and a node that wraps them has it too.
    """
    if 2 * node.link_chars > node.chars:
        return True
    if node.controls and node.chars - node.link_chars < CONTROL_TEXT * (body.chars - body.link_chars):
        return True
    if any(map(_has_entries, [node, *(p for p in node.parts if isinstance(p, _Node) and p.tag not in INLINE)])):
        return True
    return 2 * node.squares * body.chars < body.squares * node.chars


def _has_entries(node: _Node) -> bool:
    """Whether ``ENTRIES`` blocks of one tag and class follow each other, each without a heading and with one paragraph at most."""
    shapes: dict[tuple[str, str], int] = {}
    for part in node.parts:
        if isinstance(part, _Node) and part.chars and part.tag != "p" and part.tag not in INLINE and part.tag not in HEADINGS:
            below = [q.tag for q in part.parts if isinstance(q, _Node)]
            if below.count("p") <= 1 and HEADINGS.isdisjoint(below) and len(below) > 1:
                named = next((m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(part.attrs) if m[1].lower() == "class"), "")
                shapes[part.tag, named] = shapes.get((part.tag, named), 0) + 1
    return max(shapes.values(), default=0) >= ENTRIES


def overrule(body: _Node) -> None:
    """Lift the marks of nodes that hold most of the page's unlinked text and a larger density sum than all unmarked nodes outside."""
    page, outside, at = body.chars - body.link_chars, 0.0, body
    while at is not None and at.boiler != FIRM:
        below = [p for p in at.parts if isinstance(p, _Node)]
        at = next((p for p in below if p.chars - p.link_chars > MOST_TEXT * page), None)
        outside = max([outside, *(p.free for p in below if p is not at)])
        if at is not None and at.boiler == MARKED:
            if at.most <= outside:
                return
            at.boiler = 0


def choose(nodes: list[_Node]) -> list[_Node]:
    """The article's nodes in page order, none inside another: the largest density sum of all nodes, body included, grown along
    the path to the body, and what else reaches the least density on that path."""
    body = nodes[0]
    if not body.chars:
        return []
    for node in reversed(nodes):
        node.best = node if node.tag not in INLINE and not node.boiler and node.chars else None
        for part in node.parts:
            if isinstance(part, _Node) and part.best is not None and (node.best is None or part.best.total > node.best.total):
                node.best = part.best
    up, least = body.best, body.density
    while up is not body:
        least = min(least, up.density)
        up = up.parent
    chosen: list[_Node] = []
    scopes = [(body, True)]
    while scopes:
        scope, sure = scopes.pop()
        top = scope.best
        if top is None or not sure and (max(top.total, top.density) < least or 2 * top.link_chars > top.chars):
            continue
        while top is not scope and top.parent is not body and top.parent.density >= body.density:
            top = top.parent
        chosen.append(top)
        inner = top
        while inner is not scope:  # what stands beside the path is judged on its own
            scopes += [(p, p.tag == inner.tag == "section") for p in inner.parent.parts if isinstance(p, _Node) and p is not inner]
            inner = inner.parent
    taken = {id(n) for n in chosen}
    return [n for n in nodes if id(n) in taken]


def block_text(node: _Node) -> str:
    """Text of a subtree without boilerplate: white space folded, blocks in page order joined by a space."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            if text:
                blocks.append(text)
            run.clear()

    stack: list = [iter([node])]
    while stack:  # an explicit stack: markup may nest deeper than Python recurses
        part = next(stack[-1], stack)
        if part is stack:
            stack.pop()
        elif part is None:
            run.append(" ")
        elif isinstance(part, str):
            run.append(part)
        elif part is _END:
            end()
        elif not part.boiler:
            if part.tag not in INLINE:
                end()
                stack.append(iter([_END]))
            stack.append(iter(part.parts))
    end()
    return " ".join(blocks)


_END = object()


def extract(page: str | None) -> str:
    """Main text of one whole page."""
    if not page:
        return ""
    _, nodes = parse(page)
    measure(nodes)
    return " ".join(filter(None, map(block_text, choose(nodes))))


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; a map over the scan, no shuffle."""
    rows = only(pages, "page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_extract_batches, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
