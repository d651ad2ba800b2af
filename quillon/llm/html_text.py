"""Main text of web pages by composite text density.

A small tree builder reads the page. Parts that are boilerplate by their element
are cut off; those that a class, id or role speaks against are cut off unless
nearly all of the page's text stands in them. For each node that is left, its
density is characters per tag, adjusted by how much of its text stands in links.
The node whose children's densities sum highest is the main subtree; the least
density on the path from it up to the body is the threshold that other parts of
the page must reach to be main text too. Blocks that are hardly more than links
are left out wherever they stand.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul caption".split()
)
CUT = frozenset("head script style noscript iframe template textarea title nav footer button select option input label fieldset dialog menu svg canvas audio video object embed map math xmp noembed noframes search".split())
#: Elements that are cut unless nearly all text stands in them.
SUSPECT = frozenset("aside form header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold a run of text; an element around them is the main subtree, not one of them.
TEXTUAL = HEADINGS | frozenset("p pre li dt dd figcaption caption legend address summary".split())
#: A start tag of the key ends an open element of the value, unless a container stands between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article section div main".split())
#: Elements that an end tag of a text element doesn't reach out of.
CELLS = frozenset("td th li table body".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# What a class or id that marks boilerplate ends in, what may still follow it, and what turns it round.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsors sponsored promo promos promotion banner banners sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar header cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe signup login comment comments commentlist disqus respond replies reply discussion share sharing social related recommended recommendations widget widgets pagination pager skip hidden".split()
)
AFTER_MARK = frozenset("container wrapper wrap box block section area region list bar link links button buttons inner outer content item items group panel slot unit left right top bottom main primary secondary global row col column thread form posts articles stories icons message text".split())
TURNED = frozenset("no not non has have with without is hide show".split())
COMMENTS = re.compile(r"(?:\d+\s+)?(?:(?:reader |user )?comments?|responses|discussion|leave a (?:reply|comment)|kommentare?|commentaires?|comentarios?)(?:\s*\(?\d*\)?)?:?", re.I)
COPYRIGHT = re.compile(r"(?:copyright\s*)?(?:©|\(c\)|copyright)\s*\d{4}\b.{0,150}", re.I)
#: Links of a block without much else, and the share of their text (in tenths), from which on it is left out.
LINKS, LINK_TENTHS = 3, 7
TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|$)"
    r"|<[!?][^>]*+(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in RAW}


class Node:
    """An element: parts are its texts and elements in page order."""

    __slots__ = ("chars", "cut", "density", "holds", "kids_sum", "link_chars", "link_tags", "name", "parent", "parts", "suspect", "tags")

    def __init__(self, name: str, parent: Node | None, cut: bool = False, suspect: bool = False) -> None:
        self.name, self.parent, self.cut, self.suspect = name, parent, cut, suspect
        self.parts: list[str | Node] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.kids_sum = 0.0
        self.holds = name in ("article", "main")


def _marks(value: str, inside: bool) -> bool:
    """Whether a class or id speaks against a part: its last word does, bar numbers and words for boxes and places."""
    for token in CAMEL.sub("-", value).lower().split():
        words = [w for w in re.split(r"[-_:]+|\d+", token) if w]
        if not words or words[0] in TURNED:
            continue
        while len(words) > 1 and words[-1] in AFTER_MARK:
            words.pop()
        if words[-1] in MARKS and not (inside and words[-1] == "header" and words[0] not in ("site", "page", "top")):
            return True
    return False


def _is_marked(attributes: str, name: str, inside: bool) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id") and name not in ("article", "main") and _marks(value, inside):
            return True
    return False


class _Open:
    """The elements that are open, so that a tag finds those that it ends without going up through all."""

    def __init__(self, root: Node) -> None:
        self.stack = [root]
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.cells: list[int] = []
        self.articles = 0

    def push(self, node: Node) -> None:
        k = len(self.stack)
        self.stack.append(node)
        self.at[node.name].append(k)
        for names, places in ((BLOCK, self.blocks), (SCOPE, self.scopes), (CELLS, self.cells)):
            if node.name in names:
                places.append(k)
        self.articles += node.name in ("article", "main")

    def pop_to(self, k: int) -> None:
        """Ends the element at k and all above it."""
        while len(self.stack) > k:
            node = self.stack.pop()
            self.at[node.name].pop()
            for names, places in ((BLOCK, self.blocks), (SCOPE, self.scopes), (CELLS, self.cells)):
                if node.name in names:
                    places.pop()
            self.articles -= node.name in ("article", "main")

    def end(self, name: str) -> None:
        """An end tag; those of text elements don't reach out of a cell or list item."""
        places = self.at.get(name)
        if places and (name in BLOCK or not self.cells or self.cells[-1] < places[-1]):
            self.pop_to(places[-1])

    def make_room(self, name: str) -> None:
        """A block ends the paragraph that it stands in; rows, cells and items end those before them, up to their table or list."""
        if self.blocks and self.stack[self.blocks[-1]].name == "p":
            self.pop_to(self.blocks[-1])
        scope = self.scopes[-1] if self.scopes else 0
        ended = [places[i] for x in ENDS.get(name, ()) if (i := bisect_right(places := self.at[x], scope)) < len(places)]
        if ended:
            self.pop_to(min(ended))


def parse(page: str) -> Node:
    """The tree of a page. Elements that a browser would end by what follows are ended; ends without a start are left out.

    Character references are decoded in each run of text by itself.
    """
    root = Node("#root", None)
    open_ = _Open(root)
    at, n = 0, len(page)

    def text(run: str) -> None:
        open_.stack[-1].parts.append(html.unescape(run) if "&" in run else run)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        m = TOKEN.match(page, lt)
        if not m:
            text("<")
            at = lt + 1
            continue
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            open_.end(name)
            continue
        attributes = m[3] or m[6] or ""
        if name in BLOCK:
            open_.make_room(name)
        inside = open_.articles > 0
        here = open_.stack[-1]
        suspect = name not in ("html", "body") and (name in SUSPECT and not (name == "header" and inside) or bool(attributes) and _is_marked(attributes, name, inside))
        node = Node(name, here, name in CUT, suspect)
        here.parts.append(node)
        if name in RAW:
            close = RAW_END[name].search(page, at)
            at = close.start() if close else n
        if name not in VOID and not (attributes.rstrip().endswith("/") and name not in BLOCK):
            open_.push(node)
    return root


def _ordered(root: Node) -> list[Node]:
    """Nodes that aren't cut, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.cut)
    return order


def _count(order: list[Node]) -> None:
    """Characters, tags and links of every node, bottom up."""
    for node in order:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
    for node in reversed(order):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len("".join(part.split()))
            elif not part.cut:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.chars if part.name == "a" else part.link_chars
                node.link_tags += part.link_tags + (part.name == "a")
                node.holds = node.holds or part.holds


def _cut_off(root: Node) -> list[Node]:
    """Cuts suspect parts, but for those that hold the article's element or nearly all text. Returns the nodes that are left."""
    order = _ordered(root)
    _count(order)
    if any(x.suspect for x in order):
        stack, outermost = [root], []
        while stack:
            node = stack.pop()
            if node.suspect and not node.holds:
                outermost.append(node)
            else:
                stack.extend(p for p in node.parts if isinstance(p, Node) and not p.cut)
        outside = root.chars - sum(x.chars for x in outermost)
        for x in outermost:
            x.cut = not (x.chars > 10 * outside and x.link_chars * 2 <= x.chars and all(y is x or y.chars <= x.chars for y in outermost))
        kept = [x for x in outermost if not x.cut]
        for x in kept:  # what is suspect within is cut
            for y in _ordered(x)[1:]:
                y.cut = y.suspect and not y.holds and y.chars * 2 < x.chars
        order = _ordered(root)
        _count(order)
    return order


def _measure(root: Node) -> tuple[Node, Node]:
    """The body (the root if there is none) and the main subtree."""
    order = _cut_off(root)
    body = next((x for x in reversed(order) if x.name == "body"), root)
    for node in order:
        for part in node.parts:
            if isinstance(part, Node) and not part.cut and _only_links(part) and part.chars <= 10 * (body.chars - part.chars):
                part.cut = True
            elif isinstance(part, Node) and part.name in HEADINGS and part.name != "h1" and COMMENTS.fullmatch(" ".join(_text(part).split())):
                rest = node.parts[node.parts.index(part) :]
                if sum(x.chars for x in rest if isinstance(x, Node) and not x.cut) < body.chars - sum(x.chars for x in rest if isinstance(x, Node)):
                    for x in rest:
                        if isinstance(x, Node):
                            x.cut = True
                    node.parts[node.parts.index(part) :] = [x for x in rest if isinstance(x, Node)]
                break
    order = _ordered(root)
    _count(order)
    c, lc = max(1, body.chars), body.link_chars
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, lc / c)
    for node in order:
        node.kids_sum = sum(p.density for p in node.parts if isinstance(p, Node) and not p.cut)
    # Of equal sums the outermost wins.
    best = max((x for x in order if x is body or x.name in BLOCK and x.name not in TEXTUAL), key=lambda x: x.kids_sum)
    return body, best if best.kids_sum > 0 else body


def _only_links(node: Node) -> bool:
    """A block or list of several links with little text beside them."""
    return node.name in BLOCK and node.name not in TEXTUAL and node.link_tags >= LINKS and node.link_chars * 10 >= node.chars * LINK_TENTHS


def _text(node: Node) -> str:
    """The text of a short part."""
    out: list[str] = []
    stack: list[str | Node] = [node] if node.chars < 60 else []
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.cut:
            stack.extend(reversed(part.parts))
    return "".join(out)


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_ratio: float) -> float:
    """Composite text density: characters per tag, scaled by a logarithm whose base grows with the share of links."""
    if not chars:
        return 0.0
    t, lc, lt = max(1, tags), max(1, link_chars), max(1, link_tags)
    plain = max(1, chars - link_chars)
    base = math.log(chars / plain * link_chars + page_ratio * chars + math.e)
    return chars / t * math.log(max(1.0 + 1e-9, chars / lc * t / lt)) / math.log(max(base, 1.0 + 1e-9))


def main_text(page: str | None) -> str:
    """The main text: blocks in page order, each on a line. Null, empty or textless pages give the empty string."""
    if not page:
        return ""
    root = parse(page.replace("\x00", ""))
    body, best = _measure(root)
    path = {id(best)}
    threshold = best.density
    up = best
    while up is not body and up.parent is not None:
        up = up.parent
        path.add(id(up))
        threshold = min(threshold, up.density)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    # (node, whole): whole nodes give all their text; on the path to the main subtree, parts are looked at one by one.
    stack: list[tuple[object, bool]] = [(body, body is best)]
    while stack:
        node, whole = stack.pop()
        if isinstance(node, str):
            if node == "\n":
                flush()
            else:
                line.append(node[1:])
            continue
        parts: list[tuple[object, bool]] = []
        block = node.name in BLOCK
        if block:
            parts.append(("\n", whole))
        if node.name == "br":
            parts.append(("t ", whole))
        for part in node.parts:
            if isinstance(part, str):
                parts.append(("t" + part, whole))
            elif part.cut:
                parts.append(("\n", whole) if part.name in BLOCK else ("t ", whole) if part.name in ("script", "style") else ("t", whole))
            elif whole or part is best:
                parts.append((part, True))
            elif id(part) in path:
                parts.append((part, False))
            elif part.density >= threshold and part.link_chars * 2 <= part.chars or part.name in HEADINGS and part.link_chars * 2 <= part.chars or part.name not in BLOCK and part.chars and part.link_chars * 2 <= part.chars:
                parts.append((part, True))
        if block:
            parts.append(("\n", whole))
        stack.extend(reversed(parts))
    flush()
    if len(blocks) > 1 and COPYRIGHT.fullmatch(blocks[-1]):
        blocks.pop()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """For each row of pages: page_id, url, text and n_chars (its code points).

    pages needs page_id, url and html; other columns are ignored. A null page
    gives an empty text; repeated rows give repeated rows; an empty table gives
    none. Every page is read whole, one at a time.
    """
    kept = pages.select("page_id", "url", "html")
    id_type = kept.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return kept.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long").select("page_id", "url", F.col("text"), "n_chars")
