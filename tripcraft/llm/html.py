"""Main-text extraction from HTML by composite text density.

A tolerant scanner builds the tree (void elements, implied end tags, unclosed elements, raw-text elements).
For every node: C characters, T tags, LC characters inside links, LT link tags; NC = C - LC. Its composite
density is ``C / T * log(C / LC * T / LT)`` to the base ``ln(C / NC * LC + LCb / Cb * C + e)`` (b: the body), with
LC, LT, NC and T at least 1: characters per tag, lowered where links carry the text. A node's density sum
adds its children's densities. The threshold is the lowest density on the path from the node of the
largest sum up to the body. From the body down, the first node that reaches the threshold gives up its
descendant of the largest sum, and that whole subtree is the text: nothing inside is dropped for being
short. A paragraph, heading, list or inline element stands for the container it is in. If the subtree lies in article elements, the outermost is taken; if it is around a single one that holds
half of its characters, that one.

Elements that hold no article text are cut before: scripts, styles, menus, page headers and footers, sidebars,
forms, and elements whose role, class or id says so (``advert``, ``cookie``, ``comments`` ... - fixed words
below). A header inside an article with a heading stays. Wrappers are no such elements and stay, so that the
density decides: a marked element or form that holds an article or main (and is not in an article itself) or
the larger part of the body's unlinked text, and an element unwanted by its name that holds both. Articles
inside articles do not count for this; they are reader comments, and cut, where the outermost article has text of
its own beside headings (without, it is a wrapper around the article).

Text: character references decoded, white space inside a block made one space, blocks joined by a line
break in page order. Block elements and ``br``-free runs between them are blocks.

Defined results: null, empty and tag-free pages give their plain text ("" for null); repeated rows repeat.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import sliced, table

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
WRAPS = frozenset("form fieldset".split())  # unwanted by their names, but pages are put into them
INERT = frozenset("head template dialog svg math".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option
    p pre section summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - {"body", "caption", "dd", "dt", "html", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
           "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPE = frozenset("article aside body details div dl fieldset figure footer header html main nav ol section table ul".split())
HOLDS = SCOPE | frozenset("applet button dialog form math menu object select svg template".split())  # no implied end from inside
TITLES = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
CONTAINERS = frozenset("article body center div html main section td th".split())
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())
DROPPED = frozenset("""head script style noscript template iframe object embed applet svg math canvas audio video map nav aside
    footer form button select textarea input label fieldset datalist dialog menu""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
# Words of class and id names that mark what is not article text.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar
    comment comments commentlist respond disqus replies cookie cookies consent gdpr notice notices notification alert popup modal
    overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations
    pagination pager toolbar skip search""".split())
# a quote opens a value only after "="; elsewhere it is part of an attribute's name
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parent", "children", "unwanted", "inner", "outer", "holds", "plain", "post", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, unwanted: bool = False):
        self.name, self.parent, self.unwanted = name, parent, unwanted
        self.children: list[Node | str] = []


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    """``inside``: in an article or main."""
    if name in DROPPED or name == "header" and not inside:
        return True
    if not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.strip().lower() in ROLES or key == "hidden" \
                or key == "aria-hidden" and value.strip().lower() == "true":
            return True
        if key in ("class", "id") and name not in ("html", "body", "article", "main") \
                and not MARKS.isdisjoint(w.lower() for w in _NAME.findall(value)):
            return True
        if key in ("class", "id") and name == "article" and not {"comment", "comments"}.isdisjoint(
                w.lower() for w in _NAME.findall(value)):
            return True
    return False


class Open:
    """The open elements, and where those of a name are among them, so that no rule walks through deep pages."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = [root]
        self.at: dict[str, list[int]] = {}  # places by name, ascending (the root is nobody's)
        self.scope: list[int] = []
        self.holds: list[int] = [0]

    def push(self, node: Node) -> None:
        place = len(self.nodes)
        self.nodes.append(node)
        self.at.setdefault(node.name, []).append(place)
        if node.name in SCOPE:
            self.scope.append(place)
        if node.name in HOLDS:
            self.holds.append(place)

    def pop_to(self, place: int) -> None:
        """End all elements from ``place`` on."""
        while len(self.nodes) > max(place, 1):
            name = self.nodes.pop().name
            self.at[name].pop()
            if name in SCOPE:
                self.scope.pop()
            if name in HOLDS:
                self.holds.pop()

    def last(self, name: str) -> int:
        places = self.at.get(name)
        return places[-1] if places else 0

    def first_after(self, name: str, place: int) -> int | None:
        places = self.at.get(name, [])
        k = bisect.bisect_right(places, place)
        return places[k] if k < len(places) else None


def parse(page: str) -> Node:
    """The tree of wanted elements; text is in the children as decoded strings.

    Unwanted elements are parsed by the same rules, so that implied ends and the ends of their ancestors end them
    too, and are cut from the whole tree."""
    root = Node("html", None)
    stack = Open(root)
    page = page.replace("\x00", "")
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        m = None
        while lt >= 0:
            m = _TOKEN.match(page, lt)
            if m:
                break
            lt = page.find("<", lt + 1)
        text = page[at:lt if lt >= 0 else size]
        if text:
            if stack.nodes[-1].name == "head" and not text.isspace():
                stack.pop_to(len(stack.nodes) - 1)
            stack.nodes[-1].children.append(html.unescape(text))
        if lt < 0:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            place = stack.last(name)
            crossed = bool(stack.scope) and stack.scope[-1] > place
            if place and (name in BLOCK or stack.nodes[place].unwanted or not crossed):
                stack.pop_to(place)
            elif not place and name in ("p", "br") or place and name == "p":
                stack.nodes[-1].children.append(Node(name, stack.nodes[-1]))
            continue
        raw = name in RAW and not m[3].endswith("/")
        if raw:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            body, at = page[at:end.start() if end else size], end.end() if end else size
            if name not in DROPPED and name != "title":
                stack.nodes[-1].children.append(html.unescape(body))
            continue
        closed = name in VOID or m[3].endswith("/") and name not in BLOCK
        if name == "html" or name == "body" and stack.last("body"):
            continue
        if stack.nodes[-1].name == "head" and name not in IN_HEAD:
            stack.pop_to(len(stack.nodes) - 1)
        if name in ENDS_P or name in SIBLING:
            ended = [stack.first_after(e, stack.holds[-1]) for e in SIBLING.get(name, ("p",))]
            ended = [e for e in ended if e is not None]
            if ended:
                stack.pop_to(min(ended))
        parent = stack.nodes[-1]
        child = Node(name, parent, _unwanted(name, m[3], bool(stack.last("article") or stack.last("main"))))
        parent.children.append(child)
        if not closed:
            stack.push(child)
    _cut(root)
    return root


def _cut(root: Node) -> None:
    """Leaves the unwanted subtrees out, unless they are wrappers."""
    nodes = _nodes(root)
    body = next((n for n in nodes if n.name == "body"), root)
    for n in nodes:  # inner: in an article
        n.inner = n.parent is not None and (n.parent.inner or n.parent.name == "article" and not n.parent.unwanted)
    for n in reversed(nodes):
        n.holds, n.plain, n.post = n.name in ("article", "main") and not n.unwanted, 0, 0
        if n.name in INERT or n.name == "a" or n.name == "article" and n.inner:
            continue
        for c in n.children:
            if isinstance(c, str):
                size = len(_SPACE.sub(" ", c).strip())
                n.plain += size
                n.post += size
            else:
                n.plain += c.plain
                n.post += c.post
                n.holds = n.holds or c.holds
        if _unwanted_name(n) and not n.holds:
            n.plain = 0
        if n.name in TITLES or n.unwanted:
            n.post = 0
        n.holds = n.holds and n.plain > 0
    for n in nodes:
        if n.unwanted:
            larger, holds = 2 * n.plain > body.plain, n.holds and not n.inner
            n.unwanted = not (larger and holds if _unwanted_name(n) else larger or holds)
    for n in nodes:  # outer: the outermost article; inner: an article beside text of that one, other than headings
        n.outer = (n.parent.outer if n.parent is not None else None) or (n if n.name == "article" and not n.unwanted else None)
        n.unwanted = n.unwanted or n.name == "article" and n.outer is not n and n.outer is not None and n.outer.post > 0
    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or not c.unwanted]


def _unwanted_name(n: Node) -> bool:
    return n.unwanted and (n.name == "header" or n.name in DROPPED and n.name not in WRAPS)


def _path(node: Node) -> Iterator[Node]:
    up: Node | None = node
    while up is not None:
        yield up
        up = up.parent


def _nodes(root: Node) -> list[Node]:
    """All elements, parents first (no recursion: trees may be deep)."""
    out = [root]
    for n in out:
        out.extend(c for c in n.children if isinstance(c, Node))
    return out


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all nodes; parents first."""
    nodes = _nodes(root)
    for n in reversed(nodes):
        n.chars = sum(len(_SPACE.sub(" ", c).strip()) for c in n.children if isinstance(c, str))
        n.tags = n.link_chars = n.link_tags = 0
        for c in n.children:
            if isinstance(c, Node):
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags + (c.name == "a")
        if n.name == "a":
            n.link_chars = n.chars
    share = root.link_chars / max(root.chars, 1)
    for n in nodes:
        n.density = 0.0
        if n.chars:
            plain, linked = max(n.chars - n.link_chars, 1), max(n.link_chars, 1)
            base = math.log(n.chars / plain * n.link_chars + share * n.chars + math.e)
            n.density = n.chars / max(n.tags, 1) * max(
                math.log(n.chars / linked * max(n.tags, 1) / max(n.link_tags, 1)) / base, 0.0) \
                if base > 1e-9 else 0.0
    for n in nodes:
        n.total = sum(c.density for c in n.children if isinstance(c, Node))
    return nodes


def select(root: Node) -> Node:
    """The subtree that holds the text."""
    nodes = measure(root)
    body = next((n for n in nodes if n.name == "body"), root)
    best = max(_nodes(body), key=lambda n: n.total)  # the first in page order among equals
    path = list(_path(best))
    threshold = min(n.density for n in path[:path.index(body) + 1])
    level = [body]
    while level:
        reach = [n for n in level if n.density >= threshold]
        if reach:
            best = max((m for n in reach for m in _nodes(n)), key=lambda n: n.total)
            break
        level = [c for n in level for c in n.children if isinstance(c, Node)]
    while best.name not in CONTAINERS and best is not body:  # a paragraph or list stands for what it is in
        best = best.parent
    within = [n for n in _path(best) if n.name == "article"]
    if within:
        return within[-1]  # the outermost
    articles = [n for n in _nodes(best) if n.name == "article" and n.chars]
    return articles[0] if len(articles) == 1 and 2 * articles[0].chars >= best.chars else best


def text_of(root: Node) -> str:
    """The blocks of a subtree, one per line."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        line = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if line:
            blocks.append(line)

    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.name == "br":
            run.append(" ")
        else:
            if x.name in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(x.children))
    flush()
    return "\n".join(blocks)


def extract(page: str | None) -> str:
    """Main text of one page."""
    return text_of(select(parse(page))) if page else ""


def main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` as a column ``row`` plus ``text`` and ``n_chars``."""
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != page)).alias("row"), F.col(page).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "h", 200):
            texts = [extract(h) for h in b.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["row", "text", "n_chars"])

    return rows.mapInArrow(run, rows.select("row", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", "n_chars")
