"""Main text of web pages by composite text density.

The page becomes a tree of elements. For every node the characters and tags below it are counted, and those inside links;
its density is characters per tag, adjusted by how much of the text is link text and by the page's own ratio. A node's
density sum adds the densities of its children. The node with the largest sum marks the body: the smallest density on
its path to the root is the threshold, and the subtrees beside the path that are as dense are main text as well, in page order.
Where the body lies in an article or main element, the path ends there: what is beside it stays out, but for articles of like
density, and divisions inside that do not reach the threshold go.
Elements that carry no text of their own by their kind or name (menus, forms, notices, comments, ...) are left out of
the tree before the counts, and so are the subtrees of the main node that hold mostly link text. A form, and an element left
out for its name only, stays if it holds most of the page's text outside links; its controls go.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from aisleframe.llm.hashing import chunked

# Names fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption html legend optgroup option td th tr tbody thead tfoot".split())
ENDS_WITH_NEXT = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "tbody": frozenset(["tbody", "thead", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "thead", "tr", "td", "th"])}
SCOPES = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
# Elements that are never part of an article.
LEFT_OUT = RAW | frozenset(
    "nav aside footer form button select option input label fieldset dialog object applet canvas audio video head menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar alert".split())
# Words of class and id names that say the same.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar\w*|header|footer|masthead|"
    r"cookies?\w*|consent\w*|gdpr|notices?|popup\w*|modal\w*|newsletter\w*|subscribe\w*|subscription|signup|login|comments?\w*|"
    r"disqus\w*|respond|repl(?:y|ies)|share\w*|social\w*|related\w*|recommend\w*|widgets?\w*|pagination|pager|toolbar|"
    r"skip-?links?|copyright|legal|disclaimer|tags?(?![_-])|teasers?)(?:$|[\s_-])", re.I)
# Words that say what a page or article has or is about, as in class="with-sidebar" or "category-menus".
_STATE = re.compile(r"(?:^|(?<=\s))(?:with|without|has|have|no|not|is|hide|show|tag|category|cat|type|format|status)[_-]\S*", re.I)
# Names of elements that are never the article, whatever they hold.
_NEVER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|cookies?\w*|consent\w*|gdpr|comments?\w*|disqus\w*|respond|repl(?:y|ies))(?:$|[\s_-])", re.I)
# Kinds of elements that may be wrapped around a whole page.
_WRAPPERS = frozenset("form fieldset".split())

HEADINGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
DIVISIONS = frozenset("div section".split())
SHORTER = 8  # so many times less text per tag has a block of paragraphs that still belongs to the body

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
# The title's own division, as in class="entry-header", is no page header.
_TITLE = re.compile(r"\b(?:article|entry|post|story|content|title|section)[_-]+header|\bheader[_-]+title", re.I)
_SPACE = re.compile(r"[ \t\n\f\r\v]+")


class Node:
    __slots__ = ("name", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _unwanted(name: str, attributes: str) -> int:
    """0 for an element that may hold an article, 2 for one that can't, 1 for one that does only if it holds most of the page."""
    if name in LEFT_OUT and name not in _WRAPPERS:
        return 2
    found = int(name in _WRAPPERS)
    if not attributes or name in ("html", "body", "article", "main"):
        return found
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            named = _STATE.sub(" ", _TITLE.sub(" ", value))
            if NAMES.search(named):
                found = max(found, 2 if _NEVER.search(named) else 1)
        if key == "role" and value.lower() in ROLES:
            found = max(found, 1 if value.lower() == "form" else 2)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 2
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return 2
    return found


class Skipped:
    """The open elements inside an unwanted one, and the text outside links and inner elements that can't hold an article."""

    def __init__(self):
        self.open: list[tuple[str, int, int, int]] = []  # name, kind, position in the page, `chars` at the start
        self.closed = self.chars = 0  # links and elements of kind 2 that are open; characters
        self.sizes: list[tuple[int, int]] = []  # position and characters of elements of kind 1
        self.names: Counter[str] = Counter()  # of the open elements

    def push(self, name: str, kind: int, at: int) -> None:
        self.open.append((name, kind, at, self.chars))
        self.names[name] += 1
        self.closed += kind == 2 or name == "a"

    def pop(self, to: int) -> None:
        while len(self.open) > to:
            name, kind, at, before = self.open.pop()
            self.names[name] -= 1
            self.closed -= kind == 2 or name == "a"
            if kind == 1:
                self.sizes.append((at, self.chars - before))

    def text(self, text: str) -> None:
        if not self.closed:
            self.chars += len("".join(html.unescape(text).split()))

    def last(self, name: str) -> int:
        if not self.names[name]:
            return -1
        return next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == name), -1)


def parse(page: str, stay: frozenset[int] = frozenset()) -> tuple[Node, Skipped]:
    """The element tree without unwanted elements, but for those at the positions `stay`, and what was skipped; unclosed and stray
    tags are mended as the HTML standard does for common cases. Names of open elements are counted, so that a stray tag does not look
    through all of them."""
    root = node = Node("html", None)
    names: Counter[str] = Counter()
    skip = Skipped()
    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token.group(2)
        if name is None:
            text = token.group()
            if not (text.startswith("<") and len(text) > 1):
                if skip.open:
                    skip.text(text)
                else:
                    node.children.append(html.unescape(text))
            continue
        name = name.lower()
        if token.group(1):
            if skip.open:
                inside = skip.last(name)
                if inside >= 0:
                    skip.pop(inside)
                elif name in ("article", "main", "body", "html"):
                    skip.pop(0)  # an unclosed unwanted element ends with what it stands in
                if skip.open or name not in ("article", "main", "body", "html"):
                    continue
            if names[name]:
                node = _closed(node, name, names)
            elif name == "br":
                node.children.append("\n")
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(page, at)
            if not token.group(3).rstrip().endswith("/") or name not in ("svg", "math"):
                at = close.end() if close else end
            continue
        if skip.open:
            if name not in VOID:
                if name in ("p", "li") and skip.open[-1][0] == name:
                    continue
                skip.push(name, _unwanted(name, token.group(3)), token.start())
            continue
        if name in CLOSES_P or name in ENDS_WITH_NEXT:
            node = _close_implied(node, name, names)
        kind = _unwanted(name, token.group(3))
        if kind == 2 or kind and token.start() not in stay:
            if name not in VOID:
                skip.push(name, kind, token.start())
            continue
        if name in ("html", "body", "head"):
            continue
        child = Node(name, node)
        node.children.append(child)
        if name not in VOID and not (token.group(3).endswith("/") and name not in BLOCKS):
            node = child
            names[name] += 1
    skip.pop(0)
    return root, skip


def _closed(node: Node, name: str, names: Counter[str]) -> Node:
    """The node around the innermost open element of this name; it and all inside it are open no more."""
    while True:
        names[node.name] -= 1
        if node.name == name:
            return node.parent
        node = node.parent


def _close_implied(node: Node, name: str, names: Counter[str]) -> Node:
    """The node that an element of this name is put into: an open paragraph, item or cell ends before it."""
    ends, scope = ENDS_WITH_NEXT.get(name, frozenset()), SCOPES.get(name, frozenset(["table"]))
    up, found = node, None
    left = sum(names[n] for n in ends) + (names["p"] if name in CLOSES_P and "p" not in ends else 0)
    while up.parent is not None and left:
        if up.name == "p" and name in CLOSES_P or up.name in ends:
            found = up
            left -= 1
        if up.name in scope and ends or up.name in ("table", "td", "th", "article", "section", "div", "blockquote") and up.name not in ends:
            break
        up = up.parent
    if not found:
        return node
    while node is not found.parent:
        names[node.name] -= 1
        node = node.parent
    return node


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return nodes


def _weigh(nodes: list[Node]) -> None:
    """Counts, composite densities and density sums of the nodes (parents first)."""
    inside = {}
    for node in nodes:
        inside[node] = node.name == "a" or node.parent is not None and inside.get(node.parent, False)
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if inside[node]:
            node.link_chars += own
        if node.parent is not None and node.parent in inside:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.name == "a")
    whole = nodes[0]
    ratio = whole.link_chars / max(whole.chars, 1)
    for node in nodes:
        if node.chars:
            c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
            plain = max(c - node.link_chars, 1)
            base = math.log(c / plain * node.link_chars + ratio * c + math.e)
            node.density = c / t * max(math.log(c / lc * t / lt + 1.0), 1e-6) / math.log(base + 1.0)
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))


def _main(nodes: list[Node]) -> tuple[Node, dict[Node, list[Node | str]]]:
    """The node that holds the main text, and what of their children belongs to it for nodes of which not all does."""
    articles = [n for n in nodes if n.name in ("article", "main")]
    body = best = max(nodes, key=lambda n: n.total)
    # a paragraph's inline tags are dense too: the body is the smallest sectioning element around the best node
    while body.parent is not None and (body.name not in BLOCKS or body.name in ("p", "li", "ul", "ol", "blockquote", "pre", "tr", "table", "tbody")):
        body = body.parent
    around = body
    while around is not None and around.name not in ("article", "main"):
        around = around.parent
    if around is not None:
        whole, shown = _inside(around, body, best)
        beside = [a for a in articles if around.name == "article" and a.parent is around.parent and (a is around or _as_long(a, around))]
        if len(beside) < 2:
            return whole, shown
        return around.parent, {**shown, around.parent: beside}
    inner = [a for a in articles if _within(a, body)]
    if inner:
        largest = max(inner, key=lambda n: n.chars)
        beside = [a for a in inner if a is largest or a.parent is largest.parent and _as_long(a, largest)]
        if sum(a.chars for a in beside) * 2 > body.chars:
            return (largest, {}) if len(beside) < 2 else (largest.parent, {largest.parent: beside})
    path = [body]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    density, per_tag = min(n.density for n in (best, *path)), min(map(_per_tag, path))
    shown: dict[Node, list[Node | str]] = {}
    top = 0
    while True:
        # headings and paragraphs beside the body belong to it
        while top + 1 < len(path) and any(
                isinstance(c, Node) and c is not path[top] and c.chars > c.link_chars and c.name in HEADINGS for c in path[top + 1].children):
            top += 1
        # so do dense subtrees beside its path, and what stands between them
        for up in range(top + 1, len(path)):
            children = path[up].children
            ours = [k for k, c in enumerate(children) if isinstance(c, Node) and (
                c is path[up - 1] or _mostly_plain(c) and (c.name in HEADINGS or _as_dense(c, density, per_tag)))]
            if any(c.name not in HEADINGS for k in ours if (c := children[k]) is not path[up - 1]):
                break
        else:
            return path[top], shown
        for k in range(top + 1, up):
            shown[path[k]] = [path[k - 1]]
        shown[path[up]] = [
            c for k, c in enumerate(children) if ours[0] <= k <= ours[-1] and (k in ours or isinstance(c, str) or _mostly_plain(c))]
        top = up


def _inside(around: Node, body: Node, best: Node) -> tuple[Node, dict[Node, list[Node | str]]]:
    """The element that bounds the main text, without the divisions beside the body's path that are not as dense as the path.

    A division of paragraphs or headings may have shorter ones; where the body has neither, divisions are its paragraphs."""
    if not _paragraphs(body):
        return around, {}
    path = [body]
    while path[-1] is not around:
        path.append(path[-1].parent)
    density, per_tag = min(n.density for n in (best, *path)), min(map(_per_tag, path))
    stays = lambda c: isinstance(c, str) or c.name not in DIVISIONS or _mostly_plain(c) and (
        _as_dense(c, density, per_tag) or _paragraphs(c) > 0 and _per_tag(c) * SHORTER >= per_tag)
    return around, {up: [c for c in up.children if c is on or stays(c)] for on, up in zip(path, path[1:], strict=False)}


def _paragraphs(node: Node) -> int:
    return sum(n.name in HEADINGS and _mostly_plain(n) for n in _order(node))


def _as_long(article: Node, largest: Node) -> bool:
    """Whether an article beside the largest is another part of the text: its paragraphs are at least half as long."""
    return _mostly_plain(article) and _paragraphs(article) > 1 and _per_tag(article) * 2 >= _per_tag(largest)


def _per_tag(node: Node) -> float:
    return (node.chars - node.link_chars) / max(node.tags, 1)


def _mostly_plain(node: Node) -> bool:
    return node.chars > 2 * node.link_chars


def _as_dense(node: Node, density: float, per_tag: float) -> bool:
    """Whether a block reaches the path's least density, or the least text per tag, as densities of text without links grow with its
    size; a block of several paragraphs or headings may have short ones."""
    if node.name not in BLOCKS:
        return False
    if node.density >= density or _per_tag(node) >= per_tag:
        return True
    return _per_tag(node) * SHORTER >= per_tag and _paragraphs(node) > 1


def _within(node: Node | None, of: Node) -> bool:
    while node is not None:
        if node is of:
            return True
        node = node.parent
    return False


def _blocks(main: Node, shown: dict[Node, list[Node | str]]) -> str:
    lines: list[str] = []
    part: list[str] = []

    def end() -> None:
        line = _SPACE.sub(" ", "".join(part)).strip(" ")
        if line:
            lines.append(line)
        part.clear()

    todo: list[Node | str | None] = [main]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            part.append(item)
        elif item is not main and item.chars > 0 and item.name in ("ul", "ol", "div", "section", "table", "p") \
                and item.link_chars * 10 >= item.chars * 9 and item.link_tags >= 3:
            end()  # a list of links
        else:
            block = item.name in BLOCKS
            if block:
                end()
                todo.append(None)
            if item.name == "br":
                part.append(" ")
            todo += reversed(shown.get(item, item.children))
    end()
    return "\n".join(lines)


def main_text(page: str) -> str:
    """The main text of one page: blocks in page order, one line each; empty for a page without text."""
    if not page:
        return ""
    root, skip = parse(page)
    nodes = _order(root)
    _weigh(nodes)
    whole = root.chars - root.link_chars + skip.chars
    stay = frozenset(at for at, chars in skip.sizes if chars * 2 > whole)
    if stay:
        nodes = _order(parse(page, stay)[0])
        _weigh(nodes)
    if not nodes[0].chars:
        return ""
    return _blocks(*_main(nodes))


def _extract(names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pages in chunked(batches, "html"):
            texts = [main_text(p.decode(errors="replace")) for p in pages]
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(n) if n in made else part.column(n) for n in names], names=names)
    return run


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of pages (page_id, url, html).

    Whole pages are read, whatever their length. Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one line feed. A null or empty page, and one without text outside menus and the like, has the
    empty text. Rows that repeat give equal rows; null ids and urls stay null. Other columns of pages are not looked at.
    """
    types = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}
    names = [*types, "text", "n_chars"]
    schema = ", ".join(f"`{n}` {t}" for n, t in {**types, "text": "string", "n_chars": "bigint"}.items())
    return pages.select("page_id", "url", "html").mapInArrow(_extract(names), schema)
