"""HTML extraction by composite text density.

A page is parsed into a tree (unclosed and stray tags are tolerated, raw text of scripts and styles is skipped, character
references are decoded). Parts that are never article text are taken out by their element or role: menus, headers, footers,
side bars, dialogs. A class or id (adverts, notices, side bars, comments of readers) and a form only raise a doubt, since
wrappers of the whole page bear such names too: see ``prune``. For every node left, with C characters, T tags, LC
characters and LT tags inside links (NC = C - LC), and LB / CB link and all characters of the body, the composite density is

    C / T * log(C / LC * T / LT) to the base ln(C / NC * LC + LB / CB * C + e)

(T, LC, LT, NC at least 1), and its density sum is the densities of its children plus its own characters. Formatting
elements belong to the text of their block and are no nodes. The threshold is the smallest density on the path from the
node with the largest density sum up to the body. From the body downwards, in each subtree at or above the threshold the
node with the largest density sum is content. The article is the smallest subtree that holds all content nodes, so
headings and short paragraphs in between stay; lists of links in it that are below the threshold go.

Text: white space inside a block becomes one space, blocks are joined in page order by one space.

Defined cases: null and empty pages, and pages without text, give an empty text; a page cut anywhere is read as far as it
goes (an unfinished tag, comment or script is dropped); depth does not matter (no recursion); repeated rows are answered
each.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.llm.staging import prepare

# Element names by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = set("html body table td th ul ol dl div article section main aside nav header footer form select".split())
NEVER = set(
    "head nav header footer aside script style noscript template button select textarea input iframe svg canvas "
    "object embed dialog menu title".split()
)
NEVER_ROLES = set("navigation banner contentinfo complementary search menu menubar alert alertdialog dialog".split())
NEVER_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation "
    "navigations menu menus submenu breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars widget widgets "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus replies respond "
    "pagination pager toolbar skip".split()
)

# Of these names, those that say what the text is, not where it stands.
OTHER_TEXT = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr "
    "newsletter subscribe signup login share sharing social related recommended recommendations comment comments commentlist "
    "disqus replies respond".split()
)
LANDMARKS = {"article": 1, "main": 2, "h1": 2}
ABOUT_PAGE = set("no has with without not hide is".split())

# Doubts about an element, by strength.
WEAK, STRONG, OTHER = 1, 2, 3

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|--!>|\Z)|<[!?](?P<other>[^>]*)(?:>|\Z)|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>\x00]*)"
    # A quote opens a value only behind an equals sign.
    r"(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?P<done>>|\Z)|(?P<stray></[^a-zA-Z][^>]*(?:>|\Z))", re.S,
)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PART = re.compile(r"[a-z]+")


class Node:
    """An element: own pieces are strings and child nodes in page order."""

    __slots__ = ("name", "parent", "pieces", "inline", "chars", "tags", "link_chars", "link_tags", "own", "density", "sum",
                 "doubt", "marked", "gone")

    def __init__(self, name: str, parent: Node | None, inline: bool = False) -> None:
        self.name, self.parent, self.inline = name, parent, inline
        self.pieces: list[str | Node] = []
        self.doubt, self.gone = 0, False


def _unwanted(name: str, attrs: str) -> tuple[bool, int]:
    """Whether an element is never article text, and the doubt that its name raises."""
    if name in NEVER:
        return True, 0
    doubt = WEAK if name == "form" else 0
    for kind, a, b, c in _ATTR.findall(attrs):
        value = html.unescape(a or b or c).lower()
        if kind.lower() == "role":
            if value.strip() in NEVER_ROLES:
                return True, 0
            if value.strip() == "form":
                doubt = max(doubt, WEAK)
        elif name not in ("html", "body", "article", "main"):
            for parts in map(_NAME_PART.findall, value.split()):
                # "no-sidebar" or "content-with-comments": what follows says something about the page, not about this element.
                own = set(itertools.takewhile(lambda part: part not in ABOUT_PAGE, parts))
                if own & NEVER_NAMES:
                    doubt = max(doubt, WEAK if own - NEVER_NAMES else OTHER if own & OTHER_TEXT else STRONG)
    return False, doubt


def parse(page: str) -> Node:
    """The tree of a page without the elements that are never article text."""
    root = Node("html", None)
    at, skip, stack = root, None, [root]  # skip: the stack depth at which an unwanted element began
    position, size = 0, len(page)

    def text(piece: str) -> None:
        if piece and skip is None:
            at.pieces.append(html.unescape(piece))

    while position < size:
        start = page.find("<", position)
        if start < 0:
            text(page[position:])
            break
        found = _TOKEN.match(page, start)
        if found is None:
            text(page[position:start + 1] if page[start + 1:start + 2] else page[position:start])
            position = start + 1
            continue
        text(page[position:start])
        position = found.end()
        name = found["name"]
        if name is None:
            continue
        if not found["done"]:
            break
        name = name.lower()
        if found["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].name in SCOPES or stack[depth].name in ("td", "th") and name not in (
                        "td", "th", "tr", "table", "tbody", "thead", "tfoot", "body", "html"):
                    break
            else:
                if name == "p":
                    text("\n")
            if skip is not None and len(stack) <= skip:
                skip = None
            at = stack[-1]
            continue
        closes = {"p"} if name in CLOSES_P else SIBLINGS.get(name)
        if closes:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in closes:
                    del stack[depth:]
                    if closes != {"p"} and depth > 1 and stack[-1].name in closes:
                        continue
                    break
                if stack[depth].name in SCOPES and stack[depth].name not in closes:
                    break
            if skip is not None and len(stack) <= skip:
                skip = None
            at = stack[-1]
        if name in ("html", "body") and skip is None:
            continue
        if name in VOID:
            if name in ("br", "hr") and skip is None:
                at.pieces.append(Node(name, at))
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*/?>", re.I).search(page, position)
            position = end.end() if end else size
            continue
        if name == "body":
            del stack[1:]
            at, skip = root, None
            continue
        node = Node(name, at, name in INLINE)
        if skip is None:
            never, node.doubt = _unwanted(name, found["attrs"])
            if never:
                skip = len(stack)
            else:
                at.pieces.append(node)
        stack.append(node)
        at = node
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in reversed(node.pieces) if isinstance(p, Node))
    return order


def _doubted(node: Node, inside: bool) -> list[tuple[Node, bool]]:
    """The outermost doubted nodes without a landmark below a node, and whether an article or main is around them."""
    out, todo = [], [(node, inside)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.name in ("article", "main")
        for p in node.pieces:
            if isinstance(p, Node):
                if p.doubt and not p.marked:
                    out.append((p, inside))
                else:
                    todo.append((p, inside))
    return out


def prune(root: Node) -> None:
    """Takes out doubted subtrees: never one that holds an article, main or h1, and only where text is left without it. Articles
    inside readers' comments and the like (``OTHER_TEXT``) do not count if the page has an article outside all doubted nodes.

    A name of such words only goes if the page has a landmark, or a quarter of its text outside all doubted nodes; one that says
    where a text stands, not what it is, must hold no more than half of the text too. Other names (one word among others) and
    forms go if they stand outside the articles of the page and these hold a quarter of the text, or if they hold at most a
    quarter of the text that is left then, and all of them at most half. What stays is looked into in the same way."""
    order = _nodes(root)
    if not any(node.doubt for node in order):
        return
    for node in reversed(order):
        node.chars = sum(p.chars if isinstance(p, Node) else len("".join(p.split())) for p in node.pieces)
    articles, free, todo = 0, False, [(root, False)]  # free: there is an article outside all doubted nodes
    while todo:
        node, inside = todo.pop()
        if node.name in ("article", "main") and not inside:
            articles, inside = articles + node.chars, True
        free = free or node.name == "article"
        todo.extend((p, inside) for p in node.pieces if isinstance(p, Node) and not p.doubt)
    for node in reversed(order):
        node.marked = max([LANDMARKS.get(node.name, 0), *(p.marked for p in node.pieces if isinstance(p, Node))])
        if free and node.doubt == OTHER and node.marked == LANDMARKS["article"]:
            node.marked = 0
    total, found, parents = root.chars, _doubted(root, False), []
    while found:
        rest, left = total - sum(node.chars for node, _ in found), total
        for node, _ in found:
            if node.doubt > WEAK and (root.marked or 4 * rest >= total) and (node.doubt == OTHER or 2 * node.chars <= total):
                node.gone, left = True, left - node.chars
        weak = [(node, inside) for node, inside in found if node.doubt == WEAK]
        for node, inside in weak:
            if not inside and articles and 4 * articles >= total:
                node.gone, left = True, left - node.chars
        weak = [node for node, _ in weak if not node.gone]
        total = left
        if 2 * sum(node.chars for node in weak) <= left:
            for node in weak:
                if 4 * node.chars <= left:
                    node.gone, total = True, total - node.chars
        parents.extend(node.parent for node, _ in found if node.gone)
        found = [below for node, inside in found if not node.gone for below in _doubted(node, inside)]
    for parent in {id(p): p for p in parents}.values():
        parent.pieces = [p for p in parent.pieces if isinstance(p, str) or not p.gone]


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all block nodes; returns these, parents first."""
    order = _nodes(root)
    for node in reversed(order):
        node.own = sum(len("".join(p.split())) for p in node.pieces if isinstance(p, str))
        node.chars, node.tags, node.link_chars, node.link_tags = node.own, 0, 0, 0
        for p in node.pieces:
            if isinstance(p, Node):
                node.chars += p.chars
                node.tags += p.tags + (not p.inline or p.name == "a")
                node.link_chars += p.link_chars
                node.link_tags += p.link_tags
                if p.inline:
                    node.own += p.own
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body_share = root.link_chars / max(root.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_share * c + math.e)
        node.density = c / t * max(math.log(c / lc * t / lt), 0.0) / math.log(base) if base > 1.0000001 else c / t
    for node in reversed(order):
        # An inline node passes on what the blocks inside it add to the block around it.
        below = sum(p.sum if p.inline else p.density for p in node.pieces if isinstance(p, Node))
        node.sum = below if node.inline else node.own + below
    return [n for n in order if not n.inline]


def article(root: Node) -> tuple[Node, float]:
    """The smallest subtree that holds all content nodes, and the threshold."""
    blocks = measure(root)
    best: dict[int, Node] = {}  # by node, the largest density sum in its subtree (the outermost of equals)
    for node in reversed(blocks):
        own = best.get(id(node))
        if own is None or node.sum >= own.sum:
            own = best[id(node)] = node
        above = node.parent
        while above is not None and above.inline:
            above = above.parent
        if above is not None and ((seen := best.get(id(above))) is None or own.sum >= seen.sum):
            best[id(above)] = own
    top = best[id(root)]
    threshold, node = math.inf, top
    while node is not None:
        if not node.inline:
            threshold = min(threshold, node.density)
        node = node.parent
    content, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.inline and node.density >= threshold and node.chars:
            content.append(best[id(node)])
        if node is not top:
            todo.extend(p for p in node.pieces if isinstance(p, Node))

    # What all paths from the root to these nodes share: each ancestor is looked at once.
    ends, below = {id(n) for n in (top, *content)}, {}
    for node in (top, *content):
        while node.parent is not None and id(node) not in below:
            below[id(node)] = node
            node = node.parent
    children: dict[int, list[Node]] = {}
    for node in below.values():
        children.setdefault(id(node.parent), []).append(node)
    shared = root
    while id(shared) not in ends and len(children[id(shared)]) == 1:
        shared = children[id(shared)][0]
    return shared, threshold


def block_text(node: Node, threshold: float) -> str:
    """The text of a subtree; lists of links below the threshold are left out."""
    out: list[str] = []
    todo: list[str | Node] = [node]
    while todo:
        piece = todo.pop()
        if isinstance(piece, str):
            out.append(piece)
        elif not (piece is not node and not piece.inline and piece.link_tags >= 3 and piece.density < threshold
                  and piece.link_chars >= 0.8 * piece.chars):
            edge = "" if piece.inline else " "
            todo.append(edge)
            todo.extend(reversed(piece.pieces))
            todo.append(edge)
    return " ".join("".join(out).split())


def extract(page: str | None) -> str:
    """The article text of one page."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    node, threshold = article(root)
    return block_text(node, threshold)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text."""
    prepare(pages.sparkSession)
    named = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], [id_col, url_col, "text"])

    return named.mapInArrow(run, T.StructType([named.schema[id_col], named.schema[url_col], T.StructField("text", T.StringType())]))
