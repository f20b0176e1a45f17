"""Main text of HTML pages by composite text density.

A page is parsed into a tree (start and end tags, implied ends, raw text of scripts and styles).  Every node gets characters C,
tags T, link characters LC and link tags LT, and from them the composite density

    C / T * log(C / LC * T / LT) / log(log(C / notLC * LC + LCb / Cb * C + e))        (b: the body; zero counts become one)

that is characters per tag, weighted down by links.  The density sum of a node is the sum over its children, its own text
counting as a child of one tag; the node with the largest sum is the core of the article, and the least density on the path from
it up to the body is the page's threshold.  Going down from the body, each node that reaches the threshold gives its largest-sum
subtree to the result, and its children are looked at in turn; a node that does not reach it is left with all it holds.  Where the
core lies in an ``article`` or ``main`` element, these elements are the nodes to choose from: the outermost one around the core,
and the other outermost ones that reach the threshold.  Headings that stand right before the result belong to it.

Before that, subtrees go that are never article text: scripts, styles, forms, menus, page headers and footers, sidebars, hidden
parts, and what its class, id or role calls an advert, notice, share bar or comment section.  ``header`` and ``footer`` elements of
an article count as page furniture, too.  A mark does not drop what holds the page: a form, or an element with such a name, stays
(its own marked parts go) if it holds a ``main`` element, if it holds an ``article`` and none is outside of such elements, or, where the
name is only a part of its class or id, if it holds most of the plain text of a page without these elements.  Names of states
(``has-sidebar``, ``comments-open``) are no marks.

Blocks are what block elements part; white space inside becomes one space, also a line break; empty blocks go; blocks are
joined by one line feed.

Nulls: null and empty pages have an empty text.  Rows are independent; repeated rows and other columns pass through, columns of
the results' names are replaced.  Time is linear in the page; nothing is cut.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query

# Element names of the HTML standard (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "head", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend"}
#: Start tag -> (elements it ends if open, elements beyond which it doesn't look).
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
DROPPED = frozenset(
    "script style noscript template title head nav header footer aside form button select textarea input iframe object embed svg canvas audio video map dialog menu"
    " noembed noframes datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banner|sponsor(?:ed|s)?|promo(?:tion)?s?|nav(?:bar|igation)?|menus?|breadcrumbs?|sidebars?|side-bar|widgets?|"
    r"footers?|masthead|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscri(?:be|ption)|share|sharing|social|comments?|disqus|respond|replies|related|recommended|"
    r"pagination|pager|skip-link|toolbar|login|signup)(?:$|[\s_-])",
    re.I,
)
_TAG = re.compile(r"<(?:!--(?:>|->|(.*?)--!?>)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?/][^>]*>)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


#: What a class or id says about its element: nothing, a part of a name, a whole name; what no text is ever in.
NONE, PART, WHOLE, NEVER = range(4)
#: Elements that are page furniture unless they hold the page.
PERHAPS = {"form": PART, "header": WHOLE, "footer": WHOLE, "aside": WHOLE, "button": WHOLE}
_STATE = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|without|no|is|hide|show)[_-][\w-]+|[\w-]+[_-](?:open|opened|closed|enabled|disabled|on|off|free)(?=$|\s)", re.I)
_COMMENT = re.compile(r"(?:^|\s)(?:comments?|comment-body|repl(?:y|ies))(?:$|\s)", re.I)


class Node:
    __slots__ = ("chars", "children", "density", "dropped", "link_chars", "link_tags", "mark", "name", "own", "parent", "sum", "tags")

    def __init__(self, name: str, parent: Node | None, mark: int = NONE):
        self.name, self.parent, self.mark, self.dropped = name, parent, mark, False
        self.children: list[Node | str] = []
        self.chars = self.own = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _name_mark(names: str) -> int:
    """What a class or id says, names of states left out."""
    names = _STATE.sub(" ", names)
    found = NONE
    for hit in _FURNITURE.finditer(names):
        whole = (hit.start() == 0 or names[hit.start()].isspace()) and (hit.end() == len(names) or names[hit.end() - 1].isspace())
        found = max(found, WHOLE if whole else PART)
    return found


def _mark(name: str, attributes: str) -> int:
    """What an element's name and attributes say about it."""
    if name in DROPPED and name not in PERHAPS:
        return NEVER
    mark = PERHAPS.get(name, NONE)
    if not attributes or name in ("body", "html"):
        return mark
    found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    style = found.get("style", "").replace(" ", "").lower()
    if name in ("article", "main"):
        # Readers' comments are marked up as articles, too.
        return WHOLE if name == "article" and _COMMENT.search(found.get("class", "")) else NONE
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return NEVER
    if found.get("role", "").lower() in ROLES:
        mark = max(mark, PART if found["role"].lower() == "form" else WHOLE)
    return max(mark, _name_mark(found.get("class", "")), _name_mark(found.get("id", "")))


def drop_furniture(root: Node) -> None:
    """Set ``dropped`` on the marked subtrees that don't hold the page."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if type(c) is Node and c.mark != NEVER]
    plain: dict[int, int] = {}
    mains: dict[int, bool] = {}
    articles: dict[int, bool] = {}
    for node in reversed(order):
        inner = [c for c in node.children if type(c) is Node and c.mark != NEVER]
        own = 0 if node.name == "a" else sum(sum(map(len, c.split())) for c in node.children if type(c) is str)
        plain[id(node)] = own + (0 if node.name == "a" else sum(plain[id(c)] for c in inner))
        mains[id(node)] = any(c.name == "main" or mains[id(c)] for c in inner)
        articles[id(node)] = any(c.name == "article" and not c.mark or articles[id(c)] for c in inner)
    # Articles and mains outside of all marked elements.
    free, stack = False, [root]
    while stack and not free:
        node = stack.pop()
        free = node.name in ("article", "main")
        stack += [c for c in node.children if type(c) is Node and not c.mark]
    semantic = mains[id(root)] or articles[id(root)]
    stack = [root]
    while stack:
        node = stack.pop()
        holds = mains[id(node)] or articles[id(node)] and not free or node.mark == PART and not semantic and 2 * plain[id(node)] > plain[id(root)]
        if node.mark and not holds:
            node.dropped = True
            continue
        for c in node.children:
            if type(c) is Node:
                if c.mark == NEVER:
                    c.dropped = True
                else:
                    stack.append(c)


def parse(page: str) -> Node:
    """The tree below the root; text outside of tags as strings, references decoded."""
    root = Node("html", None)
    top, at, size = root, 0, len(page)
    still_open: Counter[str] = Counter()

    def end_node(node: Node) -> None:
        """End ``node`` and all that is open inside."""
        nonlocal top
        while top is not node:
            still_open[top.name] -= 1
            top = top.parent
        still_open[node.name] -= 1
        top = node.parent

    def text(i: int, j: int) -> None:
        if i < j:
            top.children.append(html.unescape(page[i:j]))

    while at < size:
        less = page.find("<", at)
        if less < 0:
            text(at, size)
            break
        tag = _TAG.match(page, less)
        if tag is None:
            text(at, less)
            if page.startswith("<!--", less) or re.match(r"</?[a-zA-Z]", page[less : less + 3]):
                break  # a comment or tag that the page's end cuts off is no text
            top.children.append("<")
            at = less + 1
            continue
        text(at, less)
        at = tag.end()
        name = (tag[3] or "").lower()
        if not name:
            continue
        if tag[2]:
            if still_open[name]:
                node = top
                while node.name != name:
                    node = node.parent
                end_node(node)
            elif name in ("p", "br"):
                top.children.append(Node(name, top))
            continue
        if name == "html":
            continue
        if still_open["p"] and name in CLOSES_P:
            node = top
            while node.name not in ("p", "button", "td", "th", "caption", "object"):
                node = node.parent
            if node.name == "p":
                end_node(node)
        if name in IMPLIED and any(still_open[x] for x in IMPLIED[name][0]):
            ends, stops = IMPLIED[name]
            node, found = top, None
            while node is not root and node.name not in stops:
                if node.name in ends:
                    found = node
                node = node.parent
            if found is not None:
                end_node(found)
        if name == "body":
            top = root
            still_open.clear()
        node = Node(name, top, _mark(name, tag[4]))
        top.children.append(node)
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            stop = end.start() if end else size
            if name in ("textarea", "title") and stop > at:
                node.children.append(html.unescape(page[at:stop]))
            close = page.find(">", stop) if end else -1
            at = close + 1 if close >= 0 else size
        elif name not in VOID and not tag[4].rstrip().endswith("/") or name in BLOCK and name not in VOID:
            still_open[name] += 1
            top = node
    drop_furniture(root)
    return root


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            order.append(node)
            stack += [c for c in node.children if type(c) is Node]
    return order[::-1]


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, body_links: int, body_chars: int) -> float:
    """Composite text density, zero counts taken as one."""
    if not chars:
        return 0.0
    t, lc, lt, plain = tags or 1, link_chars or 1, link_tags or 1, (chars - link_chars) or 1
    base = math.log(chars / plain * lc + (body_links or 1) / (body_chars or 1) * chars + math.e)
    return chars / t * math.log(chars / lc * t / lt) / math.log(base)


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all kept nodes, children before parents."""
    order = _post_order(root)
    for node in order:
        is_link = node.name == "a"
        for child in node.children:
            if type(child) is str:
                node.own += sum(map(len, child.split()))
            elif not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        node.chars += node.own
        if is_link:
            node.link_chars = node.chars
    body = _body(root, order)
    for node in order:
        node.density = composite_density(node.chars, node.tags, node.link_chars, node.link_tags, body.link_chars, body.chars)
    for node in order:
        own = composite_density(node.own, 1, node.own if node.name == "a" else 0, 0, body.link_chars, body.chars)
        node.sum = own + sum(c.density for c in node.children if type(c) is Node and not c.dropped)
    return order


def _body(root: Node, order: list[Node]) -> Node:
    return next((n for n in order if n.name == "body"), root)


def _kept(node: Node) -> list[Node]:
    return [c for c in node.children if type(c) is Node and not c.dropped and c.chars]


def content(root: Node) -> list[Node]:
    """The subtrees that make up the main text, in page order."""
    order = measure(root)
    body = _body(root, order)
    inside = [n for n in order if n.chars]
    if not inside:
        return []
    core = max(reversed(inside), key=lambda n: n.sum)
    threshold, node = core.density, core
    while node is not None:
        threshold = min(threshold, node.density)
        if node is body:
            break
        node = node.parent
    whole = _whole_article(core)
    taken: set[int] = set()
    if whole is not core or core.name in ("article", "main"):
        taken = {id(n) for n in inside if n is whole or n.name in ("article", "main") and n.density >= threshold}
    else:
        # Of every node that is reached: its largest-sum subtree.
        best: dict[int, Node] = {}
        for n in order:
            best[id(n)] = max([n, *(best[id(c)] for c in _kept(n))], key=lambda m: m.sum)
        stack = [body]
        while stack:
            n = stack.pop()
            if n.chars and n.density >= threshold and id(n) not in taken:
                taken.add(id(best[id(n)]))
                stack += _kept(n)
    return _outermost(root, taken)


def _outermost(root: Node, taken: set[int]) -> list[Node]:
    """The taken nodes that lie in no other one, in page order, each after the headings right before it."""
    out, stack = [], [root]
    places: dict[int, dict[int, int]] = {}
    while stack:
        n = stack.pop()
        if id(n) in taken:
            out += [*_headings(n, taken, places), n]
        else:
            stack += [c for c in reversed(n.children) if type(c) is Node and not c.dropped]
    return list({id(n): n for n in out}.values())


def _headings(node: Node, taken: set[int], places: dict[int, dict[int, int]]) -> list[Node]:
    """Headings that stand right before a node, or before what it is the beginning of."""
    while node.parent is not None and node.name != "body":
        found, siblings = [], node.parent.children
        if id(node.parent) not in places:
            places[id(node.parent)] = {id(c): i for i, c in enumerate(siblings)}
        for i in range(places[id(node.parent)][id(node)] - 1, -1, -1):
            c = siblings[i]
            if type(c) is str:
                if c.strip():
                    return found[::-1]
            elif c.chars and not c.dropped:
                if re.fullmatch("h[1-6]|hgroup", c.name) is None or id(c) in taken or c.link_chars == c.chars:
                    return found[::-1]
                found.append(c)
        if found:
            return found[::-1]
        node = node.parent
    return []


def _whole_article(node: Node) -> Node:
    """The outermost article or main element around ``node``, else the node."""
    found, up = node, node
    while up is not None:
        if up.name in ("article", "main"):
            found = up
        up = up.parent
    return found


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node``, dropped subtrees left out."""
    out: list[list[str]] = [[]]
    stack: list[Node | str | None] = [node]
    while stack:
        item = stack.pop()
        if item is None:
            out.append([])
        elif type(item) is str:
            out[-1].append(item)
        elif not item.dropped:
            if item.name == "br":
                out[-1].append(" ")
            elif item.name in BLOCK:
                out.append([])
                stack.append(None)
                stack += item.children[::-1]
            else:
                stack += item.children[::-1]
    texts = (" ".join("".join(parts).split()) for parts in out)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for node in content(parse(page)) for b in blocks(node))


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_column`` as ``out``."""

    @F.pandas_udf("string")
    def of_pages(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    return pages.withColumn(out, of_pages(F.col(html_column)))


@query("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
