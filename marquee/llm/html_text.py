"""The main text of web pages by composite text density.

A page becomes a tree of nodes. Each node's density is its characters per tag, corrected by
how many of both are in links. A node's sum is that of its children's densities. The node
with the largest sum holds the content; the smallest density on its way up to the body is
the threshold that other parts must reach to belong to it.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import map_texts

# Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody tfoot thead tr ul".split())
CELLS = frozenset(("td", "th"))
DROPPED = frozenset(
    "aside audio button canvas dialog embed footer head header iframe input math menu nav noscript object script select "
    "style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
#: What an opening tag closes, up to the elements named second.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
SCOPES = frozenset("table td th caption button object".split())
#: Elements whose end tags are heeded from within a scope.
_PAST_SCOPES = SCOPES | frozenset(("tr", "tbody", "html", "body"))

#: Words in a class or id, between hyphens and the like, that speak for what is not the article. Density has the last word.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation "
    "menu sidebar footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist respond disqus "
    "replies discussion related recommended recommendations pagination pager toolbar widget skip".split())
#: Words that speak for the article; a name that has one of them besides is not held against it.
ARTICLE = frozenset("article post entry story content main".split())
#: A heading over what readers say.
_COMMENTS = re.compile(
    r"(?i)\s*(?:\d+\s+(?:comments?|replies|responses)|(?:comments?|replies|responses)\s*\(\d+\)|(?:reader |user )?comments:?|"
    r"leave a (?:comment|reply))\s*")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
#: First and last words of names that tell a state of the page, such as has-sidebar and comments-open.
STATE_FIRST = frozenset("has have no not with without show hide".split())
STATE_LAST = frozenset("open opened closed on off enabled disabled active inactive".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)")
_BLANK = re.compile(r"\s+")
#: A tag, comment or reference that the page breaks off in.
_BROKEN = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?\Z")
_CONTENT = frozenset(("html", "body", "article", "main"))
_CONTAINERS = frozenset("html body article main div section center td table tbody".split())


class Node:
    __slots__ = ("tag", "noise", "suspect", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density",
                 "total", "plain", "articles")

    def __init__(self, tag: str, parent: Node | None, noise: bool):
        self.tag, self.parent, self.noise, self.suspect = tag, parent, noise, False
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.plain = self.articles = 0


class _Tree(HTMLParser):
    """A tree from whatever is there: what is left open is closed by what follows, stray end tags are passed over.

    The open elements are a path; by name it is known where on the path each is open. So no
    tag looks further up than to what it closes, and a page takes time in proportion to its
    tags however deep it is.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, False)
        self.path = [self.root]
        self.open: dict[str, list[int]] = {}
        self.nodes = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html" or tag == "body" and self.open.get("body"):
            return
        if tag in BLOCKS:
            self._close(("p",), SCOPES)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        at = self.path[-1]
        node = Node(tag, at, tag in DROPPED or bool(attrs) and tag not in _CONTENT and _is_noise(attrs))
        node.suspect = tag == "form" or bool(attrs) and tag not in _CONTENT and _is_suspect(attrs)
        at.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.path))
            self.path.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "script") and self.path[-1].tag == tag:
            self._leave(len(self.path) - 1)

    def handle_endtag(self, tag: str) -> None:
        place = self._nearest((tag,))
        if place and (tag in _PAST_SCOPES or self._nearest(SCOPES) < place):
            self._leave(place)

    def handle_data(self, data: str) -> None:
        self.path[-1].children.append(data)

    def _nearest(self, tags) -> int:
        """Where on the path the innermost of some elements is, or 0."""
        return max((places[-1] for t in tags if (places := self.open.get(t))), default=0)

    def _leave(self, place: int) -> None:
        """Close the element at a place and all that is open in it."""
        while len(self.path) > place:
            self.open[self.path.pop().tag].pop()

    def _close(self, tags: tuple, scopes) -> None:
        """Close the nearest of the tags, unless one of the scopes stands between."""
        place = self._nearest(tags)
        if place and self._nearest(scopes) < place:
            self._leave(place)


def _is_noise(attrs: list) -> bool:
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if not value:
            continue
        if name == "role" and value.strip().lower() in ROLES or name == "style" and _HIDDEN.search(value):
            return True
    return False


def _is_suspect(attrs: list) -> bool:
    names: list[list[str]] = []
    for name, value in attrs:
        if not value:
            continue
        if name == "role" and value.strip().lower() == "form":
            return True
        if name in ("class", "id"):
            names += [[p.lower() for p in _PARTS.findall(given)] for given in value.split()]
    if any(len(parts) == 1 and parts[0] in ARTICLE for parts in names):
        return False
    return any(not NOISE.isdisjoint(parts) and parts[0] not in STATE_FIRST and parts[-1] not in STATE_LAST
               for parts in names)


def parsed(html: str) -> list[Node]:
    """The nodes of a page, parents before children; the first is the root."""
    tree = _Tree()
    tree.feed(_BROKEN.sub("", html))
    tree.close()
    judge(tree.nodes)
    return tree.nodes


def judge(nodes: list[Node]) -> None:
    """Make noise of suspects, but not of one that holds most of the page's text outside links.

    If there is an article or main element with such text elsewhere, what is most of the
    page, as long comments may be, is noise all the same. What stands under a heading over
    comments is such a suspect; where that is the article itself, what follows the heading is.
    """
    for node in nodes:
        if node.tag in _HEADINGS and node.parent is not None and _COMMENTS.fullmatch(_own_text(node)):
            if node.parent.tag in _CONTENT or node.parent.parent is None:
                after = node.parent.children
                for beside in after[after.index(node):]:
                    if isinstance(beside, Node):
                        beside.suspect = True
            else:
                node.parent.suspect = True
    if not any(n.suspect for n in nodes):
        return
    for node in reversed(nodes):
        if node.noise or node.tag == "a":
            continue
        for child in node.children:
            if isinstance(child, str):
                node.plain += sum(map(len, child.split()))
            else:
                node.plain += child.plain
                node.articles += child.articles
        if node.tag in ("article", "main"):
            node.articles = node.plain
    whole, articles = nodes[0].plain, nodes[0].articles
    within: set[int] = set()
    for node in nodes:
        inside = node.tag in ("article", "main") or node.parent is not None and id(node.parent) in within
        if inside:
            within.add(id(node))
        if node.suspect and (2 * node.plain <= whole or not inside and node.articles < articles):
            node.noise = True


def _own_text(node: Node) -> str:
    """The text of a heading and of what stands directly in it, as far as a heading over comments is long."""
    parts = [c if isinstance(c, str) else "".join(x for x in c.children if isinstance(x, str)) for c in node.children[:5]]
    return "".join(parts)[:80]


def densities(nodes: list[Node]) -> None:
    """Fill in each node's counts, density and sum. What is not content counts for nothing."""
    for node in reversed(nodes):
        if node.noise:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.chars += sum(map(len, child.split()))
            elif not child.noise:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    ratio = nodes[0].link_chars / nodes[0].chars if nodes[0].chars else 0.0
    for node in reversed(nodes):
        if not node.noise:
            node.density = composite_density(node, ratio)
            node.total = sum(c.density for c in node.children if isinstance(c, Node))


def composite_density(node: Node, page_ratio: float) -> float:
    """Characters per tag, less where much of both is in links, against how much is in links on the page."""
    if not node.chars:
        return 0.0
    tags, link_tags = max(1, node.tags), max(1, node.link_tags)
    link, plain = max(1, node.link_chars), max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * link + page_ratio * node.chars + math.e)
    inner = node.chars / link * tags / link_tags
    return max(0.0, node.chars / tags * math.log(max(inner, 1.0000001)) / math.log(max(base, 1.0000001)))


def content(nodes: list[Node]) -> Node:
    """The container with the largest sum, or one around it while that adds text as dense as the threshold asks.

    The threshold is the smallest density from there up to the body. What stands in a
    paragraph is no container; an article or main element around the choice is its whole.
    """
    best = max((n for n in nodes if not n.noise), key=lambda n: n.total, default=nodes[0])
    while best.parent is not None and best.tag not in _CONTAINERS:
        best = best.parent
    path = [best]
    while path[-1].parent is not None and path[-1].tag != "body":
        path.append(path[-1].parent)
    for node in path:
        if node.tag in ("article", "main"):
            return node
    threshold = min((n.density for n in path if n.density), default=0.0)
    taken = best
    for inside, outside in zip(path, path[1:]):
        beside = (c for c in outside.children if c is not inside)
        if any(c.strip() if isinstance(c, str) else c.chars and not c.noise and c.density >= threshold for c in beside):
            taken = outside
    return taken


def blocks(node: Node) -> list[str]:
    """The blocks of text under a node in page order, white space made one space."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        text = _BLANK.sub(" ", "".join(buffer)).strip()
        if text:
            out.append(text)
        buffer.clear()

    stack: list[tuple] = [(node, False)]
    while stack:
        at, leaves = stack.pop()
        if isinstance(at, str):
            buffer.append(at)
            continue
        if at.noise and at is not node:
            if at.tag in BLOCKS and not leaves:
                flush()
            continue
        if at.tag in BLOCKS:
            flush()
        elif at.tag == "br" or at.tag in CELLS:
            buffer.append(" ")
        if not leaves:
            stack.append((at, True))
            stack += [(child, False) for child in reversed(at.children)]
    flush()
    return out


def main_text(html: str) -> str:
    """The article of a page, blocks joined by two line breaks; empty for a page without any text."""
    if not html:
        return ""
    nodes = parsed(html)
    densities(nodes)
    return "\n\n".join(blocks(content(nodes)))


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col`` and ``text``, the main text of each row; a null or empty page gives an empty text.

    Pages are read whole, each by itself; rows that repeat are each read.
    """
    return map_texts(df, id_col, html_col, lambda pages: [[main_text(p) for p in pages]],
                     {"text": pa.string()}, slice_chars=8 << 20)


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``extract`` with the url of each row and ``n_chars``, the text's code points."""
    packed = df.select(F.struct(F.col(id_col).alias("page"), F.col(url_col).alias("url")).alias("key"),
                       F.col(html_col).alias("html"))
    return extract(packed, "key", "html").select(
        F.col("key.page").alias(id_col), F.col("key.url").alias(url_col), "text",
        F.char_length("text").cast("bigint").alias("n_chars"))
