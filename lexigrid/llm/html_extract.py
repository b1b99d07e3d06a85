"""HTML extraction by composite text density (Sun, Song and Liao, "DOM Based Content Extraction via Text Density").

Every page is parsed into a tree of its block elements; inline elements count as tags of the block they stand in. A node's
composite density is its characters per tag, adjusted by how many of them are links, relative to the body. The node with the
largest sum of its children's densities is the page's content. The smallest density on its path to the body is the threshold
that parts of the page beside it must reach to belong to the content, too. An enclosing article or main element is taken whole.

Elements that never hold content are left out before densities are taken: by name (menus, forms, scripts, ...), by role, and by
words of their class or id (adverts, notices, sidebars, comments, ...).

The text: character references are decoded, white space inside a block becomes one space, blocks are joined by line feeds.

Defined cases: null and empty pages, and pages without content, give an empty text; unclosed, misnested or cut-off markup is
read as browsers do it, roughly; pages may be of any length. Rows are judged one by one, so repeated rows each keep a row and
an empty table gives no rows. Other columns than page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import by_rows

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|\Z)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never content.
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog embed footer form frameset head iframe input label map menu meter nav noembed noframes noscript object "
    "option progress script search select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of a class or id that mark what is not content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs byline consent cookie cookies copyright "
    "disclaimer footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup privacy "
    "promo promos promotion recommended related share sharing sidebar sidebars signin signup skip social sponsor sponsored sponsors subscribe subscription "
    "tags toolbar tracking widget widgets".split()
)
COMMENTS = frozenset("comment comments commentary disqus discussion replies reply respond responses".split())
#: Words that mark an element as one that arranges others, whatever else its class names.
ARRANGES = frozenset("container content contents has layout main page row with without wrap wrapper no".split())
#: A start tag of the key ends an open element of the value.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
#: Elements beyond which a start tag ends nothing.
SCOPES = frozenset("ul ol dl table select html body".split())


class _Node:
    __slots__ = ("tag", "parent", "kids", "chars", "links", "tags", "link_tags", "density", "total", "order")

    def __init__(self, tag: str, parent: _Node | None) -> None:
        self.tag, self.parent, self.kids = tag, parent, []
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _left_out(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in LEFT_OUT:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id"):
            found = set(re.split(r"[^a-z]+", value))
            if found & COMMENTS:
                return True
            if found & MARKS and not found & ARRANGES or "header" in found and not in_article and not found & ARRANGES:
                return True
    return False


def _parse(html: str) -> tuple[_Node, list[tuple[_Node, str]]]:
    """The body's tree without what is left out, and the page's blocks of text: (element, text), in order."""
    root = node = _Node("body", None)
    open_tags: list[tuple[str, _Node, bool, int]] = []  # name, block it stands in, left out from here, link depth before
    blocks: list[tuple[_Node, str]] = []
    text: list[str] = []
    dropped, links, at, articles = False, 0, 0, 0
    opened: Counter[str] = Counter()  # open elements by name, so that a tag without a partner costs no walk

    def flush() -> None:
        if text:
            if line := " ".join("".join(text).split()):
                blocks.append((node, line))
            text.clear()

    def put(raw: str) -> None:
        if not dropped and raw:
            plain = unescape(raw) if "&" in raw else raw
            text.append(plain)
            n = len("".join(plain.split()))
            node.chars += n
            if links:
                node.links += n

    def close(to: int) -> None:
        """Close all elements from place `to` of the stack on."""
        nonlocal node, dropped, links, articles
        for name, before, was_dropped, link_depth in reversed(open_tags[to:]):
            if name in BLOCK:
                flush()
            node, dropped, links = before, was_dropped, link_depth
            opened[name] -= 1
            articles -= name in ("article", "main")
        del open_tags[to:]

    size = len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if not found:
            put(html[at:])
            break
        put(html[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            if name == "br":
                text.append(" ")
            for i in range(len(open_tags) - 1, -1, -1) if opened[name] > 0 else ():
                if open_tags[i][0] == name:
                    close(i)
                    break
                if open_tags[i][0] in BLOCK and name not in BLOCK:
                    break
            continue
        attributes = found.group(3)
        if name in BLOCK:
            ends = ENDS.get(name, ())
            ended = opened["p"] > 0 or any(opened[x] > 0 for x in ends) or (name in HEADINGS and any(opened[x] > 0 for x in HEADINGS))
            for i in range(len(open_tags) - 1, -1, -1) if ended else ():
                was = open_tags[i][0]
                if was in ends or was == "p" or (was in HEADINGS and name in HEADINGS):
                    close(i)
                    if was != "p":
                        break
                elif was in SCOPES or (was in BLOCK and not ends):
                    break
            flush()
        if name in ("html", "body"):
            continue
        if not dropped:
            node.tags += 1
            node.link_tags += name == "a"
        if name in VOID:
            if name in ("br", "hr"):
                text.append(" ")
            continue
        if name in RAW:
            over = re.compile(rf"</{re.escape(name)}\s*+[^>]*+>", re.I).search(html, at)
            at = over.end() if over else size
            continue
        if attributes.endswith("/") and name not in BLOCK:
            continue
        open_tags.append((name, node, dropped, links))
        opened[name] += 1
        dropped = dropped or _left_out(name, attributes, articles > 0)
        articles += name in ("article", "main")
        links += name == "a"
        if name in BLOCK and not dropped:
            child = _Node(name, node)
            node.kids.append(child)
            node = child
    flush()
    close(0)
    return root, blocks


def _measure(root: _Node) -> list[_Node]:
    """All nodes from the root on, in page order, with their densities and density sums."""
    nodes, stack = [], [root]
    while stack:
        nodes.append(x := stack.pop())
        stack.extend(reversed(x.kids))
    for x in reversed(nodes):
        if x.parent is not None:
            for name in ("chars", "links", "tags", "link_tags"):
                setattr(x.parent, name, getattr(x.parent, name) + getattr(x, name))
    body_share = root.links / max(1, root.chars)
    for x in reversed(nodes):
        if x.chars:
            tags, links, link_tags = max(1, x.tags), max(1, x.links), max(1, x.link_tags)
            plain = max(1, x.chars - x.links)
            base = log(x.chars / plain * x.links + body_share * x.chars + e)
            x.density = x.chars / tags * max(0.0, log(x.chars / links * tags / link_tags)) / log(e - 1 + base)
        x.total = sum(k.density for k in x.kids)
    return nodes


def main_text(html: str | None) -> str:
    """The page's content, its blocks joined by line feeds."""
    if not html:
        return ""
    root, blocks = _parse(html)
    if not blocks:
        return ""
    nodes = _measure(root)
    best = nodes[0]
    for x in nodes:
        if x.total > best.total or (best is root and x.total == best.total and x.chars == best.chars):
            best = x
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    whole = next((x for x in path if x.tag in ("article", "main")), None)
    chosen: set[int] = set()

    def take(x: _Node) -> None:
        stack = [x]
        while stack:
            chosen.add(id(y := stack.pop()))
            stack.extend(y.kids)

    top = whole or best
    take(top)
    if whole is None:
        for below, above in zip(path, path[1:]):
            chosen.add(id(above))  # text that stands in the path's elements themselves
            for sibling in above.kids:
                if sibling is not below and (sibling.density >= threshold or sibling.tag in HEADINGS):
                    take(sibling)
    elif whole.parent is not None:
        for sibling in whole.parent.kids:  # several articles side by side
            if sibling is not whole and sibling.tag == whole.tag and sibling.density >= threshold:
                take(sibling)
    return "\n".join(line for x, line in blocks if id(x) in chosen)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(by_rows(make), "page_id long, url string, text string, n_chars long")
