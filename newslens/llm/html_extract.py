"""Main text of web pages by composite text density.

Every DOM node gets its characters per tag, adjusted for links: with ``c``
characters and ``t`` tags below a node, ``lc`` and ``lt`` of them in links, and
the body's share of link characters ``s``,

    density = c / t * log(c / max(lc, 1) * t / max(lt, 1))
                    / log(log(c / max(c - lc, 1) * lc + s * c + e))

The densities of a node's children add up to its density sum.  The node with
the largest sum is the centre of the content (a paragraph, which has text and no
parts, has none, and formatting and line breaks are no tags); the smallest density on the path
from it to the body is the threshold.  Walking down from the body, every node at
or above the threshold gives its subtree with the largest sum; its text is kept,
and the walk goes on into the node's children outside that subtree.  Short blocks
pass no threshold, so headings and paragraphs right before a kept part, and the
sections beside a kept section, go with it unless most of their text is links.

Scripts, controls and the like are cut from the tree first.  On the rest, link
characters and blocks are counted before parts beside the article are cut: those
whose tag (nav, footer, form ...) or whose class, id or role (menu, advert, share,
comments ...) says so.  Such a part stays if the article or main element lies in
it, or if, beside links, it holds more text and at least as many blocks as all
that would be left without the named parts; never a readers' part.  Names that are
also words of prose (a warning, related work, search ...) count inside the article, or
inside the densest part below the body, only where the part is mostly links; the
article's own header stays if it has a heading.

Blocks are the stretches of text between block-level tags; a line break is white
space.  Each page is parsed on its own in one pass over its tokens, in time linear
in its length: a quote opens a value only right after ``=``, and open elements are
counted, so that closing looks at no element twice.

Defined results: a null or empty html, or a page without text, has an empty
text; markup that is never closed is read as browsers do; rows are taken one by
one, so repeated and null ids do no harm; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
CUT = {"script", "style", "head", "title", "noscript", "template", "button", "select", "option",
       "textarea", "input", "iframe", "object", "embed", "applet", "svg", "canvas", "audio",
       "video", "map", "xmp", "noembed", "noframes"}
#: Parts beside the article, unless they wrap it.
PARTS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
#: An open element of the set is closed by the start of any of the others.
CLOSED_BY = {"p": {"address", "article", "aside", "blockquote", "center", "details", "div", "dl",
                   "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
                   "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre",
                   "section", "table", "ul"},
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
             "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body", "head"}}
#: Closing looks no further out than these.
SCOPE = {"table", "ul", "ol", "dl", "article", "section", "main", "body", "html", "div",
         "blockquote", "td", "th", "select"}
# Words in class, id and role that name a part beside the article.
ASIDE = {"ad", "ads", "adbox", "adsense", "advert", "adverts", "advertisement", "advertising",
         "adslot", "affiliate", "alert", "alertdialog", "announcement", "banner", "breadcrumb",
         "breadcrumbs", "comment", "comments", "commentlist", "complementary",
         "contentinfo", "consent", "cookie", "cookies", "dialog", "disclaimer",
         "discussion", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu",
         "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
         "notification", "overlay", "pager", "pagination", "paywall", "popup", "promo",
         "promoted", "promotion", "related", "recommended", "replies", "respond", "rss", "search",
         "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
         "sponsors", "subscribe", "subscription", "toolbar", "topbar", "warning",
         "widget", "widgets"}
#: What a title or a lead before the body of an article is written as.
LEAD = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "p"}
#: Names that prose has too.
CALLOUT = {"alert", "announcement", "banner", "dialog", "disclaimer", "form", "header", "menu",
           "notice", "notices", "notification", "promotion", "recommended", "related", "search",
           "warning", "widget", "widgets"}
READERS = {"comment", "comments", "commentlist", "discussion", "disqus", "replies", "respond"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""",
                       re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "parent", "children", "aside", "closable", "chars", "tags", "link_chars",
                 "link_tags", "own", "parts", "density", "total", "best")

    def __init__(self, tag, parent, aside=""):
        self.tag, self.parent, self.aside = tag, parent, aside
        #: Nodes, and strings for text.
        self.children: list = []
        #: The innermost open element that a start tag may close, within its scope.
        self.closable = self if tag in CLOSED_BY else (
            None if parent is None or tag in SCOPE else parent.closable)


def named_aside(attributes: str) -> str:
    """"aside", "readers" or "callout" if class, id or role names a part beside the article."""
    found = ""
    for key, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if key.lower() == "aria-hidden":
            found = "aside" if value.lower() == "true" else found
        else:
            words = {w.lower() for w in NAME.findall(value)}
            if words & READERS:
                return "readers"
            if words & (ASIDE - CALLOUT):
                found = "aside"
            elif words & CALLOUT:
                found = found or "callout"
    return found


def parse(page: str) -> _Node:
    """The page as a tree; scripts, comments and other markup are left out."""
    root = node = _Node("#root", None)
    is_open: Counter[str] = Counter()
    at = 0

    def leave(inner: _Node, outer: _Node) -> _Node:
        while inner is not outer:
            is_open[inner.tag] -= 1
            inner = inner.parent
        return outer

    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            node.children.append(_html.unescape(text))
        if not m:
            return root
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                node.children.append(m[0][9:-3])
            continue
        tag = m[2].lower()
        if m[1]:
            if is_open[tag]:
                look = node
                while look.tag != tag:
                    look = look.parent
                node = leave(node, look.parent)
            continue
        look = node.closable
        while look is not None:
            if tag in CLOSED_BY[look.tag]:
                node = leave(node, look.parent)
                break
            look = None if look.tag in SCOPE else look.parent.closable
        child = _Node(tag, node, named_aside(m[3]) if m[3] else "")
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag == "textarea" or tag == "title":
                child.children.append(_html.unescape(page[at:end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            node = child
            is_open[tag] += 1


def _order(root: _Node) -> list[_Node]:
    """All nodes, parents first."""
    out = [root]
    for n in out:
        out.extend(c for c in n.children if not isinstance(c, str))
    return out


def _article(nodes: list[_Node]) -> _Node | None:
    """The article element with the most text, none of a readers' part."""
    size: dict[int, int] = {}
    for n in reversed(nodes):
        size[id(n)] = sum(len(c) if isinstance(c, str) else size[id(c)] for c in n.children)
    best = None
    for n in nodes:
        if n.tag == "article" and not n.aside and (best is None or size[id(n)] > size[id(best)]):
            look = n
            while look is not None and look.aside != "readers":
                look = look.parent
            best = n if look is None else best
    return best


def _path(node: _Node | None, seen: set[int]) -> None:
    """Add a node and what it lies in to a set."""
    while node is not None and id(node) not in seen:
        seen.add(id(node))
        node = node.parent


def _named(top: _Node, keeps: set[int]) -> list[_Node]:
    """The outermost parts below a node that their name puts beside the article."""
    out, todo = [], [top]
    while todo:
        for c in todo.pop().children:
            if not isinstance(c, str):
                named = (c.tag in PARTS or c.aside) and id(c) not in keeps
                (out if named else todo).append(c)
    return out


def prune(root: _Node) -> None:
    """Cut what is beside the article, but nothing that the article lies in."""
    nodes = _order(root)
    keeps: set[int] = set()
    article = _article(nodes)
    mains = [n for n in nodes if n.tag == "main"]
    for n in [*(n for n in nodes if n.tag in ("main", "body", "html")), article]:
        _path(n, keeps)
    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or id(c) in keeps
                      or c.tag not in CUT]
    weigh(root)
    nodes = _order(root)
    text = {id(n): n.chars - n.link_chars for n in nodes}
    count: dict[int, int] = {}
    for n in reversed(nodes):
        own = n.tag == "br" or n.tag not in INLINE and n.own > 0
        count[id(n)] = own + sum(count[id(c)] for c in n.children if not isinstance(c, str))

    # Callouts are part of the text that they stand in, and a header of its article.
    centre = max(nodes, key=lambda n: n.total)
    while centre is not None and (centre.aside == "callout" or centre.tag == "section"):
        centre = centre.parent
    within = {id(n) for n in (article, centre)
              if n is not None and n.tag not in ("body", "html", "#root")}
    headed = set()
    for n in reversed(nodes):
        if n.parent is not None and (n.tag in LEAD - {"p"} or id(n) in headed):
            headed.add(id(n.parent))
    inside = {id(article)} if article else set()
    for n in nodes:
        if n.parent is not None and id(n.parent) in within:
            within.add(id(n))
            if n.aside == "callout" and 2 * n.link_chars <= n.chars:
                n.aside = ""
        if n.parent is not None and id(n.parent) in inside:
            inside.add(id(n))
            if n.tag == "header" and id(n) in headed and 2 * n.link_chars <= n.chars:
                keeps.add(id(n))

    # A named part that outweighs all that is left without such parts wraps the article.
    def left(top: _Node, parts: list[_Node]) -> tuple[int, int]:
        return (text[id(top)] - sum(text[id(c)] for c in parts),
                count[id(top)] - sum(count[id(c)] for c in parts))

    parts, rest = [], (0, 0)
    for top in [*([article] if article else mains[:1]), root]:
        parts = _named(top, keeps)
        rest = left(top, parts)
        # An article of one block is a teaser or a frame round named parts.
        if rest[1] > 1:
            break
    while wraps := [c for c in parts if c.aside != "readers"]:
        most = max(wraps, key=lambda c: text[id(c)])
        if text[id(most)] <= rest[0] or count[id(most)] < rest[1]:
            break
        keeps.add(id(most))
        parts = _named(most, keeps)
        rest = tuple(a + b for a, b in zip(rest, left(most, parts), strict=True))

    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or id(c) in keeps
                      or not (c.tag in PARTS or c.aside)]


def weigh(root: _Node) -> None:
    """Counts, densities and density sums of all nodes."""
    nodes = _order(root)
    for n in reversed(nodes):
        n.chars = n.tags = n.link_chars = n.link_tags = n.own = n.parts = 0
        for c in n.children:
            if isinstance(c, str):
                size = len(SPACE.sub(" ", c).strip())
                n.chars += size
                n.own += size
            elif c.tag in INLINE and c.tag != "a":
                # Formatting is no structure: its contents count as the node's own.
                for k in ("chars", "tags", "link_chars", "link_tags", "own", "parts"):
                    setattr(n, k, getattr(n, k) + getattr(c, k))
            else:
                n.parts += c.tag != "a"
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.chars if c.tag == "a" else c.link_chars
                n.link_tags += c.link_tags + (c.tag == "a")
    share = root.link_chars / max(root.chars, 1)
    for n in nodes:
        c, t, lc, lt = n.chars, max(n.tags, 1), n.link_chars, n.link_tags
        n.density = 0.0
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            gain = math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0))
            n.density = c / t * gain / max(math.log(base), 1.0)
    for n in nodes:
        n.total = sum(c.density for c in n.children if not isinstance(c, str))
        if n.parts:
            # Text between the parts of a node counts like one of them.
            n.total += n.own * math.log(max(n.own, 1))
        else:
            n.total = 0.0


def select(body: _Node) -> list[_Node]:
    """The subtrees that hold the content, in page order."""
    for n in reversed(_order(body)):
        n.best = n
        for c in n.children:
            if not isinstance(c, str) and c.best.total > n.best.total:
                n.best = c.best
    centre = body.best
    if not centre.chars:
        return []
    threshold, n = centre.density, centre
    while n is not None and n is not body.parent:
        threshold = min(threshold, n.density)
        n = n.parent
    kept, todo = {}, [body]
    while todo:
        n = todo.pop()
        if n.chars and n.density >= threshold and id(n) not in kept:
            kept[id(n.best)] = n.best
            if n.best is not n:
                todo.extend(c for c in n.children if not isinstance(c, str))
    for n in list(kept.values()):
        kept.update((id(c), c) for c in _beside(n, body))
    out, todo = [], [body]
    while todo:
        n = todo.pop()
        if id(n) in kept:
            out.append(n)
        else:
            todo.extend(c for c in reversed(n.children) if not isinstance(c, str))
    return out


def _beside(node: _Node, body: _Node) -> list[_Node]:
    """Title and lead before a kept part, and the sections beside a kept section."""
    while node is not body:
        nodes = [c for c in node.parent.children
                 if not isinstance(c, str) and c.chars > 2 * c.link_chars]
        # A kept part that is mostly links has no place among these.
        at = next((i for i, c in enumerate(nodes) if c is node), 0)
        found = [c for i, c in enumerate(nodes) if c is not node and (
            c.tag in LEAD and i < at or c.tag == node.tag == "section")]
        if found:
            return found
        node = node.parent
    return []


def blocks(node: _Node) -> list[str]:
    """The texts between block-level tags, white space as single spaces."""
    out, run = [], []

    def flush():
        text = SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        n = todo.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            run.append(n)
        elif n.tag == "br":
            run.append(" ")
        else:
            block = n.tag not in INLINE
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(n.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article of one page, blocks joined by an empty line."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    body = next((n for n in _order(root) if n.tag == "body"), root)
    weigh(body)
    return "\n\n".join(b for n in select(body) for b in blocks(n))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"),
                        F.col(url).cast("string").alias("url"),
                        F.col(html).alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
