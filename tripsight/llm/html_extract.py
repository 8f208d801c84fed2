"""Main text of web pages by composite text density.

Each page is parsed into a DOM. Elements that never hold an article's text (scripts, menus, hidden
parts; by tag or attribute) are cut out. Forms, adverts, notices, comments and the like (by tag, role or
class word) are cut out too, but never a main element, an article outside others, or a wrapper: what
holds the page's main element, its only such article or, where none stands beside it, most of the
characters outside links. If nothing is left, these cuts are dropped. Every remaining node gets a density: its characters per tag, weighted down by the share of characters and tags in links
relative to the whole body. A node's density sum adds up its children's densities; the node of the
largest sum, or the article element around it, holds the article. The least density on the path from
that node to the body is the threshold: beside the article, only branches of its ancestors that reach
it are added, with a heading right before them or before the article. Within what is selected,
link-dense branches below the threshold are left out.

Text is decoded, white space inside a block becomes one space, blocks are trimmed and joined in
page order by an empty line. Nothing is capped.

Defined results: null and empty html, and pages without text, give the empty text; broken markup
is repaired as browsers do in the common cases (open paragraphs, items and cells end at the next
one; an unmatched end tag is skipped); an empty table gives no rows; repeated rows give one row
each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsight.llm.common import batch, rows_of

#: Share of a branch's characters in links from which it counts as a list of links.
LINK_SHARE = 0.5
#: Floor of the logarithm that link shares divide by (it is 0 on a page without links).
LEAST_LOG = 0.1
#: Bytes of text beyond which an Arrow batch leaves the task.
OUT_BYTES = 8 << 20

#: HTML element classes (``DOUBT``: tags of ``CUT`` that may wrap a whole page).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CUT = {"head", "title", "script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "audio",
       "video", "nav", "aside", "footer", "form", "button", "select", "textarea", "dialog", "menu"}
DOUBT = {"form"}
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
          "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
          "thead", "tr", "ul"} | CUT
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
            "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: An open element of the key ends at a start tag of the value, within the given container.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}), "th": ({"td", "th", "tr", "tbody", "tfoot"}, {"table"}),
        "tr": ({"tr", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu",
             "menubar", "alertdialog"}
CUT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "advertising", "sponsor", "sponsored",
             "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup",
             "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "comment", "comments",
             "commentlist", "disqus", "respond", "replies", "sidebar", "menu", "nav", "navbar", "navigation",
             "breadcrumb", "breadcrumbs", "footer", "topbar", "masthead", "social", "share", "sharing", "related",
             "recommended", "recommendations", "widget", "pagination", "pager", "login", "paywall", "disclaimer"}
KEEP_WORDS = {"article", "post", "entry", "content", "main", "story", "text"}

_MARKUP = re.compile("<[a-zA-Z!?/]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "doubt", "chars", "links", "tags", "link_tags", "density", "total",
                 "depth", "block", "article", "main")

    def __init__(self, tag: str, parent: "Node | None", cut: bool):
        self.tag, self.parent, self.cut, self.doubt = tag, parent, cut, False
        self.children: list = []  # nodes and strings
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0
        # what stands above, the node itself included: its depth, the depth of the nearest block, article, main
        self.depth = parent.depth + 1 if parent else 0
        self.block = self.depth if tag in BLOCKS or not parent else parent.block
        self.article = tag == "article" or parent is not None and parent.article
        self.main = tag == "main" or parent is not None and parent.main


class _Builder(HTMLParser):
    """Builds the DOM in time linear in the page, however deep or broken it is."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None, False)
        self.nodes = [self.root]
        self.open: dict[str, list[Node]] = {}  # open elements by tag, innermost last

    def read(self, html: str) -> None:
        self.feed(html)
        while self.rawdata and not self.cdata_elem and _MARKUP.match(self.rawdata):
            # markup without its end: a broken comment or section ends at the next ">", a broken tag is skipped
            rest, self.rawdata = self.rawdata, ""
            if rest.startswith(("<!--", "<![")):
                rest = rest.replace(rest[:3], "<! ")
            else:
                rest = rest[rest.find(">") + 1:] if ">" in rest else ""
            self.feed(rest)
        self.close()

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # a section of no known kind is a comment up to the next ">"
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else -1

    def _leave(self, to: Node) -> None:
        """Make ``to``, an open element, the current one; what is open below it ends."""
        while self.at is not to:
            self.open[self.at.tag].pop()
            self.at = self.at.parent

    def _deepest(self, tags) -> Node:
        """The innermost open element of these tags, or the root."""
        return max((held[-1] for t in tags if (held := self.open.get(t))), key=lambda n: n.depth, default=self.root)

    def _cut(self, tag: str, attrs) -> bool:
        """Whether an element never shows article text, whatever it holds."""
        if tag in CUT - DOUBT:
            return True
        if tag in ("html", "body"):
            return False
        article = tag in ("article", "main") or self.at.article or self.at.main
        if tag == "header" and not article:
            return True
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        return False

    def _doubt(self, tag: str, attrs) -> bool:
        """Whether a tag, role or class word speaks against an element; ``_settle`` decides."""
        if tag in DOUBT:
            return True
        if tag in ("html", "body", "main"):
            return False
        role, words = False, set()
        for name, value in attrs:
            value = value or ""
            if name == "role" and value.lower() in CUT_ROLES:
                role = True
            if name in ("class", "id"):
                words.update(w.lower() for w in _WORD.findall(value))
        if not role and not words & CUT_WORDS and "header" not in words \
                or tag == "article" and not self.at.article:
            return False
        if role:
            return True
        if words & CUT_WORDS:
            strong = words & {"comment", "comments", "ad", "ads", "sidebar", "nav", "menu"}
            return bool(strong) or not words & KEEP_WORDS
        return not words & KEEP_WORDS and tag != "article" and not (self.at.article or self.at.main)

    def _close(self, tags, stop) -> None:
        """End the nearest open element among ``tags``, looking no further up than ``stop``."""
        n = self._deepest(tags)
        if n.depth > self._deepest(stop).depth:
            self._leave(n.parent)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag == "body":
            self._leave(self.root)
        if tag in ("article", "main"):  # a menu or header left open ends here
            n = self.at
            while n is not self.root and n.tag in ("nav", "header", "footer", "ul", "ol", "li", "a", "p", "span"):
                n = n.parent
                if n.tag in ("body", "html", "div", "main"):
                    self._leave(n)
        if tag in CLOSES_P:
            self._close({"p"}, {"td", "th", "li", "button", "article", "section", "div", "body"})
        for open_tag, (starts, stop) in ENDS.items():
            if tag in starts:
                self._close({open_tag}, stop)
        node = Node(tag, self.at, self.at.cut or self._cut(tag, attrs))
        node.doubt = not node.cut and self._doubt(tag, attrs)
        self.at.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.at = node
            self.open.setdefault(tag, []).append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("path", "use", "circle", "rect"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        held = self.open.get(tag)
        # an inline end tag doesn't end a block
        if held and (tag in BLOCKS or held[-1].depth > self.at.block):
            self._leave(held[-1].parent)

    def handle_data(self, data):
        if not self.at.cut:
            self.at.children.append(data)


def _settle(nodes: list[Node]) -> None:
    """Cut the elements in doubt, except those that wrap the page; density judges what is in these.

    A wrapper holds the page's main element, or the only article that no other article holds, or most
    of the page's characters outside links; the last doesn't count beside a main element or article.
    """
    plain: dict[Node, int] = {}
    for n in reversed(nodes):
        if not n.cut and n.tag != "a":
            plain[n] = sum(len("".join(c.split())) if isinstance(c, str) else plain.get(c, 0) for c in n.children)
    mains = [n for n in nodes if n.tag == "main" and plain.get(n)]
    outer = [n for n in nodes if n.tag == "article" and plain.get(n) and not n.parent.article]
    wrappers = _holders(mains + (outer if len(outer) == 1 else []))
    marked = _holders(mains + outer)
    for n in nodes:
        if n.doubt and n not in wrappers:
            beside = marked and n not in marked and not (n.parent.article or n.parent.main)
            n.cut = bool(beside) or 2 * plain.get(n, 0) <= plain[nodes[0]]
        n.cut = n.cut or n.parent is not None and n.parent.cut


def _holders(nodes: list[Node]) -> set[Node]:
    """The nodes and all their ancestors."""
    out: set[Node] = set()
    for n in nodes:
        while n is not None and n not in out:
            out.add(n)
            n = n.parent
    return out


def _count(n: Node) -> None:
    """Characters and tags of a node from its measured children."""
    for c in n.children:
        if isinstance(c, str):
            n.chars += len("".join(c.split()))
        elif not c.cut:
            n.chars += c.chars
            n.tags += c.tags + 1
            n.links += c.links
            n.link_tags += c.link_tags + (c.tag == "a")
    if n.tag == "a":
        n.links = n.chars


def _measure(nodes: list[Node]) -> Node:
    """Fill in counts, densities and sums; children stand behind their parents in ``nodes``."""
    for n in reversed(nodes):
        if n.cut:
            continue
        _count(n)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    if not body.chars:
        body = nodes[0]
    ratio = body.links / max(body.chars, 1)
    for n in nodes:
        if n.cut or not n.chars:
            continue
        n.density = _dense(n, ratio)
        if n.parent is not None:
            n.parent.total += max(n.density, 0.0)
    return body


def _dense(n: Node, ratio: float) -> float:
    """Composite text density of a node with text."""
    t, lc, lt = max(n.tags, 1), max(n.links, 1), max(n.link_tags, 1)
    base = math.log(n.chars / max(n.chars - n.links, 1) * n.links + ratio * n.chars + math.e)
    return n.chars / t * math.log(n.chars / lc * t / lt) / max(math.log(base), LEAST_LOG)


def _branches(n: Node, path: Node) -> list[list]:
    """The children of a node: blocks and ``path`` alone, text and inline elements between them together."""
    out: list[list] = []
    run = False
    for c in n.children:
        block = c is path or not isinstance(c, str) and c.tag in BLOCKS
        if block or not run:
            out.append([])
        out[-1].append(c)
        run = not block
    return out


def _joined(branch: list) -> Node:
    """A branch as one node: the block itself, or a run of text and inline elements counted together."""
    if len(branch) == 1 and not isinstance(branch[0], str):
        return branch[0]
    n = Node("", None, False)
    n.children = branch
    _count(n)
    return n


def _select(nodes: list[Node], body: Node) -> tuple[Node, Node, dict[Node, list], float]:
    """The body, the subtree of the largest density sum, what stays of its ancestors, and the threshold.

    Each ancestor up to the body is mapped to the children that stay: the branch that leads to the
    subtree, branches as dense as the threshold, and headings right before a branch that stays. The
    root takes the body's place if the subtree stands outside it.
    """
    best = body
    for n in nodes:
        if not n.cut and n.tag in BLOCKS and n.total > best.total:
            best = n
    threshold, n = best.density, best
    while n is not body and n.parent is not None:
        n = n.parent
        threshold = min(threshold, n.density)
    n = best
    while n is not body and n.tag != "article" and n.parent is not None:
        n = n.parent
    if n.tag == "article" and n is not body:
        best = n
    ratio = body.links / max(body.chars, 1)
    kept: dict[Node, list] = {}
    n = best
    while n is not body and n.parent is not None:
        up, stay, after = n.parent, [], False
        for branch in reversed(_branches(up, n)):
            x = _joined(branch)
            if x.cut or not x.chars:
                continue
            after = x is n or _dense(x, ratio) >= threshold or after and x.tag in HEADINGS
            if after:
                stay.append(branch)
        kept[up] = [c for branch in reversed(stay) for c in branch]
        n = up
    return n, best, kept, threshold


def _blocks(top: Node, best: Node, kept: dict[Node, list], threshold: float) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def end():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = [(top, False)]
    while stack:
        x, done = stack.pop()
        if isinstance(x, str):
            run.append(x)
            continue
        block = x.tag in BLOCKS
        if done:
            if block:
                end()
            continue
        if x.tag == "br":
            run.append("\n")
            continue
        if x.cut:
            if block:
                end()
            continue
        if block and x is not best and x not in kept and x.links >= LINK_SHARE * x.chars and x.chars and x.density < threshold \
                and x.link_tags > 1:
            end()
            continue
        if block:
            end()
        stack.append((x, True))
        stack.extend((c, False) for c in reversed(kept.get(x, x.children)))
    end()
    return out


def extract_text(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    for doubt in (True, False):  # if nothing is left, once more without the cuts in doubt
        b = _Builder()
        b.read(html)
        if doubt:
            _settle(b.nodes)
        body = _measure(b.nodes)
        if body.chars and not body.cut:
            return "\n\n".join(_blocks(*_select(b.nodes, body)))
    return ""


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches):
    for ids, urls, htmls in rows_of(batches, "page_id", "url", "html"):
        rows, size = [], 0
        for i, u, h in zip(ids, urls, htmls):
            t = extract_text(h)
            rows.append((i, u, t, len(t)))
            size += len(t)
            if size > OUT_BYTES:
                yield batch(_TEXT, **dict(zip(_TEXT.names, map(list, zip(*rows)))))
                rows, size = [], 0
        if rows:
            yield batch(_TEXT, **dict(zip(_TEXT.names, map(list, zip(*rows)))))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars; one pass over the scan, no shuffle."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return src.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
