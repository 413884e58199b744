"""Visible text of web pages, laid out as a reader sees it.

A tree is built from the tags, with the tags that HTML implies: a new block ends an
open paragraph, a new item, row, cell or option ends the one before, and what ends
an element ends all that is open within it. Elements that are never shown (head,
script, style and the like, hidden inputs, ``hidden``, ``display:none``) are left out
with all they hold; under ``visibility:hidden`` what is made visible again is shown.
Formulas are shown but for their annotations, and of drawings the labels (``text``)
and embedded HTML. The tree is then rendered:
white space collapses except in ``pre``, blocks start on a line of their own,
paragraphs, headings, lists and tables stand between blank lines, list items carry
their mark and are indented by depth, and table cells are filled up so that columns
line up, those under a cell of several columns or rows too. Of a closed ``details`` the
summary is shown, a closed ``dialog`` not. All visible text is kept; nothing is judged as
boilerplate.

Both steps use explicit stacks, so depth is no limit, and a tag costs the same at any
depth; a page that ends inside a tag is read once. Defined results: NULL gives
NULL, an empty page or one without visible text the empty string; broken markup is
read as text where it can't be a tag. Repeated rows are kept. The added column
replaces one of the same name, all others are kept.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import per_text

# Element names and their roles in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title".split())
UNSEEN = frozenset(
    "head script style title noscript template iframe object audio video canvas datalist "
    "annotation annotation-xml mphantom".split()
)
UNDRAWN = frozenset(  # of a drawing
    "defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()
)
FOREIGN = frozenset(("svg", "math"))
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
# Opening tags that end a drawing or formula left open.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
    "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
BLOCKS = SPACED | frozenset(
    "html body div article section nav aside header footer main form fieldset address details "
    "summary figcaption li dt dd tr td th caption thead tbody tfoot hr option legend".split()
)
ENDS_P = BLOCKS - frozenset("html body td th tr caption thead tbody tfoot option".split())
CELLS = frozenset(("td", "th"))
BORDER = frozenset(("table", "foreignobject"))  # closing tags reach no further,
FREE = frozenset(("table", "body", "svg", "foreignobject"))  # but for these
GROUPS = frozenset(("thead", "tbody", "tfoot"))
# An opening tag ends the open elements on the right, up to the border after it.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "td": (CELLS, frozenset(("table",))),
    "th": (CELLS, frozenset(("table",))),
    "tr": (CELLS | {"tr"}, frozenset(("table",))),
    "thead": (CELLS | GROUPS | {"tr"}, frozenset(("table",))),
    "tbody": (CELLS | GROUPS | {"tr"}, frozenset(("table",))),
    "tfoot": (CELLS | GROUPS | {"tr"}, frozenset(("table",))),
    "body": (frozenset(("head",)), frozenset()),
}
IN_HEAD = frozenset("base link meta script style title noscript template".split())

TAG = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*>"
    # A ">" in quotes doesn't end a tag, unless no other is left. Nothing is matched twice.
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+(?=>)|[^>]*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/$")
STYLE = re.compile(r"(?<![\w-])(display|visibility|content-visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
COLUMNS, ROWS = 1000, 65_534  # the largest spans
GAP = 2  # blanks between columns
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "inside", "foreign")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name = name
        self.attributes = attributes or {}
        self.inside: list[Node | str] = []
        self.foreign = ""  # svg or math, of such an element and what is below it


class Open:
    """The open elements, outermost first, with the depths at which each name stands.

    So no closing tag looks through the elements that stay open.
    """

    def __init__(self, root: Node):
        self.nodes = [root]
        self.depths: dict[str, list[int]] = {}  # the root's is left out: it can't be closed

    @property
    def last(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.name, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """End the element at ``depth`` and all within it."""
        for node in self.nodes[depth:]:
            self.depths[node.name].pop()
        del self.nodes[depth:]

    def drop(self) -> None:
        self.cut(len(self.nodes) - 1)

    def innermost(self, names: Iterable[str]) -> int:
        """Depth of the innermost element of these names, 0 without any."""
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def close(self, names: frozenset[str], border: frozenset[str]) -> None:
        """End the outermost of ``names`` within the innermost of ``border``."""
        edge = self.innermost(border)
        found = []
        for name in names:
            depths = self.depths.get(name, [])
            at = bisect_right(depths, edge)
            found += depths[at : at + 1]
        if found:
            self.cut(min(found))

    def close_one(self, name: str, border: frozenset[str]) -> None:
        """End the innermost open ``name``, and all within it, if no border is in between."""
        depth = self.innermost((name,))
        if depth and depth >= self.innermost(border):
            self.cut(depth)


def tree(page: str) -> Node:
    """The element tree of a page."""
    root = Node("html")
    opened = Open(root)
    at, last_end = 0, page.rfind(">")

    def text(part: str) -> None:
        if part:
            if opened.last.name == "head" and part.strip():
                opened.drop()  # text can't be in the head
            opened.last.inside.append(unescape(part))

    while at <= last_end and (found := TAG.search(page, at)) is not None:
        text(page[at : found.start()])
        at = found.end()
        if found["data"] is not None:
            opened.last.inside.append(found["data"])
        if not found["name"]:
            continue
        name = found["name"].lower()
        if found["end"]:
            if name == "p" and not opened.depths.get("p"):
                opened.last.inside.append(Node("p"))
            elif name != "html":
                opened.close_one(name, frozenset() if name in FREE else BORDER)
            continue
        if opened.last.name == "head" and name not in IN_HEAD:
            opened.drop()
        if name in ENDS_FOREIGN:
            while opened.last.foreign and opened.last.name not in HTML_AGAIN:
                opened.drop()
        if name in ENDS_P:
            opened.close_one("p", BORDER | {"button"})
        if name in IMPLIED:
            opened.close(IMPLIED[name][0], IMPLIED[name][1] | {"foreignobject"})
        attributes = {
            m[1].lower(): unescape(m[2] or m[3] or m[4] or "")
            for m in ATTRIBUTE.finditer(found["rest"])
        }
        node = Node(name, attributes)
        if name == "html":
            root.attributes = attributes | root.attributes
            continue
        above = opened.last
        above.inside.append(node)
        node.foreign = name if name in FOREIGN else "" if above.name in HTML_AGAIN else above.foreign
        if node.foreign and found["rest"].endswith("/") and not UNQUOTED.search(found["rest"]):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            raw = page[at : end.start() if end else len(page)]
            node.inside.append(unescape(raw) if name in ("textarea", "title") else raw)
            at = end.end() if end else len(page)
        elif name not in VOID:
            opened.push(node)
    comment = page.find("<!--", at)  # behind the last tag; one that is not closed takes the rest
    text(page[at : comment if comment >= 0 else len(page)])
    return root


def shown(node: Node, style: dict[str, str]) -> bool:
    if node.name in UNSEEN or "hidden" in node.attributes:
        return False
    if node.name == "dialog" and "open" not in node.attributes:
        return False
    if node.foreign == "svg" and node.name in UNDRAWN:
        return False
    if node.name == "input" and node.attributes.get("type", "").lower() == "hidden":
        return False
    if style.get("visibility") == "collapse" and node.name in GROUPS | {"tr"}:
        return False
    return style.get("display") != "none" and style.get("content-visibility") != "hidden"


def style_of(node: Node) -> dict[str, str]:
    """What the element itself says of its visibility."""
    given = node.attributes
    said = {k: given[k].strip().lower() for k in ("display", "visibility") if node.foreign == "svg" and k in given}
    return said | {m[1].lower(): m[2].lower() for m in STYLE.finditer(given.get("style", ""))}


class Page:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now = ""
        self.gap = False  # a blank line is due before the next text
        self.blank = 0  # blank lines of preformatted text that are due
        self.mark = ""  # of a list item that has no text yet
        self.indent = ""

    def add(self, text: str, kept: bool) -> None:
        if kept:
            first, *more = text.split("\n")
            self._put(first)
            for line in more:
                if not self.now:
                    self.blank += 1
                self.end()
                self._put(line)
            return
        text = BLANKS.sub(" ", text)
        if not self.now or self.now.endswith(" "):
            text = text.lstrip(" ")
        self._put(text)

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.now:
            if self.lines:
                self.lines += [""] * max(int(self.gap), self.blank)
            self.gap, self.blank = False, 0
            self.now = self.indent + self.mark
            self.indent += " " * len(self.mark)
            self.mark = ""
        self.now += text

    def end(self) -> None:
        if self.now:
            self.lines.append(self.now.rstrip())
            self.now = ""

    def space(self) -> None:
        self.end()
        self.gap = True

    def text(self) -> list[str]:
        self.end()
        return self.lines


@dataclass
class Cell:
    lines: list[str]
    wide: int = 1  # columns it takes
    high: int = 1  # rows


def _span(given: str, most: int) -> int:
    return min(max(int(given), 1), most) if given.isdecimal() and len(given) < 10 else 1


def grid(rows: list[list[Cell]]) -> list[str]:
    """Lines of a table whose columns line up.

    A cell that spans columns starts in its first and pushes the last apart if it is
    wider than all; one that spans rows keeps its columns free below it. Beyond column
    COLUMNS a cell takes one column.
    """
    taken: dict[int, int] = {}  # rows, this one included, for which a column is still taken
    placed: list[list[tuple[int, Cell]]] = []
    for row in rows:
        at, here = 0, []
        for cell in row:
            while taken.get(at):
                at += 1
            here.append((at, cell))
            wide = cell.wide if at + cell.wide <= COLUMNS else 1
            cell.wide = wide
            if cell.high > 1:
                taken.update(dict.fromkeys(range(at, at + wide), cell.high))
            at += wide
        placed.append(here)
        taken = {c: left - 1 for c, left in taken.items() if left > 1}
    columns = max((at + cell.wide for here in placed for at, cell in here), default=0)
    begun = {at for here in placed for at, _ in here}
    gaps = [GAP if i and i in begun else 0 for i in range(columns)]  # before each column in which a cell starts
    widths = [0] * columns
    every = sorted((cell.wide, at, max(map(len, cell.lines), default=0)) for here in placed for at, cell in here)
    for wide, at, needed in every:
        held = sum(widths[at : at + wide]) + sum(gaps[at + 1 : at + wide])
        widths[at + wide - 1] += max(0, needed - held)
    start = [0] * columns
    for i in range(1, columns):
        start[i] = start[i - 1] + widths[i - 1] + gaps[i]
    out = []
    for here in placed:
        for k in range(max((len(cell.lines) for _, cell in here), default=0)):
            line = ""
            for at, cell in here:
                if k < len(cell.lines):
                    line = line.ljust(start[at]) + cell.lines[k]
            out.append(line.rstrip())
    return out


def displayed(node: Node) -> bool:
    """Whether a part of a formula stands on a line of its own."""
    if node.foreign != "math":
        return False
    return node.name == "mtr" or node.name == "math" and node.attributes.get("display", "").lower() == "block"


def rendered(root: Node) -> str:
    """All visible text of a tree, laid out."""
    pages = [Page()]
    tables: list[list[list[Cell]]] = []
    lists: list[list] = []  # kind and number of each open list
    indents: list[str] = []
    kept = 0
    labels: list[int] = []  # of each open drawing, so far
    # With each node: whether it is left, is visible, and is of a drawing but not of a label.
    todo: list[tuple[Node | str, bool, bool, bool]] = [(root, False, True, False)]
    while todo:
        node, leaving, visible, drawn = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if visible and not drawn:
                page.add(node, kept > 0)
            continue
        name = node.name
        if leaving:
            if name in CELLS and tables:
                wide, high = (node.attributes.get(k, "") for k in ("colspan", "rowspan"))
                tables[-1][-1].append(Cell(pages.pop().text(), _span(wide, COLUMNS), _span(high, ROWS)))
                continue
            if name == "table":
                for line in grid(tables.pop()):
                    page.end()
                    page.add(line or "\n", True)
            elif name in ("ul", "ol", "li", "blockquote"):
                if name in ("ul", "ol"):
                    lists.pop()
                page.end()
                page.indent, page.mark = indents.pop(), ""
            elif name == "pre":
                kept -= 1
            elif name == "svg":
                labels.pop()
            if name in SPACED and not (name in ("ul", "ol") and lists):
                page.space()
            elif name in BLOCKS or displayed(node):
                page.end()
            continue
        style = style_of(node)
        if not shown(node, style):
            continue
        if (said := style.get("visibility")) in ("hidden", "collapse", "visible", "initial"):
            visible = said in ("visible", "initial")
        if name == "br":
            if page.now:
                page.end()
            continue
        if name == "img":
            page.add(node.attributes.get("alt", "") if visible else "", False)
            continue
        if name == "input":
            page.add(node.attributes.get("value", "") if visible else "", False)
            continue
        if name in CELLS and tables:
            if not tables[-1]:
                tables[-1].append([])
            pages.append(Page())
        elif name == "tr" and tables:
            tables[-1].append([])
        elif name in SPACED and not (name in ("ul", "ol") and lists):
            page.space()
        elif name in BLOCKS or displayed(node):
            page.end()
        if name == "svg":
            labels.append(0)
            drawn = True
        elif node.foreign == "svg" and name in ("text", "foreignobject"):
            if labels[-1]:
                page.add(" ", False)
            labels[-1] += 1
            drawn = False
        if name == "table":
            tables.append([])
        elif name in ("ul", "ol"):
            start = node.attributes.get("start", "")
            lists.append([name, int(start) if start.isdecimal() else 1])
            indents.append(page.indent)
            page.indent += page.mark and " " * len(page.mark)
            page.mark = ""
        elif name == "li":
            indents.append(page.indent)
            if lists and lists[-1][0] == "ol":
                page.mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            else:
                page.mark = "- "
        elif name == "blockquote":
            indents.append(page.indent)
            page.indent += "  "
        elif name == "pre":
            kept += 1
        todo.append((node, True, visible, drawn))
        parts = node.inside
        if name == "details" and "open" not in node.attributes:
            parts = [part for part in parts if isinstance(part, Node) and part.name == "summary"][:1]
        if node.foreign == "math" and name in ("mfrac", "mtr"):
            parts = [part for inside in parts for part in (inside, " ")]
        todo.extend((inside, False, visible, drawn) for inside in reversed(parts))
    return "\n".join(pages[0].text())


def visible_text(page: str | None) -> str | None:
    return None if page is None else rendered(tree(page))


def extracted(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add the visible text of every page."""
    text = per_text(lambda: lambda page: (visible_text(page),), T.StructType([T.StructField("text", T.StringType())]))
    return pages.withColumn(name, text(F.col(html).cast("string"))["text"])
