"""HTML extraction that keeps the layout of visible text.

``parse`` builds the element tree of a page, adding the tags that HTML lets
authors leave out (ends of paragraphs, list items, cells and rows, rows of
tables) and ignoring stray ends. ``render`` walks the tree and emits every
visible text: white space is collapsed as browsers do, blocks stand on lines
of their own, paragraphs and headings with a blank line between, list items
behind their marker with nesting indented, preformatted text as it is, and
table cells in aligned columns (spans included, the last column not padded).

Invisible are scripts, styles, templates, the head, comments, ``hidden``
elements, those styled ``display:none`` or ``visibility:hidden``, inputs that
show no text (hidden, passwords, files, check boxes and the like), lists of
suggestions (``datalist``), titles, descriptions and definitions of diagrams,
annotations of formulas, and what browsers replace (``noscript``, media
fallbacks). Formulas, text of diagrams, options, the content of text areas and
the value or label of buttons and fields are visible.

One page at a time in a task, no shuffle; no recursion, so nesting of any
depth is fine. Defined results: NULL or empty html gives the empty text;
repeated rows are rendered each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import relation

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style template head title meta link noscript iframe noembed noframes object video audio "
                   "canvas datalist".split())
# Not shown inside a diagram or a formula.
UNSEEN_IN = {"svg": frozenset("title desc defs metadata symbol clippath mask pattern marker".split()),
             "math": frozenset("annotation annotation-xml mphantom".split())}
STACKED = frozenset("mfrac mroot mtr mtd munder mover munderover".split())    # parts of a formula that stand apart
# Kinds of input whose value is no text on the page.
NO_INPUT = frozenset("hidden password file checkbox radio color range image".split())
IN_HEAD = frozenset("html head title meta link style script base noscript template".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                   "search section summary table tbody td tfoot th thead tr ul caption option optgroup".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl figure ul ol menu dir table hr".split())
CLOSES_P = BLOCKS - frozenset("html body td th tr tbody thead tfoot caption option optgroup legend".split())
LISTS = frozenset("ul ol menu dir".split())

# A start closes open elements of the second set, looked for up to the third.
CLOSED_BY = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"optgroup"}, {"select", "datalist"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
P_SCOPE = frozenset("table td th caption button object html template".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
MAX_SPAN = 1000          # as in HTML


class Node:
    __slots__ = ("tag", "attributes", "children", "foreign")

    def __init__(self, tag: str, attributes: str = "", foreign: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.foreign = foreign           # svg, text (in an svg) or math around or at the element

    def attribute(self, name: str) -> str | None:
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


def parse(html: str) -> Node:
    """The element tree; text nodes are strings (character references kept)."""
    root = Node("#root")
    stack = [root]
    at = 0

    def close(tags: set | frozenset, bounds: set | frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    def start(tag: str, attributes: str) -> None:
        if len(stack) > 1 and stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in CLOSES_P:
            close({"p"}, P_SCOPE)
        if tag in CLOSED_BY:
            close(*CLOSED_BY[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                start("tr", "")
        around = stack[-1].foreign
        if tag in UNSEEN_IN:
            around = tag
        elif around in ("svg", "text") and tag in ("text", "foreignobject"):
            around = "text" if tag == "text" else ""
        node = Node(tag, attributes, around)
        stack[-1].children.append(node)
        if tag not in VOID:
            stack.append(node)

    while at < len(html):
        m = TOKEN.search(html, at)
        if not m:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue                                    # comment, doctype, instruction
        tag = m[2].lower()
        if not m[1]:
            start(tag, m[3])
            if tag not in VOID and stack[-1].foreign and m[3].rstrip().endswith("/"):
                stack.pop()                             # in diagrams and formulas an element can close itself
            elif tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                stack[-1].children.append(html[at:end.start() if end else len(html)])
                at = end.end() if end else len(html)
                stack.pop()
        elif tag == "br":
            start("br", "")
        else:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                start("p", "")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag not in BLOCKS and any(n.tag in BLOCKS for n in stack[i + 1:]):
                        break                           # an inline end inside a later block
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in ("td", "th", "tr", "table", "tbody", "thead",
                                                                          "tfoot", "html", "body"):
                    break                               # ends do not reach out of a cell
    return root


def _kind(node: Node) -> str:
    return (node.attribute("type") or "text").strip().lower()


def field_text(node: Node) -> str:
    """What an input shows: its value, or the placeholder of an empty field."""
    return node.attribute("value") or ("" if _kind(node) in ("button", "submit", "reset")
                                       else node.attribute("placeholder") or "")


def hidden(node: Node) -> bool:
    if node.tag in UNSEEN or node.foreign and node.tag in UNSEEN_IN["math" if node.foreign == "math" else "svg"]:
        return True
    if not node.attributes or node.attributes.isspace():
        return False
    if node.tag == "input" and _kind(node) in NO_INPUT:
        return True
    low = node.attributes.lower()
    if "hidden" in low and node.attribute("hidden") is not None:
        return True
    return "style" in low and bool(HIDING.search(node.attribute("style") or ""))


class Canvas:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.margin = 0                  # blank lines wanted before the next line
        self.first, self.rest = [], []   # prefixes of the next line and of the lines after it

    def text(self, value: str, preformatted: bool = False) -> None:
        if preformatted:
            parts = value.replace("\r\n", "\n").split("\n")
            for i, part in enumerate(parts):
                self.line += part
                if i < len(parts) - 1:
                    self.newline(keep=True)
            return
        value = SPACE.sub(" ", value)
        if not self.line or self.line[-1] == " ":
            value = value.removeprefix(" ")
        self.line += value

    def newline(self, keep: bool = False) -> None:
        """End the line; an empty one is kept only where asked for."""
        line = self.line.rstrip(" ")
        self.line = ""
        if not line and not keep:
            return
        if self.margin and self.lines:
            self.lines += [""] * self.margin
        self.margin = 0
        prefix = "".join(self.first)
        self.first = [" " * len(p) for p in self.first] if self.first else []
        self.lines.append((prefix + line).rstrip(" ") if line else "")

    def block(self, blank: bool) -> None:
        self.newline()
        if blank:
            self.margin = 1

    def result(self) -> list[str]:
        self.newline()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def lines(self) -> list[str]:
        """Rows in aligned columns, two blanks apart."""
        grid, taken = [], {}
        for r, row in enumerate(self.rows):
            column, placed = 0, []
            for lines, across, down in row:
                while (r, column) in taken:
                    column += 1
                placed.append((column, across, lines))
                for d in range(1, min(down, len(self.rows) - r)):
                    taken.update({(r + d, column + a): True for a in range(across)})
                column += across
            grid.append(placed)
        width: dict[int, int] = {}
        for placed in grid:
            for column, across, lines in placed:
                if across == 1:
                    width[column] = max(width.get(column, 0), *(len(x) for x in lines), 0)
        for placed in grid:                                    # wide cells widen their last column
            for column, across, lines in placed:
                if across > 1:
                    have = sum(width.get(column + a, 0) for a in range(across)) + 2 * (across - 1)
                    need = max((len(x) for x in lines), default=0)
                    if need > have:
                        last = column + across - 1
                        width[last] = width.get(last, 0) + need - have
        out = []
        for placed in grid:
            for k in range(max((len(lines) for _, _, lines in placed), default=0)):
                line = ""
                for column, _, lines in placed:
                    if k < len(lines) and lines[k]:
                        at = sum(width.get(c, 0) + 2 for c in range(column))
                        line = line.ljust(at) + lines[k]
                out.append(line.rstrip())
        return out


def _span(node: Node, name: str) -> int:
    value = (node.attribute(name) or "1").strip()
    return min(max(int(value), 1), MAX_SPAN) if value.isdigit() and len(value) < 9 else 1


def render(root: Node) -> str:
    canvases, tables, lists = [Canvas()], [], []
    preformatted = 0
    work: list = [(root, True)]
    while work:
        node, entering = work.pop()
        page = canvases[-1]
        if isinstance(node, str):
            page.text(unescape(node), bool(preformatted))
            continue
        tag = node.tag
        if entering:
            if hidden(node):
                continue
            if tag == "br":
                page.newline(keep=True)
                continue
            if tag == "input":
                if shown := field_text(node):
                    page.text(f" {shown} ")
                continue
            children = node.children
            if tag == "textarea":
                children = [c.removeprefix("\n") for c in children]
                if not any(children):
                    page.text(f" {node.attribute('placeholder') or ''} ")
                preformatted += 1
            elif tag == "optgroup" or tag == "option":
                label = node.attribute("label")
                if label:
                    page.newline()
                    page.text(label)
                    page.newline()
                    children = children if tag == "optgroup" else []
            elif node.foreign == "svg":
                children = [c for c in children if not isinstance(c, str)]     # only its text elements show text
            elif tag == "text" and node.foreign or tag == "tspan" and node.attributes:
                page.text(" ")
            elif tag in STACKED and node.foreign == "math":
                children = [x for c in children for x in (c, " ")]
            if tag in ("td", "th"):
                canvases.append(Canvas())
            elif tag == "tr":
                if tables:
                    tables[-1].rows.append([])
            elif tag in BLOCKS:
                page.block(tag in SPACED and not (tag in LISTS and lists))
                if tag == "table":
                    tables.append(Table())
                elif tag in LISTS:
                    start = node.attribute("start") if tag == "ol" else None
                    lists.append([tag, int(start) if start and start.lstrip("-").isdigit() and len(start) < 9 else 1])
                    page.first.append("")
                elif tag == "li":
                    marker = "- "
                    if lists and lists[-1][0] == "ol":
                        marker = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    page.first.append(marker)
                elif tag == "dd":
                    page.first.append("  ")
                elif tag == "blockquote":
                    page.first.append("> ")
                elif tag == "pre":
                    preformatted += 1
            work.append((node, False))
            work.extend((child, True) for child in reversed(children))
            continue
        if tag == "textarea":
            preformatted -= 1
        elif tag == "text" and node.foreign:
            page.text(" ")
        elif tag in ("td", "th"):
            lines = canvases.pop().result()
            if tables and tables[-1].rows:
                tables[-1].rows[-1].append((lines, _span(node, "colspan"), _span(node, "rowspan")))
            else:
                canvases[-1].text("\n".join(lines))
        elif tag == "table":
            for line in tables.pop().lines():
                page.line = line
                page.newline(keep=True)
            page.block(True)
        elif tag in BLOCKS and tag != "tr":
            page.newline()
            if tag in LISTS:
                lists.pop()
                page.first.pop()
            elif tag in ("li", "dd", "blockquote"):
                page.first.pop()
            elif tag == "pre":
                preformatted -= 1
            page.block(tag in SPACED and not (tag in LISTS and lists))
    lines = canvases[0].result()
    return "\n".join(lines).strip("\n").replace("\xa0", " ")


def visible_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract_layout(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
                   ) -> DataFrame:
    """page_id, url and the visible text of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).mapInArrow(run, "page_id long, url string, text string")


def op8_html_layout(spark, sf_dir):
    return extract_layout(relation(spark, sf_dir, "pages"))


QUERIES = {"op8_html_layout": op8_html_layout}
ORACLE = {}
