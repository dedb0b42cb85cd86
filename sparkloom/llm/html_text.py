"""HTML extraction by layout-aware rendering.

A small tree builder follows the rules that matter for text: void elements, end tags implied
by the next start tag (paragraphs, list items, table parts), and misnested end tags. Elements
that a browser does not show (scripts, styles, templates, ``hidden``, ``display:none``, closed
details) are left out; everything visible is emitted in document order. Blocks start on their
own line, paragraphs, headings, lists and tables keep a blank line around them, list items get
bullets or numbers and indentation, preformatted text keeps its spacing, and table cells are
aligned in columns.

Text of drawings and formulas is shown but for their titles and descriptions. Each page is
rendered on its own in Arrow batches. Nesting beyond ``DEPTH`` continues as siblings, as in
browsers; what is hidden stays hidden there. A table that already has the output column is
refused by name. Empty and edge input: NULL gives NULL, empty input and pages without
visible text give the empty string, repeated rows are each answered.
"""

from __future__ import annotations

import html
import re
import sys
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sparkloom.llm.tables import extended, refuse_clash

DEPTH = 400
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template noscript title iframe object canvas audio video datalist".split())
# parts of drawings and formulas that are not shown, unlike their other text
FOREIGN, FOREIGN_HIDDEN = {"svg", "math"}, set("desc defs metadata annotation annotation-xml".split())
# the only start tags that leave a head open
IN_HEAD = set("base basefont bgsound link meta title noscript noframes style script template head".split())
RAW = set("script style textarea title xmp iframe noscript".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure address fieldset hr".split())
BLOCK = SPACED | set(
    "html body div section article aside header footer main nav li dt dd form details summary "
    "figcaption caption tr td th thead tbody tfoot legend center option".split()
)
# a start tag closes these open elements, looking no further up than the second set
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_SCOPE = {"table", "td", "th", "caption", "button", "object"}
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    children: list = field(default_factory=list)
    off: bool = False  # it, or an element around it, is not shown


def build(source: str) -> Node:
    """Parse into a tree; text children are plain strings."""
    root = Node("#root", {})
    stack, at = [root], 0
    while at < len(source):
        m = _MARK.search(source, at)
        if m is None:
            break
        if m.start() > at:
            _text(stack, source[at : m.start()])
        at = m.end()
        if m[1]:
            _end(stack, m[1].lower())
        elif m[2] or m[4]:
            tag = (m[2] or m[4]).lower()
            rest = m[3] if m[2] else m[5]
            attrs = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTR.finditer(rest)}
            _start(stack, Node(tag, attrs))
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                body = source[at : close.start() if close else len(source)]
                at = close.start() if close else len(source)
                if tag in ("textarea", "xmp"):
                    stack[-1].children.append(body)
    if at < len(source):
        _text(stack, source[at:])
    return root


def _text(stack, raw):
    text = html.unescape(raw)
    if stack[-1].tag == "head" and text.strip():
        stack.pop()  # text ends the head
    stack[-1].children.append(text)


def _close(stack, tags, until):
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in until:
            return
        if stack[i].tag in tags:
            # everything inside goes with it, and so do outer ones of the same kind
            del stack[i:]
            _close(stack, tags, until)
            return


def _start(stack, node):
    if node.tag in CLOSES:
        _close(stack, *CLOSES[node.tag])
    elif stack[-1].tag == "head" and node.tag not in IN_HEAD:
        stack.pop()
    if node.tag in BLOCK - {"li", "dt", "dd", "td", "th", "tr", "option"}:
        _close(stack, {"p"}, _SCOPE)
    if node.tag in FOREIGN_HIDDEN and any(n.tag in FOREIGN for n in stack):
        node.attrs["hidden"] = ""
    node.off = stack[-1].off or hidden(node)
    stack[-1].children.append(node)
    # what is not shown keeps its own nesting at any depth: it is never rendered
    if node.tag not in VOID and (len(stack) < DEPTH or node.off):
        stack.append(node)


def _end(stack, tag):
    if tag == "br":
        stack[-1].children.append(Node("br", {}))
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in ("table", "td", "th") and tag not in ("table", "tr", "td", "th", "thead", "tbody", "tfoot", "body", "html"):
            return  # an inline end tag does not reach out of its cell


def hidden(node: Node) -> bool:
    a = node.attrs
    return (
        node.tag in HIDDEN or "hidden" in a or bool(_HIDING.search(a.get("style", "")))
        or (node.tag == "dialog" and "open" not in a)
    )


class Lines:
    """Output under construction: finished lines, and the inline run that is still open."""

    def __init__(self):
        self.done: list[str] = []
        self.run: list[str] = []
        self.gap = False  # a blank line is due before the next line

    def inline(self, text: str, pre: bool = False):
        if pre:
            parts = text.split("\n")
            for part in parts[:-1]:
                self.run.append(part)
                self.line(pre=True)
            self.run.append(parts[-1])
        else:
            self.run.append(re.sub(r"[ \t\n\r\f]+", " ", text))

    def line(self, pre: bool = False, force: bool = False):
        text = "".join(self.run)
        self.run = []
        if not pre:
            text = re.sub(" +", " ", text).strip(" ")
        if text or pre or force:
            self.add([text])

    def add(self, lines: list[str]):
        if self.gap and self.done:
            self.done.append("")
        self.gap = False
        self.done += lines

    def space(self):
        self.line()
        self.gap = True


def _span(cell: Node, name: str, most: int) -> int:
    found = re.match(r"\s*(\d{1,6})", cell.attrs.get(name, ""), re.A)
    return min(max(int(found[1]), 1), most) if found else 1


def _table(node: Node) -> list[str]:
    """Rows of cells, each cell rendered on its own, padded to its column's width. Columns that
    a cell of an earlier row spans stay free."""
    captions, rows, todo = [], [], list(reversed(node.children))
    loose = []
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            loose += [x] if x.strip() else []
        elif hidden(x):
            continue
        elif x.tag in ("thead", "tbody", "tfoot", "colgroup"):
            todo += reversed(x.children)
        elif x.tag == "caption":
            captions += lines_of(x.children)
        elif x.tag == "tr":
            rows.append([c for c in x.children if isinstance(c, Node) and not hidden(c)])
            loose += [c for c in x.children if isinstance(c, str) and c.strip()]
        elif x.tag in ("td", "th"):
            rows.append([x])
        else:
            loose.append(x)
    grid, width, taken = [], [], {}  # taken: rows that a column is still spanned for
    for row in rows:
        cells, column, spans = [], 0, {}
        for cell in row:
            while taken.get(column, 0) > 0:
                column += 1
            lines, span = lines_of(cell.children), _span(cell, "colspan", 50)
            cells.append((column, lines))
            if span == 1:
                width += [0] * (column + 1 - len(width))
                width[column] = max([width[column], *map(len, lines)])
            below = _span(cell, "rowspan", len(rows)) - 1
            spans.update({c: below for c in range(column, column + span) if below})
            column += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | spans
        grid.append(cells)
    out = lines_of(loose) + captions
    for cells in grid:
        for k in range(max([len(lines) for _, lines in cells], default=0)):
            line = ""
            for column, lines in cells:
                start = sum(w + 2 for w in (width + [0] * 50)[:column])
                part = lines[k] if k < len(lines) else ""
                if part:
                    line = line.ljust(start) if len(line) <= start else line + "  "
                    line += part
            out.append(line)
    return out


def _list(node: Node) -> list[str]:
    out, start = [], node.attrs.get("start", "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start, re.A) else 1
    for x in node.children:
        if isinstance(x, str):
            out += [x.strip()] if x.strip() else []
        elif hidden(x):
            continue
        elif x.tag == "li":
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            lines = lines_of(x.children) or [""]
            out += [(mark + lines[0]).rstrip()] + [(" " * len(mark) + s) if s else "" for s in lines[1:]]
        else:
            out += ["  " + s if s else "" for s in lines_of([x])]
    return out


def lines_of(children: list, pre: bool = False) -> list[str]:
    out = Lines()
    _render(children, out, pre)
    out.line(pre and bool(out.run and out.run[-1]))
    return out.done


def _render(children: list, out: Lines, pre: bool):
    for x in children:
        if isinstance(x, str):
            out.inline(x, pre)
        elif hidden(x):
            continue
        elif x.tag == "br":
            out.line(pre, force=True)
        elif x.tag == "hr":
            out.space()
        elif x.tag == "img":
            out.inline(x.attrs.get("alt", ""))
        elif x.tag == "input":
            if x.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset"):
                out.inline(" " + x.attrs.get("value", "") + " ")
        elif x.tag in BLOCK:
            out.space() if x.tag in SPACED else out.line()
            if x.tag == "table":
                body = _table(x)
            elif x.tag in ("ul", "ol"):
                body = _list(x)
            elif x.tag == "details" and "open" not in x.attrs:
                body = lines_of([c for c in x.children if isinstance(c, Node) and c.tag == "summary"][:1])
            elif x.tag == "pre":
                body = lines_of(x.children, pre=True)
            else:
                body = lines_of(x.children, pre)
                if x.tag in ("blockquote", "dd"):
                    body = ["  " + s if s else "" for s in body]
            if body:
                out.add(body)
            out.gap = out.gap or (x.tag in SPACED and bool(out.done))
        else:
            _render(x.children, out, pre or x.tag in ("textarea", "xmp"))


def render(source: str) -> str:
    """The visible text of a page."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEPTH))
    lines = [s.replace("\xa0", " ").rstrip() for s in lines_of(build(source).children)]
    return "\n".join(lines).strip("\n")


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col`` in the place of ``html_col``."""
    refuse_clash(pages.drop(html_col), out_col)
    at = pages.columns.index(html_col)
    schema = extended(StructType([f for f in pages.schema if f.name != html_col]), **{out_col: "string"})
    names = schema.names

    def run(batches):
        for batch in batches:
            text = [None if s is None else render(s) for s in batch.column(at).to_pylist()]
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return pages.mapInArrow(run, schema)
