"""Layout-aware text of web pages.

A page is read tag by tag into a tree of open elements with the usual implied
tags (a block ends an open paragraph, ``li`` ends ``li``, a cell opens its row
and section, an end tag closes what it encloses). Elements that aren't shown
(``head``, ``script``, ``hidden``, ``display:none``, ...) emit nothing; all other
text is emitted: blocks on lines of their own, with a blank line around
paragraphs and the like, list items behind their marks and indented by depth,
``pre`` as it is, and table cells side by side, padded to the width of their
column.

Only open elements and the lines made so far are held, and no step looks back
over the page, so work and memory grow with the page; depth is bounded.

Defined cases: a null page has null text, an empty one the empty text; broken
markup is read as far as it goes (a tag without an end is text); repeated rows
are rendered each; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by what they do, in the order of their names.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
UNSEEN = {"audio", "canvas", "datalist", "head", "iframe", "math", "noembed", "noframes", "noscript", "object", "script",
          "style", "svg", "template", "title", "video"}
RAW = {"iframe", "noembed", "noframes", "script", "style", "textarea", "title", "xmp"}
APART = {"blockquote", "details", "dl", "fieldset", "figure", "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "ol", "p",
         "pre", "table", "ul", "xmp"}
BLOCK = APART | {"address", "article", "aside", "body", "caption", "center", "dd", "dialog", "dir", "div", "dt", "figcaption",
                 "footer", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "option", "optgroup", "search",
                 "section", "summary", "tbody", "tfoot", "thead", "tr"}
ENDS_P = BLOCK - {"body", "caption", "dd", "dt", "html", "legend", "option", "optgroup", "tbody", "tfoot", "thead", "tr"} | {"dd", "dt"}
LISTS = {"dir", "menu", "ol", "ul"}
SECTIONS = {"tbody", "tfoot", "thead"}
CELLS = {"td", "th"}

#: What a start tag ends, and the elements that it doesn't look past.
IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dd", "dt"}, {"dl"}), "dd": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": (SECTIONS | {"caption", "colgroup"}, {"table"}), "tfoot": (SECTIONS | {"caption", "colgroup"}, {"table"}),
    "thead": (SECTIONS | {"caption", "colgroup"}, {"table"}), "body": ({"head"}, set()),
}
#: Outside of its own table, cell or caption a tag ends nothing.
WALLS = CELLS | {"caption", "table"}

#: Deeper elements are read as part of the one at this depth, as browsers do.
DEEPEST = 512

#: Cells of more characters don't widen their column.
WIDEST = 60

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# A quote opens a value only directly behind "="; anywhere else it is a plain character.
_REST = re.compile(r"(?:[\s/]++|(?:=[^\s=/>]*+|[^\s=/>]++)(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+>")
_ATTR = re.compile(r"(=[^\s=/>]*+|[^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_GONE = re.compile(r"display\s*:\s*none", re.I)
_DARK = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Flow:
    """Lines of one cell or of the page."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a space is due before the next text
        self.apart = False  # a blank line is due before the next line
        self.marks: list[str] = []  # list marks that wait for their item's text
        self.depth = 0

    def text(self, s: str) -> None:
        for k, word in enumerate(_SPACE.split(s)):
            self.space |= k > 0
            if word:
                if self.line and self.space:
                    self.line.append(" ")
                self.line.append(word)
                self.space = False

    def end_line(self, even_empty: bool = False) -> None:
        if self.line or even_empty:
            self.put("".join(self.line))
            self.line = []
        self.space = False

    def put(self, s: str) -> None:
        if self.apart and self.lines:
            self.lines.append("")
        self.apart = False
        mark = self.marks.pop() if self.marks else ""
        if s or mark or (self.lines and self.lines[-1]):
            self.lines.append((("  " * max(0, self.depth - 1)) + (mark or ("  " if self.depth else "")) + s).rstrip())

    def block(self, apart: bool) -> None:
        self.end_line()
        self.apart |= apart

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    """Rows of cells (their lines, and the columns they span)."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int]]] = []

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for cell, span in row:
                if span == 1:
                    width[at] = max(width.get(at, 0), max((len(x) for x in cell if len(x) <= WIDEST), default=0))
                at += span
        out = []
        for row in self.rows:
            for k in range(max((len(c) for c, _ in row), default=0)):
                parts, at = [], 0
                for cell, span in row:
                    room = sum(width.get(i, 0) for i in range(at, at + span)) + 2 * (span - 1)
                    parts.append((cell[k] if k < len(cell) else "").ljust(room))
                    at += span
                if line := "  ".join(parts).rstrip():
                    out.append(line)
        return out


class Page:
    """Open elements and what they have emitted."""

    def __init__(self):
        # name, unseen, visibility hidden, flow to return to or table, ordinal of a list's next item (or None)
        self.open: list[list] = []
        self.count: dict[str, int] = {}
        self.flow, self.flows = Flow(), []
        self.tables: list[Table] = []
        self.pre = 0

    def shown(self) -> bool:
        return not self.open or not (self.open[-1][1] or self.open[-1][2])

    def start(self, name: str, attrs: dict[str, str]) -> None:
        if name in ENDS_P:
            self.close({"p"}, WALLS)
        if name in IMPLIED:
            ends, past = IMPLIED[name]
            self.close(ends, past | ({"table"} if name in ("td", "th", "tr") or name in SECTIONS else WALLS))
        if name in CELLS and not self.inside("tr"):
            self.start("tr", {})
        if name == "tr" and self.inside("table") and not any(self.inside(s) for s in SECTIONS):
            self.start("tbody", {})
        if name == "br":
            if self.shown():
                self.flow.end_line(even_empty=True)
            return
        unseen, dark = (self.open[-1][1], self.open[-1][2]) if self.open else (False, False)
        style = attrs.get("style", "")
        unseen = unseen or name in UNSEEN or "hidden" in attrs or bool(style and _GONE.search(style)) or (
            name == "dialog" and "open" not in attrs)
        if style and (m := _DARK.search(style)):
            dark = m[1].lower() != "visible"
        if name in VOID:
            if name == "hr" and not unseen:
                self.flow.block(True)
            return
        if len(self.open) >= DEEPEST and not (unseen and self.shown()):
            if name in BLOCK and not unseen:
                self.flow.block(name in APART)
            return
        self.open.append([name, unseen, dark, None, None])
        self.count[name] = self.count.get(name, 0) + 1
        if unseen:
            return
        if name == "table":
            self.flow.block(True)
            self.tables.append(Table())
            self.open[-1][3] = self.tables[-1]
        elif name == "tr":
            if self.tables:
                self.tables[-1].rows.append([])
        elif name in CELLS or name == "caption":
            if self.tables:
                self.flows.append(self.flow)
                self.flow = Flow()
                span = attrs.get("colspan", "1")
                self.open[-1][3] = int(span) if span.isascii() and span.isdigit() and 0 < len(span) < 4 and int(span) else 1
        elif name in BLOCK:
            self.flow.block(name in APART and not (name in LISTS and self.flow.depth))
        if name in LISTS:
            self.flow.depth += 1
            first = attrs.get("start", "1")
            self.open[-1][4] = (int(first) if first.isascii() and first.isdigit() and len(first) < 9 else 1) if name == "ol" else None
        elif name == "li":
            owner = next((e for e in reversed(self.open) if e[0] in LISTS), None)
            mark = "- "
            if owner and owner[4] is not None:
                mark, owner[4] = f"{owner[4]}. ", owner[4] + 1
            self.flow.marks = [mark]
        elif name in ("pre", "xmp", "textarea"):
            self.pre += 1

    def inside(self, name: str) -> bool:
        if not self.count.get(name):
            return False
        for e in reversed(self.open):
            if e[0] == name:
                return True
            if e[0] == "table" or (name == "tr" and e[0] in CELLS):
                return False
        return False

    def close(self, names: set[str], walls: set[str]) -> bool:
        """Ends the innermost open element of ``names`` and all in it, unless a wall is in between."""
        if not any(self.count.get(x) for x in names):
            return False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in names:
                while len(self.open) > k:
                    self.pop()
                return True
            if self.open[k][0] in walls:
                return False
        return False

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
        elif name == "p":
            if not self.close({"p"}, WALLS) and self.shown():
                self.flow.block(True)
        elif name == "table" or name in SECTIONS or name == "tr":
            self.close({name}, set() if name == "table" else {"table"})
        elif name in CELLS or name == "caption":
            self.close({name}, {"table"})
        elif re.fullmatch("h[1-6]", name):
            self.close({"h1", "h2", "h3", "h4", "h5", "h6"}, WALLS)
        elif name in BLOCK:
            self.close({name}, WALLS)
        else:
            # An inline end tag reaches no further than its block.
            self.close({name}, WALLS | BLOCK)

    def pop(self) -> None:
        name, unseen, _, held, _ = self.open.pop()
        self.count[name] -= 1
        if unseen:
            return
        if name in ("pre", "xmp", "textarea"):
            self.pre -= 1
        if name in CELLS or name == "caption":
            if held is not None:
                lines, self.flow = self.flow.done(), self.flows.pop()
                rows = self.tables[-1].rows
                if name == "caption":
                    for x in lines:
                        self.flow.put(x)
                else:
                    rows or rows.append([])
                    rows[-1].append((lines, held))
            else:
                self.flow.text(" ")
        elif name == "table":
            for x in self.tables.pop().lines():
                self.flow.put(x)
            self.flow.block(True)
        elif name in BLOCK:
            if name in LISTS:
                self.flow.end_line()
                self.flow.depth = max(0, self.flow.depth - 1)
            self.flow.block(name in APART and not (name in LISTS and self.flow.depth))
            if name == "li" and self.flow.marks:
                self.flow.put("")

    def text(self, s: str) -> None:
        if not s or not self.shown():
            return
        if "&" in s:
            s = html.unescape(s)
        if self.pre:
            first, *others = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.flow.line.append(first)
            for x in others:
                self.flow.end_line(even_empty=True)
                self.flow.line.append(x) if x else None
        else:
            self.flow.text(s)

    def finish(self) -> str:
        while self.open:
            self.pop()
        return "\n".join(self.flow.done())


def rendered(source: str) -> str:
    """The visible text of a page."""
    page, at, n = Page(), 0, len(source)
    last = source.rfind(">")
    while at < n:
        lt = source.find("<", at)
        if lt < 0 or lt > last:
            page.text(source[at:])
            break
        if lt > at:
            page.text(source[at:lt])
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(source, lt + 1)
        if not m:
            if source[lt + 1:lt + 2] in ("!", "?", "/"):
                at = source.find(">", lt) + 1
            else:
                page.text("<")
                at = lt + 1
            continue
        rest = _REST.match(source, m.end())
        at = rest.end() if rest else source.find(">", m.end()) + 1
        name, body = m[2].lower(), source[m.end():at - 1]
        if m[1]:
            page.end(name)
            continue
        attrs = {}
        if body:
            for a in _ATTR.finditer(body):
                attrs.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
        page.start(name, attrs)
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, at)
            end = stop.start() if stop else n
            if name in ("textarea", "xmp"):
                page.text(source[at:end] if name == "textarea" else html.escape(source[at:end], quote=False))
            at = end
    return page.finish()


def extracted(pages: DataFrame, source: str = "html") -> DataFrame:
    """page_id and the visible text of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else rendered(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", source).mapInArrow(run, f"page_id {kind}, text string")
