"""Layout-aware text of HTML pages.

A tree is built with the end tags that HTML implies, what is not shown is left
out, and the rest is laid out as text: blocks on lines of their own with blank
lines where there are margins, list items with markers and indents, tables with
columns of equal width.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwatch.llm.common import small_batches

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title meta link iframe object audio video canvas svg math datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table ul caption thead tbody tfoot tr td th".split())
MARGINS = frozenset("p blockquote h1 h2 h3 h4 h5 h6 ul ol dl pre figure table menu dir fieldset article section".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "legend"}
#: Elements that a start tag ends, and the elements beyond which it doesn't look.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
SCOPES = frozenset("table td th caption html button object template".split())
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
DEEPEST = 512
_WHOLE = re.compile(r"[+-]?[0-9]{1,9}")
_RUN = re.compile(r"[ \t\n\r\f]+")


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _number(value: str, default: int) -> int:
    """A whole number as attributes write it; anything else, and what no list or table needs, is the default."""
    found = _WHOLE.fullmatch(value.strip())
    return int(found[0]) if found else default


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {})
        self._open = [self.root]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![…]>`` of any kind is skipped; one that does not end takes the rest of its tag."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _close(self, targets: set[str] | frozenset[str], scope) -> None:
        """End the innermost element of ``targets`` that is open within ``scope``, with all inside it."""
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag in targets:
                del self._open[i:]
                return
            if self._open[i].tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in IMPLIED:
            targets, scope = IMPLIED[tag]
            before = 0
            while before != len(self._open):
                before = len(self._open)
                self._close(targets, scope)
        if self._open[-1].tag == "head" and tag not in UNSEEN and tag != "base":
            self._open.pop()
        node = _Node(tag, {k: v or "" for k, v in attrs})
        self._open[-1].children.append(node)
        # Deeper elements stay beside each other, as in browsers; it also bounds the search for an open tag.
        if tag not in VOID and len(self._open) < DEEPEST:
            self._open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p" and not any(n.tag == "p" for n in self._open):
            self.handle_starttag("p", [])
            self._open.pop()
        else:
            self._close({tag}, SCOPES - {tag} if tag not in ("table", "html", "body") else ())

    def handle_data(self, data: str) -> None:
        self._open[-1].children.append(data)


def _hidden(node: _Node) -> bool:
    return (
        node.tag in UNSEEN or "hidden" in node.attrs or bool(_HIDING.search(node.attrs.get("style", "")))
        or (node.tag == "input" and node.attrs.get("type", "").lower() == "hidden")
        or (node.tag == "dialog" and "open" not in node.attrs))


def _width(text: str) -> int:
    """Columns that a text takes: wide letters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Page:
    """Lines of one flow of blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self._words: list[str] = []
        self._space = False
        self._blank = False
        self.indent = ""
        self.marker = ""

    def text(self, data: str) -> None:
        parts = _RUN.split(data)
        for i, part in enumerate(parts):
            if i:
                self._space = True
            if part:
                if self._space and self._words:
                    self._words.append(" ")
                self._words.append(part)
                self._space = False

    def _put(self, line: str) -> None:
        if self._blank and self.lines:
            self.lines.append("")
        self._blank = False
        if self.marker:
            line = self.indent[: -len(self.marker)] + self.marker + line
            self.marker = ""
        else:
            line = self.indent + line
        self.lines.append(line.rstrip())

    def end_line(self, forced: bool = False) -> None:
        line = "".join(self._words)
        self._words, self._space = [], False
        if line:
            self._put(line)
        elif forced:
            self.lines.append("")

    def raw(self, data: str) -> None:
        self.end_line()
        for line in data.expandtabs(8).split("\n"):
            self._put(line)

    def margin(self) -> None:
        self.end_line()
        self._blank = True

    def result(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def _laid_out(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells (lists of lines) with columns of equal width, two spaces apart."""
    rows = [r for r in rows if any(cell for cell in r)]
    columns = max(map(len, rows), default=0)
    widths = [max((_width(line) for r in rows if i < len(r) for line in r[i]), default=0) for i in range(columns)]
    out = []
    for row in rows:
        for k in range(max(len(cell) for cell in row)):
            line = ""
            for i, cell in enumerate(row):
                part = cell[k] if k < len(cell) else ""
                line += part + " " * (widths[i] - _width(part) + 2)
            out.append(line.rstrip())
    return out


def rendered(html: str) -> str:
    """The visible text of a page."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    pages = [_Page()]
    tables: list[list[list[list[str]]]] = []
    lists: list[list] = []  # per open list: the next number, or None for bullets
    pre = 0
    stack: list[tuple] = [(builder.root, False)]
    while stack:
        node, leaving = stack.pop()
        page = pages[-1]
        if isinstance(node, str):
            if pre:
                page.raw(node.strip("\n")) if node.strip("\n") else None
            else:
                page.text(node)
            continue
        tag = node.tag
        if not leaving:
            if _hidden(node):
                continue
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(node.children))
            if tag == "br":
                page.end_line(forced=True)
            elif tag == "hr":
                page.margin()
            elif tag == "input" and node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                page.text(" " + node.attrs.get("value", "") + " ")
            elif tag == "img" and "alt" in node.attrs and "src" not in node.attrs:
                page.text(node.attrs["alt"])
            elif tag == "table":
                page.margin()
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                pages.append(_Page())
            elif tag in BLOCKS:
                # a list inside a list has no margin
                page.margin() if tag in MARGINS and not (tag in ("ul", "ol", "menu", "dir") and lists) else page.end_line()
                if tag in ("ul", "ol", "menu", "dir"):
                    lists.append([_number(node.attrs.get("start", ""), 1)] if tag == "ol" else [None])
                elif tag == "li":
                    number = lists[-1][0] if lists else None
                    page.marker = "- " if number is None else f"{number}. "
                    if number is not None:
                        lists[-1][0] += 1
                    node.attrs["#indent"] = page.indent
                    page.indent += " " * len(page.marker)
                elif tag in ("dd", "blockquote"):
                    node.attrs["#indent"] = page.indent
                    page.indent += "    "
                elif tag == "pre":
                    pre += 1
            continue
        if tag in ("td", "th") and tables:
            cell = pages.pop().result()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append(cell)
            span = _number(node.attrs.get("colspan", ""), 1)
            tables[-1][-1].extend([[]] * (min(max(span, 1), 1000) - 1))
        elif tag == "table" and tables:
            page.end_line()
            for line in _laid_out(tables.pop()):
                page._put(line)
            page.margin()
        elif tag in BLOCKS and tag not in ("tr", "thead", "tbody", "tfoot"):
            page.end_line()
            if "#indent" in node.attrs:
                page.indent, page.marker = node.attrs.pop("#indent"), ""
            if tag in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
            if tag == "pre":
                pre -= 1
            if tag in MARGINS and not (tag in ("ul", "ol", "menu", "dir") and lists):
                page.margin()
    return "\n".join(pages[0].result())


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [rendered(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])


def extract_text(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``page_id, text``: the visible text of each page.

    Null and empty pages give an empty text; broken markup never fails. Repeated
    rows give repeated results; other columns are left behind. Nothing is shuffled.
    """
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.coalesce(F.col(html_column), F.lit("")).alias("html"))
    return small_batches(rows).mapInArrow(_render, "page_id bigint, text string")
