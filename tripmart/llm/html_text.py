"""Visible text of HTML pages, laid out as lines.

A tree builder reads tags, closes elements that other tags imply to be over,
and leaves out what a page does not show. The tree is then written as text:
paragraphs and headings between blank lines, other blocks on lines of their
own, list items with bullets or numbers, preformatted text as it is, and
table cells in aligned columns. One page is a row's work; pages are
independent of each other.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import map_batches

# An attribute: a quote opens a quoted value straight after the = only.
_NAME = r"[^\s/>][^\s/>=]*+"
_VALUE = r"\s*+=\s*+(?:\"{0}\"|'{1}'|{2})?+"
_ANY = _VALUE.format(r"[^\"]*+", r"[^']*+", r"[^\s>\"'][^\s>]*+")
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAME}(?:{_ANY})?+)*+)>"
                   r"|[^<]++|<", re.DOTALL)
ATTRIBUTE = re.compile(rf"({_NAME})(?:" + _VALUE.format(r"([^\"]*+)", r"([^']*+)", r"([^\s>\"'][^\s>]*+)") + ")?+")
OPENED = re.compile("</?[a-zA-Z]")
#: Tags that end themselves; the slash is no part of an unquoted value.
SELF_ENDED = re.compile(r"(?:^|[\s\"']|[\s/][^\s=\"'/]++)/$")
SPACE = re.compile(r"[ \t\n\r\f]+")
UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
#: Elements below this depth join their ancestor's children there.
DEPTH = 200

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = set("head script style template title noscript iframe noembed noframes xmp object audio video canvas "
             "datalist".split())
#: Elements a head holds; anything else, and any text, ends it.
IN_HEAD = set("base basefont bgsound link meta title noscript noframes style script template head html".split())
#: Drawings and formulas, where tags can end themselves, and what they do not show.
FOREIGN = {"svg": set("desc metadata defs symbol".split()), "math": set("annotation annotation-xml mphantom".split())}
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
BLOCK = SPACED | set("html body address article aside center details dialog dd div dt figcaption footer form header "
                     "hgroup legend li main menu nav option optgroup search section summary tr caption".split())
# End tags that a start tag implies, and where the search ends.
ENDS_P = BLOCK - set("html body tr caption option optgroup".split())
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup"}, {"select"}), "body": ({"head"}, set()),
}
CLOSES_P_UP_TO = {"td", "th", "table", "button", "caption"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def seen(self) -> bool:
        return not (self.tag in UNSEEN or "hidden" in self.attrs
                    or self.tag == "input" or UNSEEN_STYLE.search(self.attrs.get("style", "")))


def _close(stack: list[Node], tags: set[str], stop: set[str]) -> None:
    """End the nearest open element of ``tags`` above any of ``stop``."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in stop:
            return


def parse(page: str) -> Node:
    """Tree of a page; every tag and character is accepted.

    A tag without its end takes all that follows it, as in a browser; so no
    part of a page is read more than a fixed number of times.
    """
    root = Node("html", {})
    stack, at = [root], 0
    while at < len(page):
        m = TOKEN.match(page, at)
        if m[0] == "<" and OPENED.match(page, at):
            break  # a tag that the page ends in: nothing of it is shown
        at = m.end()
        end, tag, attrs = m[1], (m[2] or "").lower(), m[3]
        if not tag:
            if not m[0].startswith(("<!", "<?")):
                text = html.unescape(m[0])
                if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
                    stack.pop()
                stack[-1].children.append(text)
        elif end:
            if stack[-1].tag == "head" and tag in ("p", "br"):
                stack.pop()
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p", {}))
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            else:
                _close(stack, {tag}, set() if tag in ("table", "body", "html") else {"table"} - {tag})
        else:
            given = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(attrs)}
            if tag in ENDS_P:
                _close(stack, {"p"}, CLOSES_P_UP_TO)
            if tag in IMPLIED:
                _close(stack, *IMPLIED[tag])
            if stack[-1].tag == "head" and tag not in IN_HEAD:
                stack.pop()
            if tag == "html":
                continue
            foreign = next((n.tag for n in reversed(stack) if n.tag in FOREIGN), None)
            if foreign and tag in FOREIGN[foreign]:
                given["hidden"] = ""
            if foreign == "svg" and tag == "text":
                stack[-1].children.append(" ")  # texts of a drawing stand apart
            node = Node(tag, given)
            stack[-1].children.append(node)
            if (foreign or tag in FOREIGN) and SELF_ENDED.search(attrs):
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                node.children.append(html.unescape(page[at:stop.start() if stop else len(page)]))
                at = stop.end() if stop else len(page)
            elif tag not in VOID and len(stack) < DEPTH:
                stack.append(node)
    return root


class Lines:
    """Lines being written; white space collapses outside ``pre``."""

    def __init__(self):
        self.done: list[str] = []
        self.line, self.gap = "", 0

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *more = text.expandtabs(8).replace("\r\n", "\n").split("\n")
            self._put(first)
            for part in more:
                self.done.append(self.line)
                self.line = part
            return
        text = SPACE.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        if text:
            self._put(text)

    def _put(self, text: str) -> None:
        if not self.line and self.done:
            self.done += [""] * (self.gap - 1)
        self.gap = 0
        self.line += text

    def end(self, gap: int) -> None:
        """End the line; the next one follows after ``gap`` - 1 blank lines."""
        if self.line.strip():
            self.done.append(self.line.rstrip())
        self.line, self.gap = "", max(gap, self.gap)

    def add(self, lines: list[str], gap: int) -> None:
        self.end(gap)
        if lines:
            if self.done:
                self.done += [""] * (self.gap - 1)
            self.done += lines
            self.gap = gap

    def all(self) -> list[str]:
        self.end(1)
        return self.done


def _indented(lines: list[str], mark: str) -> list[str]:
    return [(mark if i == 0 else " " * len(mark)) + x if x else x for i, x in enumerate(lines or [""])]


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"-?\d{1,6}", text.strip()) else default


# The most columns and rows that a cell covers.
SPANS = (("colspan", 1000), ("rowspan", 65534))
#: The padding of a table's cells, and the marks between them, take at most
#: so many characters for each one of its text, and a part that any may have.
SLACK, ALLOWANCE = 4, 4096


def _widths(lengths: dict[int, set[int]], height: int, budget: int) -> dict[int, int]:
    """Width of each column: that of its widest line.

    If the padding would exceed the budget, that of its widest line up to a
    common limit, the largest one that keeps to it; longer lines then move
    what follows them to the right.
    """
    ranked = {k: sorted(x) for k, x in lengths.items()}

    def up_to(limit: int) -> dict[int, int]:
        return {k: x[i - 1] if (i := bisect_right(x, limit)) else 0 for k, x in ranked.items()}

    low, high = 0, max((x[-1] for x in ranked.values()), default=0)
    if sum(up_to(high).values()) * height <= budget:
        return up_to(high)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(up_to(middle).values()) * height <= budget else (low, middle)
    return up_to(low)


def _aligned(grid: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Lines of rows of cells (first column, column after the last, lines).

    Columns that a row's cells do not start in stay empty in it. If the marks
    between columns alone would exceed the budget, each row has its own cells
    only, not aligned.
    """
    lengths: dict[int, set[int]] = {}
    text = 0
    for row in grid:
        for k, _, cell in row:
            lengths.setdefault(k, set()).update(map(len, cell))
            text += sum(map(len, cell))
    heights = [max((len(cell) for *_, cell in row), default=0) for row in grid]
    budget = SLACK * text + ALLOWANCE
    marks = sum(3 * row[-1][1] * h for row, h in zip(grid, heights, strict=True) if row)
    width = _widths(lengths, sum(heights), budget) if marks <= budget else None
    out = []
    for row, height in zip(grid, heights, strict=True):
        for i in range(height):
            own = {k: cell[i] if i < len(cell) else "" for k, _, cell in row}
            if width is None:
                cells = list(own.values())
            else:
                cells = [own.get(k, "").ljust(width.get(k, 0)) for k in range(row[-1][1])]
            out.append(" | ".join(cells).rstrip())
    return out


def _table(node: Node) -> tuple[list[str], list[str]]:
    """Caption lines and the lines of the aligned rows."""
    caption, rows, stray = [], [], []
    todo = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if not isinstance(c, Node):
            if c.strip():
                stray.append(SPACE.sub(" ", c).strip())
        elif not c.seen():
            continue
        elif c.tag == "caption":
            caption += render(c)
        elif c.tag == "tr":
            rows.append(c)
        elif c.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(c.children)
        else:
            stray += render(c)
    grid: list[list[tuple[int, int, list[str]]]] = []
    held: list[tuple[int, int, int]] = []  # columns from, to, and the row they are covered up to
    for at, row in enumerate(rows):
        line, column = [], 0
        held = sorted(h for h in held if h[2] > at)
        covered = iter(list(held))
        over = next(covered, None)
        for c in [x for x in row.children if isinstance(x, Node) and x.seen()]:
            while over and over[0] <= column:
                column = max(column, over[1])
                over = next(covered, None)
            wide, tall = (max(1, min(most, _number(c.attrs.get(a), 1))) for a, most in SPANS)
            line.append((column, column + wide, render(c)))
            if tall > 1:
                held.append((column, column + wide, at + tall))
            column += wide
        stray += [SPACE.sub(" ", x).strip() for x in row.children if isinstance(x, str) and x.strip()]
        grid.append(line)
    return stray + caption, _aligned(grid)


def _write(node: Node, out: Lines, pre: bool) -> None:
    number = _number(node.attrs.get("start"), 1)
    for c in node.children:
        if not isinstance(c, Node):
            out.text(c, pre)
            continue
        if not c.seen():
            continue
        gap = 2 if c.tag in SPACED else 1
        if c.tag == "br":
            if out.line.strip():
                out.end(1)
            elif out.done:
                out.gap = max(out.gap, 2)
        elif c.tag == "hr":
            out.add(["---"], 2)
        elif c.tag in ("ul", "ol", "menu") and node.tag in ("li", "ul", "ol", "menu"):
            out.add(render(c), 1)  # a list inside a list follows without a blank line
        elif c.tag == "li":
            number = _number(c.attrs.get("value"), number)
            out.add(_indented(render(c), f"{number}. " if node.tag == "ol" else "- "), 1)
            number += 1
        elif c.tag == "dd":
            out.add(_indented(render(c), "  "), 1)
        elif c.tag == "blockquote":
            out.add(["> " + x if x else ">" for x in render(c)], 2)
        elif c.tag == "table":
            caption, lines = _table(c)
            out.add(caption, 2)
            out.add(lines, 1 if caption else 2)
            out.end(2)
        elif c.tag == "pre":
            inner = Lines()
            _write(c, inner, True)
            lines = [*inner.done, inner.line]
            while lines and not lines[0].strip():
                lines.pop(0)
            while lines and not lines[-1].strip():
                lines.pop()
            out.add([x.rstrip() for x in lines], 2)
        elif c.tag in BLOCK:
            out.end(gap)
            _write(c, out, pre)
            out.end(gap)
        else:
            if c.tag in ("td", "th") and out.line:
                out.text(" ", False)
            _write(c, out, pre)


def render(node: Node) -> list[str]:
    out = Lines()
    _write(node, out, False)
    return out.all()


def page_text(page: str | None) -> str | None:
    return None if page is None else "\n".join(render(parse(page)))


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.drop(columns="html").assign(text=[page_text(p if isinstance(p, str) else None) for p in batch["html"]])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text, n_chars: the visible text of every page.

    A null page has a null text and null n_chars; an empty one, or one that
    shows nothing, an empty text. Any text is a page: unknown and unbalanced
    tags are accepted. Repeated rows are extracted each; other columns are
    ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    return map_batches(rows, _extracted, "page_id long, text string").withColumn("n_chars", F.length("text").cast("long"))


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
