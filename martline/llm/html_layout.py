"""Visible text of web pages, laid out as a browser would show it (operator 9).

A tree builder reads the tags: elements whose end tags may be left out are closed by what follows them, rows and cells
get the table parts that are missing around them, end tags without a start are ignored, and a page may break off
anywhere. A walk over the tree then writes the text: nothing from what is not shown (head, scripts, styles, templates,
``hidden`` elements, ``display:none``), blocks on lines of their own with blank lines around paragraphs and headings, list
items behind their marks and indented by depth, preformatted text as it is, and table cells in aligned columns.
Both steps keep their own stacks, at most 512 elements are open at once, as in browsers, and no length of page is too much.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm import frames

# The roles of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes object video audio canvas datalist".split())
#: Of a drawing, the elements with text, and what is defined there but not drawn itself.
DRAWN, UNDRAWN = frozenset(("text", "foreignobject")), frozenset("defs symbol clippath mask marker pattern desc metadata".split())
#: Inputs whose value is not shown as text.
MUTE = frozenset("hidden password checkbox radio file image color range".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset".split())
BLOCK = frozenset("""html body address article aside center details dialog dd div dt figcaption footer form header legend
li main nav section summary option optgroup caption""".split())
CELLS, PARTS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
TABLE = CELLS | PARTS | {"tr", "table", "caption", "colgroup"}
#: Elements that may be open at once.
DEPTH = 512
#: A start tag closes the open elements named here, up to the nearest of the ones after them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"table"}), "th": (CELLS, {"table"}), "tr": (CELLS | {"tr", "caption", "colgroup"}, {"table"}),
    **{p: (CELLS | PARTS | {"tr", "caption", "colgroup"}, {"table"}) for p in PARTS},
}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([A-Za-z][^\s/>]*)[^>]*>|<([A-Za-z][^\s/>]*)", re.S)
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WHITE = re.compile(r"[ \t\n\r\f]+")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None) -> None:
        self.tag, self.attributes, self.children = tag, attributes or {}, []

    def seen(self) -> bool:
        a = self.attributes
        return not (self.tag in UNSEEN or a and ("hidden" in a or _GONE.search(a.get("style", "")) or (self.tag == "input" and a.get("type", "").lower() == "hidden")))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


class Builder:
    """The tree of a page. ``open`` holds the elements that have not ended, outermost first."""

    def __init__(self) -> None:
        self.open = [Node("html")]

    def text(self, text: str) -> None:
        if text:
            self.open[-1].children.append(entities.unescape(text) if "&" in text else text)

    def _close(self, tags, until) -> None:
        """End all elements from the outermost of ``tags`` that is open inside the nearest of ``until``."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in until:
                break
            if self.open[at].tag in tags:
                found = at
                while found > 1 and self.open[found - 1].tag in tags:
                    found -= 1
                del self.open[found:]
                return self._close(tags, until)
        return None

    def _push(self, tag: str, attributes: dict[str, str] | None = None) -> None:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        # As in browsers, what is nested deeper has no children of its own, only hidden elements keep theirs to themselves.
        if tag not in VOID and (len(self.open) < DEPTH or (len(self.open) == DEPTH and not node.seen())):
            self.open.append(node)

    def drawing(self) -> bool:
        return any(n.tag == "svg" for n in self.open)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self._close({"head"}, ())
            if not attributes and tag == "html":
                return
        if tag in APART or tag in BLOCK:
            self._close({"p"}, CELLS | {"table", "li", "button", "object", "caption"} if tag not in ("li", "table") else CELLS | {"table"})
            if tag[0] == "h" and len(tag) == 2 and self.open[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                self.open.pop()
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        top = self.open[-1].tag
        if tag in CELLS or tag == "tr":
            if top == "table":
                self._push("tbody")
            if tag in CELLS and self.open[-1].tag in PARTS:
                self._push("tr")
        elif tag == "a" and top == "a":
            self.open.pop()
        self._push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "br":
            return self._push("br")
        if tag in ("html", "body"):
            return None
        walls = () if tag in TABLE else CELLS | {"caption", "table"}
        for at in range(len(self.open) - 1, 0, -1):
            held = self.open[at].tag
            if held == tag:
                del self.open[at:]
                return None
            if held in walls or (tag in TABLE and tag != "table" and held == "table"):
                return None
        return None


def _tag_end(page: str, at: int, last: int, failed: set[int]) -> int:
    """Where the ``>`` of a start tag is that has its attributes from ``at`` on, -1 if nowhere.

    Quoted values may hold ``>`` and be of any length. If the page ends inside the tag so read, quotes mean nothing.
    ``failed`` keeps the quotes from which the page's end was met, so all tags together read the page twice at most.
    """
    met, here = [], at
    while m := _MARK.search(page, here, last):
        if m[0] == ">":
            return m.start()
        if m.start() in failed:
            break
        met.append(m.start())
        here = page.find(m[0], m.end(), last) + 1
        if not here:
            break
    failed.update(met)
    return page.find(">", at, last)


def parse(page: str) -> Node:
    build, at, last = Builder(), 0, page.rfind(">") + 1
    cut = page.rfind("<!--")
    last = len(page) if cut >= last else last  # a comment that never ends
    failed: set[int] = set()
    here = 0
    while m := _TAG.search(page, here, last):
        here = m.end()
        if m[2]:
            stop = _tag_end(page, here, last, failed)
            if stop < 0:
                continue
            text, here = page[here:stop], stop + 1
        build.text(page[at : m.start()])
        at = here
        if m[1]:
            build.end(m[1].lower())
        elif m[2]:
            tag = m[2].lower()
            build.start(tag, _attributes(text))
            if text.endswith("/") and tag not in VOID and build.open[-1].tag == tag and build.drawing():
                build.open.pop()  # in drawings an element may end with its start tag
                continue
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
                inner = page[at : stop.start() if stop else len(page)]
                at = here = stop.start() if stop else len(page)
                if tag == "textarea":
                    build.text(inner)
                if not stop:
                    break
    rest = page[at:]
    broken = re.search(r"<(?:[A-Za-z/!?][^>]*)\Z", rest)  # a tag that the page broke off in
    build.text(rest[: broken.start()] if broken else rest)
    return build.open[0]


class Flow:
    """Lines of text under way: gaps asked for between blocks, the indent, and the mark of the list item that has no text yet."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.started = self.space = False
        self.gap, self.indent, self.marks = 0, 0, []

    def block(self, gap: int) -> None:
        self.gap, self.space = max(self.gap, gap), False

    def line_break(self) -> None:
        if self.started and not self.gap:
            self.gap = 1
        elif self.lines or self.started:
            self.gap = min(self.gap + 1, 2)
        self.space = False

    def _begin(self) -> None:
        if self.gap and self.started:
            self.lines.append(self.line.rstrip())
            self.lines += [""] * (self.gap - 1)
            self.started = False
        self.gap = 0
        if not self.started:
            self.line = " " * self.indent
            for at, mark in self.marks:
                self.line = self.line[:at] + mark + self.line[at + len(mark) :]
            self.marks = []
            self.started, self.space = True, False

    def words(self, text: str) -> None:
        plain = _WHITE.sub(" ", text)
        body = plain.strip(" ")
        if not body:
            self.space = self.space or (bool(plain) and self.started and not self.gap)
            return
        self._begin_or_space(plain[0] == " ")
        self.line += body
        self.space = plain[-1] == " "

    def _begin_or_space(self, white: bool) -> None:
        fresh = bool(self.gap) or not self.started
        self._begin()
        if not fresh and (self.space or white):
            self.line += " "
        self.space = False

    def exact(self, text: str) -> None:
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                if self.started:
                    self.lines.append(self.line.rstrip())
                    self.started = False
                elif self.lines:
                    self.lines.append("")
                self.gap = 0
            if part:
                self._begin()
                self.line += part

    def done(self) -> list[str]:
        lines = [*self.lines, self.line.rstrip()] if self.started else list(self.lines)
        while lines and not lines[-1]:
            lines.pop()
        return lines


#: Characters of a cell that is aligned with others, and of a table whose columns are: no more blanks than that begin a line.
WIDE_CELL, WIDE_TABLE = 80, 240


class Grid:
    """Cells of a table under way: rows of (first column, columns, lines)."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.below: dict[int, int] = {}

    def row(self) -> None:
        self.below = {c: n - 1 for c, n in self.below.items() if n > 1}
        self.rows.append([])

    def cell(self, node: Node, lines: list[str]) -> None:
        if not self.rows:
            self.row()

        def span(name: str) -> int:
            value = node.attributes.get(name, "1")
            return min(1000, max(1, int(value))) if value.isdigit() and len(value) < 6 else 1

        at = self.rows[-1][-1][0] + self.rows[-1][-1][1] if self.rows[-1] else 0
        while at in self.below:
            at += 1
        columns, down = span("colspan"), span("rowspan")
        self.rows[-1].append((at, columns, lines))
        if down > 1:
            self.below.update(dict.fromkeys(range(at, at + columns), down))

    def laid_out(self) -> list[str]:
        """Lines of the table. Cells wider than ``WIDE_CELL`` stand on lines of their own; a table wider than ``WIDE_TABLE`` is not aligned."""
        rows = [r for r in self.rows if any(lines for _, _, lines in r)]
        width: dict[int, int] = {}
        for spans in (False, True):  # cells of one column set the widths, wider ones stretch their last column
            for at, n, lines in (c for r in rows for c in r):
                if (n > 1) == spans and not _wide(lines):
                    need = max(map(len, lines), default=0) - sum(width.get(c, 0) + 2 for c in range(at, at + n - 1))
                    width[at + n - 1] = max(width.get(at + n - 1, 0), need)
        left, edge = {}, 0
        for c in range(max(width, default=-1) + 1):
            left[c] = edge
            edge += width.get(c, 0) + 2 if width.get(c, 0) else 0
        if edge > WIDE_TABLE:
            left = dict.fromkeys(left, 0)
        out: list[str] = []
        for r in rows:
            beside: list[tuple[int, list[str]]] = []
            for at, _, lines in r:
                if _wide(lines):
                    out += _side_by_side(beside, left)
                    out += lines
                    beside = []
                else:
                    beside.append((at, lines))
            out += _side_by_side(beside, left)
        return out


def _wide(lines: list[str]) -> bool:
    return any(len(x) > WIDE_CELL for x in lines)


def _side_by_side(cells: list[tuple[int, list[str]]], left: dict[int, int]) -> list[str]:
    """Lines of neighbouring cells, each cell from the edge of its column on."""
    out = []
    for k in range(max((len(lines) for _, lines in cells), default=0)):
        line = ""
        for at, lines in cells:
            if k < len(lines) and lines[k]:
                line = line.ljust(left[at]) + lines[k] if len(line) <= left[at] else line + "  " + lines[k]
        out.append(line)
    return out


_OPEN, _SHUT = 0, 1


def _drawn(svg: Node) -> list[Node]:
    """The elements with text of a drawing, in order."""
    out, waiting = [], list(reversed(svg.children))
    while waiting:
        node = waiting.pop()
        if isinstance(node, str) or node.tag in UNDRAWN or not node.seen() or node.attributes.get("display") == "none" or node.attributes.get("visibility") == "hidden":
            continue
        if node.tag in DRAWN:
            out.append(Node("div", node.attributes))  # on a line of its own
            out[-1].children = [c for c in node.children if isinstance(c, str) or c.tag not in UNDRAWN]
        else:
            waiting.extend(reversed(node.children))
    return out


def render(root: Node) -> str:
    """Text of the tree, lines joined by line ends."""
    flows, grids, lists = [Flow()], [], []
    pre = 0
    stack: list[tuple[int, Node | str]] = [(_OPEN, root)]
    while stack:
        step, node = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if pre:
                flow.exact(node)
            elif not (grids and flow is grids[-1][1]) or node.strip(" \t\r\n\f"):
                flow.words(node)
            continue
        tag, a = node.tag, node.attributes
        if step == _OPEN:
            if not node.seen():
                continue
            if tag == "br":
                flow.line_break()
                continue
            if tag in APART:
                flow.block(1 if tag in ("ul", "ol") and lists else 2)
            elif tag in BLOCK:
                flow.block(1)
            if tag in ("ul", "ol", "menu"):
                start = a.get("start", "")
                lists.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                if re.fullmatch(r"-?\d{1,9}", a.get("value", "")):
                    kind[1] = int(a["value"])
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                flow.marks.append((flow.indent, mark))
                flow.indent += len(mark)
                node.children.append(Node("#indent", {"n": str(len(mark))}))
            elif tag in ("blockquote", "dd"):
                flow.indent += 2
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                grids.append((Grid(), flow))
            elif tag == "tr" and grids:
                grids[-1][0].row()
            elif tag in CELLS and grids:
                flows.append(Flow())
                lists.append(["ul", 1])
            elif tag == "img":
                if a.get("alt"):
                    flow.words(a["alt"])
            elif tag == "input":
                if a.get("value") and a.get("type", "").lower() not in MUTE:
                    flow.words(a["value"])
            elif tag == "#indent":
                flow.indent -= int(a["n"])
                while flow.marks and flow.marks[-1][0] >= flow.indent:
                    flow.marks.pop()
                continue
            if tag not in VOID:
                stack.append((_SHUT, node))
                stack.extend((_OPEN, c) for c in reversed(_drawn(node) if tag == "svg" else node.children))
            continue
        if tag in CELLS and grids:
            lists.pop()
            grids[-1][0].cell(node, flows.pop().done())
        elif tag == "table":
            grid, _ = grids.pop()
            lines = grid.laid_out()
            flow.block(2)
            if lines:
                flow.exact("\n".join(lines))
            flow.block(2)
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag in ("blockquote", "dd"):
            flow.indent -= 2
        elif tag == "pre":
            pre -= 1
        if tag in APART:
            flow.block(1 if tag in ("ul", "ol") and lists else 2)
        elif tag in BLOCK:
            flow.block(1)
    return "\n".join(flows[0].done())


def visible_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def extract(pages: DataFrame, html: str = "html", into: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """``pages`` (of it the columns ``carry``, if given) with the visible text of each page.

    A null or empty page has an empty text, a page without tags is its text. Each row is rendered alone, in the scan, so
    repeated rows have equal texts; a column named as ``into`` is replaced.
    """
    frames.ready(pages.sparkSession)
    columns = list(pages.columns if carry is None else carry)
    dealt = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{html}`").cast("string").alias("html"))

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [visible_text(p) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], ["row", into])

    return frames.unpacked(dealt.mapInArrow(frames.per_task(rendered), T.StructType([dealt.schema["row"], T.StructField(into, T.StringType())])), columns, into)


def op9_html_layout_text(spark, sf_dir: str) -> DataFrame:
    """Operator 9 over ``pages``: the whole visible text of each page."""
    return extract(frames.table(spark, sf_dir, "pages").select("page_id", "html"), carry=["page_id"])
