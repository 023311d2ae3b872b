"""Visible text of web pages, laid out as a reader sees it.

A page is cut into tags and text by one pattern; a small tree builder closes what the markup
leaves open (a paragraph before a block, an item before an item, a cell before a cell), hides
what is never shown, and renders on the way out: blocks on lines of their own, paragraphs
with a blank line between them, list items with a bullet or their number and indented by
depth, preformatted text as it is, and tables with their columns aligned. Nothing visible is
left out, be it navigation or advertising.

Formulas and drawings are read in line: of MathML all but annotations and phantoms, of SVG what
stands in ``text`` and ``foreignObject`` outside of definitions. Text that an SVG ``use`` draws
from a definition is not followed.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wavebook.llm.common import BATCH_ROWS

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|"
    r"(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z))",
    re.S,
)
#: Only tags that mention one of these have their attributes read.
MATTERS = re.compile("hidden|style|type|value|alt|start|span|open|display|visibility|placeholder", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?", re.S)
HIDING_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
SPACE = re.compile(r"[ \t\r\n\f]+")
#: A slash at the end of a tag belongs to a value without quotes, if there is one before it.
BARE_VALUE_END = re.compile(r"=\s*[^\s\"'>]+\Z")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NEVER_SHOWN = set(
    "head title script style template noscript iframe noembed noframes object audio video canvas"
    " datalist meta link base param source track".split()
)
#: Not drawn in a drawing or a formula.
NEVER_DRAWN = {
    "svg": set(
        "title desc defs metadata symbol clippath mask marker pattern filter lineargradient"
        " radialgradient script style".split()
    ),
    "math": {"annotation", "annotation-xml", "mphantom"},
}
#: Within these HTML may stand in a drawing or a formula; elsewhere the tags below end it.
HTML_INSIDE = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li"
    " listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Drawn apart from what is beside them, as are the two parts of a fraction.
APART = {"svg": {"text", "foreignobject"}, "math": {"mfrac", "mtd"}}
#: Inputs that do not show their value as text.
NO_TEXT_INPUT = set("hidden password checkbox radio range color file image".split())
PARAGRAPH = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCK = PARAGRAPH | set(
    "html body address article aside center details dialog dd dir div dt fieldset figcaption"
    " footer form header hgroup legend li main menu nav optgroup option search section summary"
    " tr caption".split()
)
#: What a start tag closes when it is still open, and where looking for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
#: An open paragraph ends before these, unless one of its own boundaries lies between.
ENDS_PARAGRAPH = BLOCK - {"html", "body", "option", "optgroup", "tr", "caption", "legend"}
BOUNDARY = {"table", "td", "th", "caption", "button", "object", "template"}
#: An end tag finds no start tag beyond these.
END_LIMIT = dict.fromkeys("td th tr tbody thead tfoot caption".split(), {"table"})
END_LIMIT |= {"li": {"ul", "ol", "menu", "dir", "table"}, "table": set(), "body": set(), "html": set()}
#: Elements deeper than this are not opened; their text counts for the element they stand in.
DEPTH = 512
IN_HEAD = {"title", "script", "style", "meta", "link", "base", "noscript", "template", "head"}


class Lines:
    """Text under construction: words with single blanks, and pending line breaks."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.blank = False
        self.gap = 0

    def words(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        core = text.strip(" ")
        if not core:
            self.blank = self.blank or bool(text)
            return
        self._open()
        if (self.blank or text[0] == " ") and self.now and not self.now[-1].endswith(" "):
            self.now.append(" ")
        self.now.append(core)
        self.blank = text[-1] == " "

    def exact(self, text: str) -> None:
        lines = text.split("\n")
        for n, line in enumerate(lines):
            if n:
                self._open()
                self.line(kept=True)
            if line:
                self._open()
                self.now.append(line)

    def _open(self) -> None:
        """Turn pending breaks into empty lines, but none at the start."""
        if not self.now and self.gap and self.done:
            self.done += [""] * (self.gap - 1)
        if not self.now:
            self.gap = 0

    def line(self, kept: bool = False) -> None:
        if self.now or kept:
            self.done.append("".join(self.now))
            self.now = []
        self.blank = False

    def block(self, apart: int) -> None:
        """End the line; the next text starts ``apart`` line ends further down at least."""
        self.line()
        self.gap = max(self.gap, apart)

    def lines(self) -> list[str]:
        self.line()
        return self.done


class Node:
    __slots__ = ("name", "shown", "out", "rows", "number", "kind", "inside")

    def __init__(self, name: str, shown: bool, out: Lines, kind: str = ""):
        self.name, self.shown, self.out, self.kind = name, shown, out, kind
        self.rows: list[list[tuple[list[str], int]]] = []
        self.number = 0
        #: "svg" or "math" where the contents are a drawing's or a formula's.
        self.inside = ""


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _hidden(name: str, attributes: dict[str, str]) -> bool:
    return (
        name in NEVER_SHOWN
        or "hidden" in attributes
        or (name == "input" and attributes.get("type", "").lower() == "hidden")
        or (name == "dialog" and "open" not in attributes)
        or bool(HIDING_STYLE.search(attributes.get("style", "")))
    )


def _not_drawn(name: str, inside: str, attributes: dict[str, str]) -> bool:
    return inside != "" and (
        name in NEVER_DRAWN[inside]
        or attributes.get("display", "").strip() == "none"
        or attributes.get("visibility", "").strip() in ("hidden", "collapse")
    )


class Page:
    """Builds the tree of open elements and renders what closes."""

    def __init__(self) -> None:
        self.root = Node("", True, Lines())
        self.stack = [self.root]
        self.exact = 0
        self.open: Counter[str] = Counter()

    def read(self, text: str) -> str:
        at, end = 0, len(text)
        while at < end:
            begin = text.find("<", at)
            if begin < 0:
                self.text(text[at:])
                break
            found = TAG.match(text, begin)
            if begin > at or found is None:
                self.text(text[at : begin + (found is None)])
            if found is None:
                at = begin + 1
                continue
            at = found.end()
            slash, name, rest = found.groups()
            if name is None:
                if self.top.inside and text.startswith("<![CDATA[", begin):
                    stop = text.find("]]>", begin)
                    self.text(text[begin + 9 : stop if stop >= 0 else end], raw=True)
                    at = stop + 3 if stop >= 0 else end
                continue
            name = name.lower()
            if slash:
                self.end(name)
                continue
            attributes = _attributes(rest) if rest and MATTERS.search(rest) else {}
            self.start(name, attributes, rest.endswith("/") and not BARE_VALUE_END.search(rest))
            if name in RAW and self.top.name == name:
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(text, at)
                stop = close.start() if close else end
                self.text(text[at:stop], raw=name not in ("textarea", "title"))
                at = stop
                self.end(name)
        while len(self.stack) > 1:
            self._close()
        return "\n".join(_trimmed(self.root.out.lines()))

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def text(self, text: str, raw: bool = False) -> None:
        if self.top.name == "head" and text.strip():
            self._until("head")
        if not self.top.shown or self.top.inside == "svg" and not self.open["text"]:
            return
        if not raw:
            text = html.unescape(text) if "&" in text else text
        holder = self.top
        if self.exact:
            holder.out.exact(text.replace("\r\n", "\n"))
        else:
            holder.out.words(text)

    def start(self, name: str, attributes: dict[str, str], closed: bool = False) -> None:
        """``closed`` is whether the tag closes itself, which counts in drawings and formulas only."""
        if name in ENDS_FOREIGN:
            while self.top.inside:
                self._close()
        if self.top.name == "head" and name not in IN_HEAD:
            self._until("head")
        if name in ENDS_PARAGRAPH:
            self._close_open({"p"}, BOUNDARY)
        if name in CLOSES:
            self._close_open(*CLOSES[name])
        above = self.top
        shown = above.shown and not _hidden(name, attributes) and not _not_drawn(name, above.inside, attributes)
        if closed and (above.inside or name in NEVER_DRAWN):
            return
        if name in VOID:
            if shown:
                self._void(name, attributes)
            return
        if len(self.stack) > DEPTH and shown:
            return
        out = Lines() if shown and name in ("li", "td", "th", "table", "caption") else above.out
        node = Node(name, shown, out)
        if name in NEVER_DRAWN:
            node.inside = name
        elif name not in HTML_INSIDE:
            node.inside = above.inside
        if shown and above.inside and (name in APART[above.inside] or above.name == "mfrac"):
            out.words(" ")
        if shown:
            self._opened(node, above, attributes)
        self.exact += name in ("pre", "textarea")
        self.open[name] += 1
        self.stack.append(node)

    def _void(self, name: str, attributes: dict[str, str]) -> None:
        out = self.top.out
        if name == "br":
            out.line(kept=True)
        elif name == "hr":
            out.block(2)
        elif name == "wbr":
            return
        elif name == "img":
            out.words(attributes.get("alt", ""))
        elif name == "input" and attributes.get("type", "").lower() in ("submit", "button", "reset"):
            out.words(attributes.get("value", ""))
        elif name == "input" and attributes.get("type", "").lower() not in NO_TEXT_INPUT:
            out.words(f" {attributes.get('value') or attributes.get('placeholder', '')} ")

    def _opened(self, node: Node, above: Node, attributes: dict[str, str]) -> None:
        name = node.name
        if name in ("ol", "ul", "menu", "dir"):
            start = attributes.get("start", "")
            node.number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
            nested = any(n.name == "li" and n.out is above.out for n in self.stack)
            above.out.block(1 if nested else 2)
        elif name == "li":
            holder = next((n for n in reversed(self.stack) if n.name in ("ol", "ul", "menu", "dir")), None)
            node.kind = "- "
            if holder is not None and holder.name == "ol":
                holder.number += 1
                node.kind = f"{holder.number}. "
        elif name == "tr":
            table = self._table()
            if table is not None:
                table.rows.append([])
        elif name in ("td", "th"):
            span = attributes.get("colspan", "")
            node.number = min(int(span), 1000) if re.fullmatch(r"[1-9]\d{0,5}", span) else 1
        elif name in BLOCK and name != "table":
            node.out.block(2 if name in PARAGRAPH else 1)

    def _table(self) -> Node | None:
        return next((n for n in reversed(self.stack) if n.name == "table" and n.shown), None)

    def end(self, name: str) -> None:
        if name in ("p", "br") and not self.open[name]:
            if self.top.shown:
                self.top.out.block(2) if name == "p" else self.top.out.line(kept=True)
            return
        if not self.open[name]:
            return
        limit = END_LIMIT.get(name, {"td", "th"})
        for node in reversed(self.stack[1:]):
            if node.name == name:
                self._until(name)
                return
            if node.name in limit:
                return

    def _close_open(self, names: set[str], limit: set[str]) -> None:
        """Close the outermost open element of these names that lies inside the limit."""
        if not any(self.open[name] for name in names):
            return
        found = None
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name in limit:
                break
            if self.stack[depth].name in names:
                found = depth
        while found is not None and len(self.stack) > found:
            self._close()

    def _until(self, name: str) -> None:
        while len(self.stack) > 1:
            if self._close() == name:
                return

    def _close(self) -> str:
        node = self.stack.pop()
        self.exact -= node.name in ("pre", "textarea")
        self.open[node.name] -= 1
        above = self.top
        if not node.shown:
            return node.name
        name, out = node.name, above.out
        if above.inside and name in APART[above.inside]:
            out.words(" ")
        if name == "li":
            out.block(1)
            for n, line in enumerate(_trimmed(node.out.lines()) or [""]):
                lead = node.kind if not n else " " * len(node.kind) if line else ""
                out.exact((lead + line).rstrip() if line else lead.rstrip())
                out.line(kept=True)
            out.block(1)
        elif name in ("td", "th"):
            table = self._table()
            if table is None:
                out.block(1)
                out.exact("\n".join(_trimmed(node.out.lines())))
                out.block(1)
            else:
                if not table.rows:
                    table.rows.append([])
                table.rows[-1].append((_trimmed(node.out.lines()), node.number))
        elif name in ("caption", "table"):
            out.block(2)
            lines = _trimmed(node.out.lines())
            if name == "table":
                grid = aligned(node.rows)
                lines = lines + [""] * bool(lines and grid) + grid
            if lines:
                out.exact("\n".join(lines))
            out.block(2)
        elif name in ("ol", "ul", "menu", "dir"):
            nested = any(n.name == "li" and n.out is out for n in self.stack)
            out.block(1 if nested else 2)
        elif name in BLOCK:
            out.block(2 if name in PARAGRAPH else 1)
        return name


def _trimmed(lines: list[str]) -> list[str]:
    """Without blanks at line ends, and without empty lines at either end."""
    lines = [line.rstrip(" \t") for line in lines]
    first = next((n for n, line in enumerate(lines) if line), len(lines))
    last = next((n for n in range(len(lines), first, -1) if lines[n - 1]), first)
    return lines[first:last]


def aligned(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of (lines of a cell, columns it spans) as lines with columns below each other.

    A cell over several columns takes their place without widening them, unless it is the
    last of its row. Widths are counted in characters.
    """
    widths: list[int] = []
    for row in rows:
        column = 0
        for lines, span in row:
            widths += [0] * (column + 1 - len(widths))
            if span == 1:
                widths[column] = max([widths[column], *map(len, lines)])
            column += span
    out = []
    for row in rows:
        for n in range(max([len(lines) for lines, _ in row], default=0)):
            line, column, start = "", 0, 0
            for lines, span in row:
                text = lines[n] if n < len(lines) else ""
                if text:
                    line = line.ljust(start) + text
                taken = widths[column : column + span]
                start += sum(taken) + 2 * span
                start = max(start, len(line) + 2 if text else start)
                column += span
            out.append(line.rstrip())
    return out


def visible_text(page: str | None) -> str | None:
    """The text of one page; null for null, empty for a page that shows nothing."""
    return None if page is None else Page().read(page)


def extract_text(pages: DataFrame, column: str = "html", target: str = "text") -> DataFrame:
    """Add the visible text of a page as ``target`` to every row.

    Null stays null, an empty page gives an empty text, broken markup is read as far as it
    goes. Rows are independent: repeated rows give equal texts, an empty table stays empty.
    All columns are kept; one named like the target is replaced.
    """
    at = pages.columns.index(column)
    keep = [c for c in pages.columns if c != target]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                texts = [visible_text(p) for p in part.column(at).to_pylist()]
                columns = [part.column(pages_at[c]) for c in keep] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, target])

    pages_at = {c: n for n, c in enumerate(pages.columns)}
    return pages.mapInArrow(task, f"{schema}, `{target}` string")
