"""Layout-aware text of HTML pages.

A small tree builder reads tags, adds the end tags that HTML implies, and leaves out what a reader
does not see; the tree is then rendered to text with blank lines between blocks, marked list items,
and table cells aligned in columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Generator, Iterable, Iterator
from html import unescape
from unicodedata import category, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tidy

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("script style head title template noscript datalist iframe object audio video canvas noembed noframes meta link annotation annotation-xml".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
tfoot th thead tr ul""".split())  # fmt: skip
#: Inside SVG only text elements show text, each on a line of its own, and foreign content; these hide what they hold.
SVG_TEXT, SVG_HIDDEN = "svg text", frozenset("title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter".split())
#: Types of inputs whose value a reader sees.
SHOWN_INPUTS = frozenset(["", *"submit reset button text search email url tel number date month week time datetime-local".split()])
BLOCK |= {SVG_TEXT}
#: Blocks that a blank line sets apart.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
#: Parts of a table that hold others, and all that make the elements around them part of its frame.
SECTIONS = frozenset("thead tbody tfoot tr".split())
PARTS = SECTIONS | {"td", "th", "caption"}
#: Columns that a cell may span.
MOST_COLUMNS = 1000
#: An opening tag ends these open elements, up to the nearest element of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Blocks that end an open paragraph.
ENDS_P = BLOCK - frozenset("body dd dt html li optgroup option tbody td tfoot th thead tr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([A-Za-z][^\s/>]*)[^>]*>?|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"?|'[^']*'?)*)>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SHEET = re.compile(r"<style(?:\s[^>]*)?>(.*?)(?:</style\s*/?>|\Z)", re.S | re.I)
_NOISE = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->|@[\w-]+[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}?)", re.S)
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SIMPLE = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)
_SHOWN = re.compile(r"(?:^|[\s;])(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_WHOLE = re.compile(r"\s*(-?\d{1,9})")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Element:
    """A tag with its children: text or further elements.

    ``hidden`` elements are gone with all in them; text of ``unseen`` ones is, but not that of
    elements inside that are visible again. ``attributes`` are kept where layout needs them.
    """

    __slots__ = ("tag", "hidden", "unseen", "attributes", "children")

    def __init__(self, tag: str, hidden: bool = False, unseen: bool = False, attributes: dict[str, str] | None = None):
        self.tag, self.hidden, self.unseen, self.attributes, self.children = tag, hidden, unseen, attributes or {}, []

    def number(self, name: str, default: int) -> int:
        m = _WHOLE.match(self.attributes.get(name, ""))
        return int(m[1]) if m else default


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" \t\n\r\f/") else {}


class Styles:
    """What a page's style sheets say of display and visibility, for selectors of a tag, ids and classes.

    Rules that depend on the medium, and other selectors, are left out. As in CSS the more specific rule
    wins, then the later, and what a style attribute says wins over both unless they are important.
    """

    def __init__(self, html: str):
        self.rules: dict[str, list[tuple[tuple, str, set[str], str, str]]] = {}  # by an id, class or tag that they ask for
        for number, (names, body) in enumerate(r.groups() for sheet in _SHEET.finditer(html) for r in _RULE.finditer(_NOISE.sub(" ", sheet[1]))):
            said = [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _SHOWN.finditer(body)]
            for name in names.split(",") if said else ():
                m = _SIMPLE.fullmatch(name.strip())
                if not m or not name.strip():
                    continue
                tag, marks = (m[1] or "*").lower(), set(re.findall(r"[.#][\w-]+", m[2]))
                rank = (sum(x[0] == "#" for x in marks), sum(x[0] == "." for x in marks), tag != "*", number)
                for what, value, important in said:
                    self.rules.setdefault(max(marks, default=tag), []).append(((important, *rank), tag, marks, what, value))

    def of(self, tag: str, attributes: dict[str, str]) -> dict[str, str]:
        """display and visibility of an element, where something is said of them."""
        best: dict[str, tuple[tuple, str]] = {}
        if self.rules:
            marks = {f".{c}" for c in attributes.get("class", "").split()} | ({"#" + attributes["id"]} if "id" in attributes else set())
            for rank, of, needs, what, value in (r for key in (*marks, tag, "*") for r in self.rules.get(key, ())):
                if of in ("*", tag) and needs <= marks and rank >= best.get(what, ((False,), ""))[0]:
                    best[what] = (rank, value)
        for m in _SHOWN.finditer(attributes.get("style", "")):
            what, rank = m[1].lower(), (bool(m[3]), 1 << 30)
            if rank >= best.get(what, ((False,), ""))[0]:
                best[what] = (rank, m[2].lower())
        return {what: value for what, (_, value) in best.items()}


def _unseen(tag: str, attributes: dict[str, str], said: dict[str, str]) -> bool:
    return (tag in HIDDEN or said.get("display", "none" if "hidden" in attributes else "") == "none"
            or tag == "input" and attributes.get("type", "").lower() == "hidden" or tag == "dialog" and "open" not in attributes)


def _label(tag: str, attributes: dict[str, str]) -> str:
    """Text that an element without content shows."""
    kind = attributes.get("type", "").lower() if tag == "input" else ""
    if tag == "img" or kind == "image":
        return attributes.get("alt", "")
    return attributes.get("value", "") if tag == "input" and kind in SHOWN_INPUTS else ""


def parse(html: str) -> Element:
    """The tree of a page. Unclosed elements end with their parents; a stray end tag is ignored."""
    root, styles = Element("html"), Styles(html)
    stack, at = [root], 0
    where: dict[str, list[int]] = {}  # places of the open elements by tag, so that no search walks a deep stack

    def nearest(tags: Iterable[str]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def cut(place: int) -> None:
        while len(stack) > place:
            where[stack.pop().tag].pop()

    def close(names: set[str], stop: set[str]) -> None:
        while (place := nearest(names)) > nearest(stop):
            cut(place)

    while at < len(html):
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else len(html)]
        if text and not stack[-1].unseen:
            stack[-1].children.append(unescape(text))
        if not m:
            break
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in ("html", "body"):
                continue
            if tag == "br":
                stack[-1].children.append(Element("br"))
            if tag == "text" and nearest((SVG_TEXT,)) > nearest(("foreignobject",)):
                tag = SVG_TEXT
            place = nearest((tag,))
            if place and (tag in ("table", "tr", "tbody", "thead", "tfoot") or place >= nearest(("td", "th", "table"))):
                cut(place)
        elif m[2]:
            tag, attributes = m[2].lower(), _attributes(m[3])
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in ENDS_P:
                close({"p"}, {"td", "th", "table", "button", "li", "div"})
            if tag == "html":
                continue
            drawing = nearest(("svg",)) > nearest(("foreignobject",))
            said = styles.of(tag, attributes)
            hidden = _unseen(tag, attributes, said) or drawing and tag in SVG_HIDDEN
            visibility = said.get("visibility", "")
            unseen = visibility != "visible" if visibility in ("visible", "hidden", "collapse") else stack[-1].unseen
            if drawing and tag in ("text", "foreignobject") and not visibility:
                unseen = stack[nearest(("svg",))].attributes.get("unseen") is not None
            if drawing and tag == "text":
                tag = SVG_TEXT
            if tag == "svg":  # shapes hold no text of their own; what they stand in decides for the text inside
                attributes, unseen = {**({"unseen": ""} if unseen else {})}, True
            node = Element(tag, hidden, unseen, attributes)
            if (label := _label(tag, attributes)) and not unseen:
                node.children += [label]
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*/?>|\Z", re.I).search(html, at)
                if not unseen:
                    node.children.append(unescape(html[at : end.start()]) if tag in ("textarea", "title") else html[at : end.start()])
                at = end.end()
            elif tag == "form" and stack[-1].tag in ("table", *SECTIONS):
                continue  # by the HTML standard such a form holds nothing, so it hides nothing either
            elif tag not in VOID and not (m[3].endswith("/") and nearest(("math", "svg"))):
                where.setdefault(tag, []).append(len(stack))
                stack.append(node)
    return root


class Layout:
    """Lines under way: text runs join with single blanks, blocks begin lines, spaced blocks leave a blank line.

    Open list items each put their mark before their first line and blanks before the others; there
    are no blank lines in them.
    """

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = False
        self.marks: list[str] = []
        self.begun, self.blanks = 0, 0  # items that have a line, and the width of their marks

    def text(self, text: str) -> None:
        self.run.append(text)

    def end_line(self, given: str | None = None) -> None:
        line = _BLANKS.sub(" ", "".join(self.run)).strip(" ") if given is None else given.rstrip()
        self.run = []
        if line or given is not None and not self.marks and self.lines and not self.gap:
            self.add(line)

    def add(self, line: str) -> None:
        if self.gap and self.lines and not self.marks:
            self.lines.append("")
        self.gap = False
        new = self.marks[self.begun :]
        self.lines.append("".join([" " * self.blanks, *new, line]))
        self.blanks += sum(map(len, new))
        self.begun = len(self.marks)

    def begin_item(self, mark: str) -> None:
        """An item after the line under way; a gap before it is kept for the outermost's first line."""
        if self.gap and self.lines and not self.marks:
            self.lines.append("")
        self.gap = False
        self.marks.append(mark)

    def end_item(self) -> None:
        self.end_line()
        if self.begun < len(self.marks):
            self.add("")
        self.begun -= 1
        self.blanks -= len(self.marks.pop())
        self.gap = False

    def space(self) -> None:
        self.end_line()
        self.gap = True


#: A step of the renderer: it yields further steps instead of calling them, and gets their results.
Step = Generator["Step", "str | None", "str | None"]


def _run(step: Step) -> str | None:
    """Run a step and those it yields on a stack of its own, so that trees of any depth are rendered."""
    stack, result = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(result))
            result = None
        except StopIteration as done:
            stack.pop()
            result = done.value
    return result


def _holders(table: Element) -> set[int]:
    """Ids of the elements of a table that have rows, cells or captions of it inside."""
    found: set[int] = set()
    above: dict[int, Element] = {}
    todo = [table]
    while todo:
        node = todo.pop()
        for c in node.children:
            if not isinstance(c, Element) or c.hidden or c.tag == "table":
                continue
            if c.tag in PARTS:
                at: Element | None = node
                while at is not None and id(at) not in found:
                    found.add(id(at))
                    at = above.get(id(at))
            if c.tag not in ("td", "th", "caption"):
                above[id(c)] = node
                todo.append(c)
    return found


def _table(table: Element, out: Layout, indent: int) -> Step:
    """Captions and all text outside cells as lines, then the rows, aligned.

    A row or section that is left out is implied, and cells and rows are found through other
    elements around them.
    """
    out.space()
    holders = _holders(table)
    rows: list[list[tuple[str, int, int]]] = []
    row: list[tuple[str, int, int]] | None = None
    todo = [iter(table.children)]
    ends = [False]
    while todo:
        c = next(todo[-1], None)
        if c is None:
            todo.pop()
            if ends.pop():
                out.end_line()
                row = None
        elif isinstance(c, str):
            out.text(c)
        elif c.hidden:
            continue
        elif c.tag in ("td", "th"):
            out.end_line()
            if row is None:
                rows.append(row := [])
            row.append((" ".join((yield _render(c)).split()), min(max(c.number("colspan", 1), 1), MOST_COLUMNS), c.number("rowspan", 1)))
        elif c.tag == "caption":
            out.end_line()
            yield _write(c, out, indent)
            out.end_line()
        elif c.tag in SECTIONS:
            out.end_line()
            row = None
            if c.tag == "tr":
                rows.append(row := [])
            todo.append(iter(c.children))
            ends.append(True)
        elif id(c) in holders or c.tag == "colgroup":
            todo.append(iter(c.children))
            ends.append(False)
        else:
            holder = Element("div")
            holder.children.append(c)
            yield _write(holder, out, indent)
    out.end_line()
    for line in _aligned(rows):
        out.add(" " * indent + line)
    out.space()


def _width(text: str) -> int:
    """Columns that a text takes: two for a wide character, none for a mark on the one before."""
    if text.isascii():
        return len(text)
    return sum(2 if east_asian_width(c) in "WF" else category(c) not in ("Mn", "Me", "Cf") for c in text)


def _aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of rows of cells (text, columns, rows): each cell begins where its column does, and a
    column is as wide as its widest cell. Rows without any text are left out."""
    grid: list[list[tuple[int, int, str]]] = []  # (column, columns, text)
    taken: dict[int, int] = {}  # rows that cells above still reach into each column
    for row in rows:
        placed, column, reach = [], 0, {k: n - 1 for k, n in taken.items() if n > 1}
        for text, across, down in row:
            while column in taken:
                column += 1
            placed.append((column, across, text))
            if down > 1 or down == 0:  # zero: to the end of the table
                reach.update(dict.fromkeys(range(column, column + across), down - 1 if down else len(rows)))
            column += across
        grid.append(placed)
        taken = reach
    grid = [[c for c in row if c[2]] for row in grid]
    used = sorted({c[0] for row in grid for c in row})
    width = dict.fromkeys(used, 0)
    inside = lambda column, across: [k for k in used[bisect_left(used, column) :] if k < column + across]
    for row in sorted((c for r in grid for c in r), key=lambda c: c[1]):
        column, across, text = row
        columns = inside(column, across) if across > 1 else [column]
        lack = _width(text) - sum(width[k] + 2 for k in columns) + 2
        if lack > 0:
            width[columns[-1]] += lack
    place, at = {}, 0
    for k in used:
        place[k] = at
        at += width[k] + 2
    lines = []
    for row in grid:
        line = ""
        for column, _, text in row:
            line += " " * (place[column] - _width(line)) + text
        if line:
            lines.append(line)
    return lines


def _write(node: Element, out: Layout, indent: int, pre: bool = False) -> Step:
    pre = pre or node.tag == "pre"
    number, step = node.number("start", 1), 1
    if node.tag == "ol" and "reversed" in node.attributes:
        step, number = -1, node.number("start", sum(isinstance(c, Element) and c.tag == "li" and not c.hidden for c in node.children))
    children = node.children
    if node.tag == "details" and "open" not in node.attributes:
        children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
    for c in children:
        if isinstance(c, str):
            if pre:
                *whole, rest = c.split("\n")
                for line in whole:
                    out.end_line(" " * indent + "".join(out.run) + line)
                out.text(rest)
            else:
                out.text(c)
            continue
        if c.hidden:
            continue
        tag = c.tag
        if tag == "br":
            out.end_line()
        elif tag == "table":
            yield _table(c, out, indent)
        elif tag == "li" and not c.unseen:
            out.end_line()
            number = c.number("value", number) if node.tag == "ol" else number
            out.begin_item(" " * indent + (f"{number}. " if node.tag == "ol" else "- "))
            number += step
            yield _write(c, out, 0)
            out.end_item()
        elif tag in ("ul", "ol", "menu", "dir"):
            nested = node.tag in ("li", "ul", "ol", "menu", "dir")
            out.end_line() if nested else out.space()
            yield _write(c, out, indent)
            out.end_line() if nested else out.space()
        elif tag in BLOCK:
            out.space() if tag in SPACED else out.end_line()
            yield _write(c, out, indent + 2 if tag in ("blockquote", "dd") else indent, pre)
            if (pre or tag == "pre") and out.run:
                out.end_line(" " * indent + "".join(out.run))
            out.space() if tag in SPACED else out.end_line()
        elif c.children:
            yield _write(c, out, indent, pre)


def _render(node: Element) -> Step:
    out = Layout()
    yield _write(node, out, 0)
    out.end_line()
    return "\n".join(out.lines)


def render(node: Element) -> str:
    """Visible text of a tree."""
    return _run(_render(node))


def extract(html: str | None) -> str | None:
    """Visible text of a page; null for null, empty for a page without any."""
    return None if html is None else render(parse(html))


def extract_pages(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All rows of ``pages`` with the visible text added (replacing a column of that name).

    A null page has null text; an empty one, or one with nothing to see, empty text. Rows are
    independent, so there is no shuffle; equal rows give equal text.
    """
    rest = pages.drop(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields) + f", `{text_col}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, html_col):
                found = [extract(h) for h in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*part.schema.names, text_col])

    return rest.mapInArrow(tidy(run), schema)
