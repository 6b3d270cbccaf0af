"""HTML extraction by layout-aware rendering.

A page is cut into tags and text, a tree is built with the tags that HTML
lets authors leave out, and the tree is rendered as text the way a reader
would see it: all visible text, in order, nothing else.

* Implied tags: paragraphs end before blocks, list items, table cells, rows,
  options and definition parts end before the next one, the head ends before
  the first content, stray end tags are ignored, text straight inside a table
  goes in front of it.
* Visibility: head, scripts, styles, templates, embedded content, closed
  ``details`` and ``dialog``, and elements with ``hidden`` or an inline style
  of ``display: none`` or ``visibility: hidden`` are not shown.
* Layout: paragraphs, headings, lists and tables are set off by blank lines,
  other blocks by line breaks; white space is collapsed except in ``pre``;
  list items have markers and indents; cells of a table are aligned in columns.

Pages are independent: one narrow pass, no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm import flat

# ---- fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_PARTS = frozenset("base link meta title style script noscript template".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
TEXT_ONLY = frozenset("title textarea".split())
HIDDEN = frozenset("head title rp script style template iframe noembed noframes noscript object audio video canvas svg math datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table pre listing xmp blockquote figure hr fieldset form".split())
BLOCK = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt fieldset figcaption footer header hgroup html legend li main nav "
    "optgroup option search section summary caption tr td th thead tbody tfoot".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li listing main menu nav ol p pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
IN_TABLE = ROW_GROUPS | {"table", "tr"}
#: A start tag ends open elements of the first set, as far out as the second set.
ENDS: dict[str, tuple[frozenset, frozenset]] = {
    "li": (frozenset({"li"}), LISTS | {"table", "td", "th"}),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl", "table", "td", "th"})),
    "dt": (frozenset({"dd", "dt"}), frozenset({"dl", "table", "td", "th"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (frozenset({"td", "th", "caption"}), frozenset({"table"})),
    "th": (frozenset({"td", "th", "caption"}), frozenset({"table"})),
    "tr": (frozenset({"tr", "caption"}), frozenset({"table"})),
    **{g: (ROW_GROUPS | {"caption", "colgroup"}, frozenset({"table"})) for g in ROW_GROUPS},
}
#: End tags don't reach beyond these, save those of the table's own parts.
WALLS = frozenset("table td th caption template".split())
TABLE_PARTS = IN_TABLE | frozenset("td th caption".split())
#: Elements nest this deep; deeper ones become children of the last that fits.
DEPTH = 200
#: Columns wider than this are not padded.
WIDEST = 60

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"'=]++|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[=\"'])*+)(?P<close>>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>(?:[^<]++|<(?![A-Za-z!?/]))++)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SPACE = " \t\n\r\f"


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        found: dict[str, str] = {}
        for name, a, b, c in _ATTRIBUTE.findall(self.attrs):
            found.setdefault(name.lower(), html.unescape(a or b or c))
        return found

    def shown(self) -> bool:
        if self.tag in HIDDEN:
            return False
        if not self.attrs.strip(" /"):
            return self.tag != "dialog"
        own = self.attributes()
        if "hidden" in own or _INVISIBLE.search(own.get("style", "")):
            return False
        return not (self.tag == "input" and own.get("type", "").lower() == "hidden") and (self.tag != "dialog" or "open" in own)


def parse(page: str) -> Node:
    """Tree of a page."""
    root = Node("html")
    stack = [root]
    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        if m is None:  # a lone "<" at the end
            _text(stack, page[at:])
            break
        at = m.end()
        if m["text"] is not None:
            _text(stack, html.unescape(m["text"]))
        elif m["tag"] is None:
            continue
        elif not m["close"]:  # the page ends inside a tag
            break
        elif m["end"]:
            _end(stack, m["tag"].lower())
        else:
            tag = m["tag"].lower()
            node = _start(stack, tag, m["attrs"])
            if tag in RAW or tag in TEXT_ONLY:
                stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                inner = page[at : stop.start() if stop else len(page)]
                at = stop.start() if stop else len(page)
                if node is not None:
                    node.kids.append(html.unescape(inner) if tag in TEXT_ONLY else inner)
    return root


def _leave_head(stack: list[Node]) -> None:
    if len(stack) > 1 and stack[-1].tag == "head":
        stack.pop()


def _parent(stack: list[Node]) -> list:
    """Where content that a table can't hold goes: in front of the table."""
    if stack[-1].tag not in IN_TABLE:
        return stack[-1].kids
    k = max(i for i, n in enumerate(stack) if n.tag in IN_TABLE and (i == 0 or stack[i - 1].tag not in IN_TABLE))
    return stack[k - 1].kids if k else stack[-1].kids


def _text(stack: list[Node], text: str) -> None:
    if text.strip(_SPACE):
        _leave_head(stack)
    elif stack[-1].tag in IN_TABLE or stack[-1].tag == "head":
        return
    place = _parent(stack)
    if place is stack[-1].kids:
        place.append(text)
    else:
        place.insert(len(place) - 1, text)


def _close(stack: list[Node], tags: frozenset, walls: frozenset) -> None:
    """End the outermost open element of ``tags`` that lies inside the nearest of ``walls``."""
    found = None
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            found = k
        elif stack[k].tag in walls:
            break
    if found:
        del stack[found:]


def _start(stack: list[Node], tag: str, attrs: str) -> Node | None:
    if tag in ("html", "body"):  # there is one of each; what a second one says is left out
        if tag == "body":
            _leave_head(stack)
        return None
    if tag not in HEAD_PARTS and tag != "head":
        _leave_head(stack)
    if tag in ENDS_P:
        _close(stack, frozenset({"p"}), WALLS | {"button"})
    if tag in HEADINGS and stack[-1].tag in HEADINGS:
        stack.pop()
    if tag in ENDS:
        _close(stack, *ENDS[tag])
    node = Node(tag, attrs)
    place = _parent(stack) if tag not in TABLE_PARTS and tag not in ("colgroup", "col", "script", "style", "template") else stack[-1].kids
    if place is stack[-1].kids:
        place.append(node)
    else:
        place.insert(len(place) - 1, node)
    if tag not in VOID and len(stack) < DEPTH:
        stack.append(node)
    return node


def _end(stack: list[Node], tag: str) -> None:
    if tag == "br":
        _start(stack, "br", "")
    if tag in ("html", "body"):
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag or tag in HEADINGS and stack[k].tag in HEADINGS:
            del stack[k:]
            return
        if stack[k].tag in WALLS and tag not in TABLE_PARTS:
            break
    if tag == "p":  # an end tag without a paragraph makes an empty one
        _start(stack, "p", "")
        stack.pop()


class Flow:
    """Lines of rendered text. ``gap``: a blank line is due before the next one."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False

    def text(self, text: str, kept: bool) -> None:
        if kept:
            parts = text.replace("\r\n", "\n").split("\n")
            for part in parts[:-1]:
                self.now.append(part)
                self.line(kept=True)
            self.now.append(parts[-1])
            return
        words = text.split()
        if not words:
            if text and self.now and not self.now[-1].endswith(" "):
                self.now.append(" ")
            return
        if text[0].isspace() and self.now and not self.now[-1].endswith(" "):
            self.now.append(" ")
        self.now.append(" ".join(words))
        if text[-1].isspace():
            self.now.append(" ")

    def line(self, kept: bool = False) -> None:
        """End the current line."""
        text = "".join(self.now).rstrip() if kept else "".join(self.now).strip()
        if text or kept and self.lines and not self.gap:
            self.add([text])
        self.now = []

    def add(self, lines: list[str]) -> None:
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines += lines
            self.gap = False

    def space(self) -> None:
        self.line()
        self.gap = True

    def finish(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def render(node: Node) -> list[str]:
    flow = Flow()
    _walk(node, flow, False)
    return flow.finish()


def _walk(node: Node, flow: Flow, kept: bool) -> None:
    for kid in node.kids:
        if isinstance(kid, str):
            flow.text(kid, kept)
        elif kid.shown():
            _element(kid, flow, kept, nested=node.tag == "li")


def _element(node: Node, flow: Flow, kept: bool, nested: bool) -> None:
    tag = node.tag
    if tag == "br":
        if "".join(flow.now).strip():
            flow.line()
        else:
            flow.gap = True
    elif tag == "input":
        own = node.attributes()
        if own.get("type", "").lower() in ("submit", "button", "reset"):
            flow.text(f" {own.get('value', '')} ", False)
    elif tag not in BLOCK and tag not in ("details", "textarea", "img"):
        _walk(node, flow, kept)
    else:
        around = flow.space if tag in SPACED and not (nested and tag in LISTS) else flow.line
        around()
        if tag in LISTS:
            _list(node, flow)
        elif tag == "table":
            flow.add(_table(node))
        elif tag in ("blockquote", "dd"):
            flow.add(["  " + x if x else x for x in render(node)])
        elif tag == "details" and "open" not in node.attributes():
            for kid in node.kids:
                if isinstance(kid, Node) and kid.tag == "summary" and kid.shown():
                    _walk(kid, flow, kept)
                    break
        else:
            _walk(node, flow, kept or tag in ("pre", "listing", "xmp", "textarea"))
            if tag in ("pre", "listing", "xmp", "textarea"):
                flow.line(kept=bool("".join(flow.now).strip()))
        around()


def _number(text: str, usual: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text)
    return int(m[1]) if m else usual


def _list(node: Node, flow: Flow) -> None:
    """Items with markers; what belongs to an item is indented behind its marker."""
    at = _number(node.attributes().get("start", ""), 1) if node.tag == "ol" else 0
    for kid in node.kids:
        if isinstance(kid, str):
            flow.text(kid, False)
        elif kid.tag != "li":
            if kid.shown():
                _element(kid, flow, False, nested=True)
        elif kid.shown():
            flow.line()
            if node.tag == "ol":
                at = _number(kid.attributes().get("value", ""), at)
            mark = f"{at}. " if node.tag == "ol" else "- "
            lines = render(kid)
            flow.add([(mark if k == 0 else " " * len(mark)) + x if x else x for k, x in enumerate(lines)])
            at += 1
    flow.line()


def _rows(node: Node) -> Iterator[Node]:
    for kid in node.kids:
        if isinstance(kid, Node) and kid.shown():
            if kid.tag == "tr":
                yield kid
            elif kid.tag in ROW_GROUPS:
                yield from _rows(kid)
            elif kid.tag in ("td", "th"):  # cells without a row
                row = Node("tr")
                row.kids = [kid]
                yield row


def _table(node: Node) -> list[str]:
    """Cells in aligned columns, two spaces between them; spanned places stay empty."""
    rows = list(_rows(node))
    taken: set[tuple[int, int]] = set()
    grid: list[list[tuple[int, int, list[str]]]] = []
    for r, row in enumerate(rows):
        at, cells = 0, []
        for kid in row.kids:
            if isinstance(kid, str) or not kid.shown():
                continue
            while (r, at) in taken:
                at += 1
            own = kid.attributes() if kid.attrs else {}
            wide = min(max(_number(own.get("colspan", ""), 1), 1), 1000)
            high = min(max(_number(own.get("rowspan", ""), 1), 1), len(rows) - r)
            if high > 1:
                taken.update((r + i, at + j) for i in range(1, high) for j in range(wide))
            cells.append((at, wide, render(kid)))
            at += wide
        grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for at, wide, lines in cells:
            if wide == 1 and lines:
                width[at] = max(width.get(at, 0), min(WIDEST, max(map(len, lines))))
    columns = sorted(width)
    start = {}
    place = 0
    for c in columns:
        start[c] = place
        place += width[c] + 2
    captions = [x for kid in node.kids if isinstance(kid, Node) and kid.tag == "caption" and kid.shown() for x in render(kid)]
    out = captions
    for cells in grid:
        for k in range(max((len(lines) for _, _, lines in cells), default=0)):
            text = ""
            for at, _, lines in cells:
                if k < len(lines) and lines[k]:
                    gap = max(start.get(at, 0) - len(text), 2 if text else 0)
                    text += " " * gap + lines[k]
            if text.strip():
                out.append(text.rstrip())
    return out


def extract(page: str) -> str:
    """All visible text of a page."""
    return "\n".join(render(parse(page)))


def _run(extra: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in flat.blocks(batches, text="html", size=1 << 20):
            texts = [extract(h) if h else "" for h in block.column("html").to_pylist()]
            columns = [*(block.column(c) for c in extra), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Visible text of every whole page: the columns in ``keep``, text and n_lines.

    NULL, empty and invisible pages give the empty text and no lines. Broken
    or truncated markup never fails: what can't be read as a tag is text, and
    a tag cut off by the page's end is left out. Rows are independent, so ties
    and repeats need no rule; columns not named are ignored.
    """
    out = StructType([*pages.select(*keep).schema.fields, *StructType.fromDDL("text string, n_lines int").fields])
    return pages.select(*dict.fromkeys([*keep, "html"])).mapInArrow(_run(list(keep), to_arrow_schema(out)), out)
