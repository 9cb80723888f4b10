"""The visible text of HTML pages, laid out as a reader sees it.

A tokenizer splits a page into tags and text, a tree builder adds what HTML leaves out
(end tags of paragraphs, list items, table cells and the like), and a renderer walks the
tree: blocks stand on lines of their own, paragraphs and headings between blank lines,
list items behind a mark and indented by depth, the cells of a table in aligned columns,
preformatted text as it is, other white space as one space.

Not visible: head, scripts, styles, templates, what browsers show only without scripts or
plug-ins, closed details and dialogs, elements with ``hidden``, ``display:none`` or (until
a descendant is visible again) ``visibility:hidden``, annotations of formulas, definitions
and descriptions in drawings, and the options that a closed select does not show. Formulas,
labels of drawings, text areas and shown options are visible.

The columns of a table are as wide as their longest cell; only where the padding would be
many times the text are wide columns narrowed (:func:`_table_lines`). ``rowspan`` is ignored.

Defined cases: NULL gives NULL; an empty page, and one without visible text, gives the
empty text; broken markup never fails, an unfinished tag is text; a page of any length or
depth is walked without recursion. Repeated rows give equal rows, and columns besides key
and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe noembed noframes object audio video canvas datalist "
    "annotation annotation-xml".split()
)
#: Inside svg these are not drawn where they stand.
SVG_UNSEEN = frozenset("defs desc metadata symbol".split())
#: A colspan counts up to this.
MAX_COLSPAN = 1000
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu table figure".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend li dd dt".split())
#: An element that begins closes these, up to the nearest of the elements in the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: End tags do not reach out of these.
SCOPE = frozenset("table td th caption template html".split())
HEAD_CONTENT = frozenset("base link meta title style script noscript template head html".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_DECLARATION = re.compile(r"<[!?]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in RAW}

_UNQUOTED_END = re.compile(r"=\s*[^\s\"'>]+/$")

#: Padding of a table may be so many times its text, and 64 KB: one long cell beside very
#: many rows would otherwise make a text that grows with the square of the page.
PADDING = 16


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if source:
        for name, value in _ATTRIBUTE.findall(source):
            found.setdefault(name.lower(), unescape(value.strip("\"'")))
    return found


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    stack = [root]
    opened: Counter[str] = Counter()  # how often a tag is on the stack, so that deep pages are not searched in vain

    def cut(i: int) -> None:
        opened.subtract(node.tag for node in stack[i:])
        del stack[i:]

    def close(tags: set[str], until: set[str]) -> None:
        while any(opened[tag] for tag in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in until:
                    return
                if stack[i].tag in tags:
                    cut(i)
                    break

    def text(raw: str) -> None:
        if raw:
            if stack[-1].tag == "head" and not raw.isspace():
                close({"head"}, {"html"})
            stack[-1].children.append(unescape(raw) if "&" in raw else raw)

    at, last = 0, html.rfind(">") + 1  # no tag ends behind
    while True:
        match = _TOKEN.search(html, at, last)
        if match is None:
            text(_DECLARATION.split(html[at:], maxsplit=1)[0])
            return root
        text(html[at : match.start()])
        at = match.end()
        end, tag, rest = match.groups()
        if tag is None:
            if match[0].startswith("<!--") and not match[0].endswith("-->"):
                return root
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
                continue
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in SCOPE and tag not in ("table", "body", "html", "tr", "tbody", "thead", "tfoot"):
                    break
            continue
        if tag == "html":
            root.attributes |= _attributes(rest)
            continue
        if tag not in HEAD_CONTENT:
            close({"head"}, {"html"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in CLOSES_P:
            close({"p"}, SCOPE | {"button"})
        node = Node(tag, _attributes(rest))
        stack[-1].children.append(node)
        if (opened["svg"] or opened["math"]) and rest.endswith("/") and not _UNQUOTED_END.search(rest):
            continue  # only there a tag can end itself
        if tag in RAW:
            stop = _RAW_END[tag].search(html, at)
            inside = html[at : stop.start() if stop else len(html)]
            node.children.append(unescape(inside) if tag == "textarea" else inside)
            at = len(html) if stop is None else html.find(">", stop.end()) + 1 or len(html)
        elif tag not in VOID:
            stack.append(node)
            opened[tag] += 1


_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.IGNORECASE)


def _shown(node: Node) -> bool:
    if node.tag in UNSEEN or "hidden" in node.attributes:
        return False
    if node.tag == "dialog" and "open" not in node.attributes:
        return False
    return not _DISPLAY.search(node.attributes.get("style", ""))


class Page:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.mark = ""
        self.indent = ""
        self.blank = False

    def write(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.line += first
            for part in rest:
                self.end(force=True)
                self.line = part
            return
        text = _SPACE.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        self.line += text

    def end(self, force: bool = False) -> None:
        """End the line, if anything is on it."""
        line = self.line.rstrip(" ")
        self.line = ""
        if not line and not force:
            return
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = self.mark or self.indent
        self.lines.append((lead + line).rstrip(" ") if line or self.mark else "")
        self.mark = ""

    def gap(self) -> None:
        """One blank line before whatever comes next."""
        self.end()
        self.blank = True


def _table_lines(rows: list[list[tuple[int, str]]]) -> list[str]:
    """Rows of (column, text), each column as wide as its longest cell.

    Where that would take more padding than ``PADDING`` allows, the widest columns are
    narrowed until it fits; longer cells there push the rest of their row to the right.
    """
    widths: dict[int, int] = {}
    for row in rows:
        for column, cell in row:
            widths[column] = max(widths.get(column, 0), len(cell))
    allowed = PADDING * sum(len(cell) for row in rows for _, cell in row) + 65_536
    widest = max(widths.values(), default=0)
    while True:
        begins, at = {}, 0
        for column in sorted(widths):
            begins[column] = at
            at += min(widths[column], widest) + 2
        if not widest or sum(begins[row[-1][0]] for row in rows if row) <= allowed:
            break
        widest //= 2
    lines = []
    for row in rows:
        parts, at = [], 0
        for column, cell in row:
            pad = max(begins[column] - at, 2 if parts else 0)
            parts.append(" " * pad + cell)
            at += pad + len(cell)
        lines.append("".join(parts).rstrip())
    return lines


def _shown_options(select: Node) -> list[Node | str]:
    """What a closed select shows: the content of its last selected option, else of its first."""
    options, rest = [], list(reversed(select.children))
    while rest:
        node = rest.pop()
        if isinstance(node, Node):
            if node.tag == "option":
                options.append(node)
            else:
                rest.extend(reversed(node.children))
    chosen = [o for o in options if "selected" in o.attributes][-1:] or options[:1]
    return chosen[0].children if chosen else []


def render(root: Node) -> str:
    """Walk the tree with a stack of steps: a node to enter, or what is to do at its end."""
    page = Page()
    outer: list[tuple[Page, list, list, int]] = []  # tables around: their page, rows, lists and columns so far
    rows: list[list[tuple[int, str]]] = []
    taken = 0  # columns of the row so far
    drawings = 0  # svg elements around
    lists: list[list] = []  # open lists: [next number or None, indent outside]
    steps: list = [(root, True, False)]
    while steps:
        step = steps.pop()
        if callable(step):
            step()
            continue
        node, visible, pre = step
        if isinstance(node, str):
            if visible:
                page.write(node, pre)
            continue
        if not _shown(node) or (drawings and node.tag in SVG_UNSEEN):
            continue
        tag = node.tag
        if found := _VISIBILITY.search(node.attributes.get("style", "")):
            visible = found[1].lower() == "visible"
        if tag == "br":
            page.end(force=True)
            continue
        children = node.children
        if tag == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in ("pre", "textarea"):
            pre = True
        if tag in ("select", "textarea") or (drawings and tag == "text"):
            page.write(" ")
            steps.append(lambda: page.write(" "))
            if tag == "select" and "multiple" not in node.attributes:
                children = _shown_options(node)
        if tag == "svg":
            page.write(" ")
            drawings += 1

            def drawn() -> None:
                nonlocal drawings
                drawings -= 1
                page.write(" ")

            steps.append(drawn)
        elif tag == "table":
            page.gap()
            outer.append((page, rows, lists, taken))
            rows, lists = [], []
            page = Page()

            def done() -> None:
                nonlocal page, rows, lists, taken
                page.end()
                captions, table = page.lines, _table_lines(rows)
                page, rows, lists, taken = outer.pop()
                for line in [*captions, *table]:
                    page.line = line
                    page.end(force=True)
                page.gap()

            steps.append(done)
        elif tag == "tr" and outer:
            rows.append([])
            taken = 0
        elif tag in ("td", "th") and outer:
            if not rows:
                rows.append([])
                taken = 0
            holder = page
            page = Page()
            span = node.attributes.get("colspan", "1")
            columns = min(max(int(span), 1), MAX_COLSPAN) if span.isascii() and span.isdigit() and len(span) < 9 else 1

            def cell_done(holder: Page = holder, row: list = rows[-1], column: int = taken) -> None:
                nonlocal page
                page.end()
                row.append((column, " ".join(" ".join(page.lines).split())))
                page = holder

            taken += columns
            steps.append(cell_done)
        elif tag in ("ul", "ol", "menu", "dir"):
            page.end() if lists else page.gap()
            start = node.attributes.get("start", "1")
            number = int(start) if start.lstrip("-").isascii() and start.lstrip("-").isdigit() and len(start) < 9 else 1
            lists.append([number if tag == "ol" else None, page.indent])

            def list_done() -> None:
                page.end()
                page.indent = lists.pop()[1]
                if not lists:
                    page.gap()

            steps.append(list_done)
        elif tag == "li":
            page.end()
            mark = "- "
            before = page.indent
            if lists:
                before = lists[-1][1]
                if lists[-1][0] is not None:
                    mark = f"{lists[-1][0]}. "
                    lists[-1][0] += 1
            if visible:
                page.mark = before + mark
            page.indent = before + " " * len(mark)

            def item_done(before: str = before) -> None:
                page.end()
                page.mark = ""
                page.indent = before

            steps.append(item_done)
        elif tag == "dd":
            page.end()
            before = page.indent
            page.indent += "    "

            def definition_done(before: str = before) -> None:
                page.end()
                page.indent = before

            steps.append(definition_done)
        elif tag in SPACED:
            page.gap()
            steps.append(lambda: page.gap())
        elif tag in BLOCK:
            page.end()
            steps.append(lambda: page.end())
        steps.extend((child, visible, pre) for child in reversed(children))
    page.end()
    return "\n".join(page.lines)


def visible_text(html: str | None) -> str | None:
    return None if html is None else render(parse(html))


def extract_text(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """key and text of every page. No shuffle."""
    narrow = pages.select(F.col(key).alias("key"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [visible_text(h.as_py()) for h in part["html"]]
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(texts, pa.string())], ["key", "text"])

    return narrow.mapInArrow(run, f"key {narrow.schema['key'].dataType.simpleString()}, text string")
