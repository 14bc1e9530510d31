"""HTML extraction by layout-aware rendering: all visible text of a page, laid out as blocks, lists and tables.

A tree builder reads tags in order and closes what HTML lets authors leave open (paragraphs before blocks, list items,
table rows and cells, options, description terms). Rendering walks the tree: hidden elements are left out (by element, the
hidden attribute or inline style), blank runs collapse outside of pre-formatted text, blocks begin on new lines, paragraphs
and headings stand between empty lines, list items are indented and marked or numbered, and table cells are padded to
columns. Nothing is judged boilerplate: all visible text is kept, also the options of a form, formulas of MathML and the labels
of a drawing (options and labels on lines of their own). What an attribute shows (alternative texts, values, labels of option
groups) is not text of the page here.

Tree and walk use lists, not recursion, so depth is not limited. Reading a page takes time in proportion to its length,
whatever is left open: the tags are found in one pass, and each element knows what a start tag within it would end. Lines are
indented by ``INDENT`` blanks at most and cells padded to ``PAD`` at most; deeper lists and wider cells are whole, but not aligned.

Defined results: a null or empty page has the empty text and counts 0; text outside of any element is visible; an unclosed
tag at the end of a page is dropped, a lone ``<`` is text; repeated rows are rendered alike; input columns named like a
result column are replaced.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import add_in_arrow

# Element names of HTML by their part in layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video canvas desc metadata defs annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
BLOCK = SPACED | frozenset("html body div section article main header footer nav aside address form fieldset legend li dt dd figcaption details summary hr center tr caption dir menu search option optgroup text".split())
ENDS_P = BLOCK - {"html", "body", "li", "dt", "dd", "tr", "caption", "legend", "summary", "option", "optgroup", "text"}
# Which open elements a start tag ends, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, set()),
}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
LIMITS = frozenset("table td th caption button object template".split())  # an open p is not looked for beyond these
FOREIGN = frozenset("svg math".split())
HEAD_ONLY = frozenset("title meta link base style script noscript template".split())

_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile(r"[>\"']")
# Which elements a start tag looks for and where it stops looking, by group; and the group of a start tag.
_REACHES = {**{name: (frozenset(names), frozenset(beyond)) for name, (names, beyond) in CLOSES.items()}, "p": (frozenset({"p"}), LIMITS)}
_GROUPS = tuple(_REACHES)
_MATTERS = frozenset().union(*(names | beyond for names, beyond in _REACHES.values()))
INDENT = 64
PAD = 160
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Tags:
    """Tags, comments and declarations of a page, in one forward pass.

    A tag ends at the first ``>`` outside of quotes. Where none follows, that is remembered for each quote and ``>`` met on
    the way, so that no part of the page is read again for every ``<`` before it.
    """

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.dead: set[int] = set()
        self.special = self.name_end = -1

    def after(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """The next one from ``at``: first and last place + 1, whether an end tag, name (None if no tag), attributes."""
        html, size = self.html, len(self.html)
        at = html.find("<", at)
        while 0 <= at < size - 1:
            then = html[at + 1]
            if html.startswith("<!--", at):
                stop = html.find("-->", at + 4)
                return at, stop + 3 if stop >= 0 else size, False, None, ""
            if self.last < at:
                at = self._comment(at)
                return (at, size, False, None, "") if at >= 0 else None
            if then in "!?":
                return at, html.find(">", at + 2) + 1, False, None, ""
            first = at + 1 + (then == "/")
            if first < size and html[first].isascii() and html[first].isalpha():
                if self.name_end < first:
                    self.name_end = _NAME_END.search(html, first).start()  # there is a > beyond
                stop = self._end(self.name_end)
                if stop >= 0:
                    return at, stop + 1, then == "/", html[first:self.name_end], html[self.name_end:stop]
            at = html.find("<", at + 1)
        return None

    def _comment(self, at: int) -> int:
        """Behind the last ``>`` only an unclosed comment is a token."""
        return self.html.find("<!--", at)

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag, from a place outside of quotes; -1 if none does."""
        html, seen = self.html, []
        if self.special < at:
            found = _SPECIAL.search(html, at)
            self.special = found.start() if found else len(html)
        place = self.special
        while place < len(html) and place not in self.dead:
            mark = html[place]
            if mark == ">":
                return place
            seen.append(place)
            place = html.find(mark, place + 1)
            if place < 0:
                break
            found = _SPECIAL.search(html, place + 1)
            if found is None:
                break
            place = found.start()
        self.dead.update(seen)
        return -1


class Node:
    __slots__ = ("name", "attributes", "children", "up", "foreign", "reach")

    def __init__(self, name: str, attributes: str = "", up: Node | None = None):
        self.name, self.attributes, self.children, self.up = name, attributes, [], up
        # In SVG and MathML a slash closes an element.
        self.foreign = name in FOREIGN or up is not None and up.foreign and name != "foreignobject"
        # For each group of ``_REACHES`` the outermost open element that a start tag in here would end.
        self.reach = up.reach if up is not None else (None,) * len(_GROUPS)
        if name in _MATTERS:
            self.reach = tuple(
                None if name in beyond else self if outer is None and name in names else outer
                for outer, (names, beyond) in zip(self.reach, _REACHES.values()))

    def attribute(self, wanted: str) -> str | None:
        for name, value in _ATTRIBUTE.findall(self.attributes):
            if name.lower() == wanted:
                return unescape(value.strip("\"'"))
        return None

    def hidden(self) -> bool:
        if self.name in UNSEEN:
            return True
        if not self.attributes:
            return False
        style = self.attribute("style")
        return self.attribute("hidden") is not None or bool(style and _HIDING.search(style))


def parse(html: str) -> Node:
    """The tree of a page under a nameless root."""
    root, tags = Node(""), Tags(html)
    here, at, end = root, 0, len(html)
    opened: dict[str, int] = {}  # how many elements of a name are open

    def leave(node: Node) -> Node:
        inner = here
        while inner is not node:
            opened[inner.name] -= 1
            inner = inner.up
        return node

    def close(group: str) -> Node:
        """The node to go on in after ending the outermost open element that the group's start tags end."""
        found = here.reach[_GROUPS.index(group)]
        return leave(found.up) if found is not None else here

    while at < end:
        token = tags.after(at)
        if token is None:
            rest = html[at:]
            lone = re.search(r"<[/a-zA-Z!?]", rest)
            rest = rest[:lone.start()] if lone else rest
            if rest:
                here.children.append(rest)
            break
        start, stop, ends, name, attributes = token
        if start > at:
            text = html[at:start]
            if here.name == "head" and text.strip():
                here = leave(here.up)
            here.children.append(text)
        at = stop
        if name is None:
            continue
        name = name.lower()
        if ends:
            if opened.get(name):
                node = here
                while node.name != name:
                    node = node.up
                here = leave(node.up)
            elif name == "br":
                here.children.append(Node("br", "", here))
            continue
        if here.name == "head" and name not in HEAD_ONLY:
            here = leave(here.up)
        if name in ENDS_P:
            here = close("p")
        if name in CLOSES:
            here = close(name)
        node = Node(name, attributes, here)
        here.children.append(node)
        if node.foreign and attributes.endswith("/"):
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            node.children.append(html[at:stop.start() if stop else end])
            at = stop.end() if stop else end
        elif name not in VOID:
            here = node
            opened[name] = opened.get(name, 0) + 1
    return root


class Lines:
    """Lines of one flow of text; cells of tables have flows of their own."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.blank, self.gap, self.mark, self.indent = False, False, "", 0

    def write(self, text: str, preformatted: bool) -> None:
        if preformatted:
            first, *more = text.replace("\r\n", "\n").split("\n")
            if first:
                self.put(first)
            for part in more:
                self.end(True)
                if part:
                    self.put(part)
            return
        words = _BLANKS.split(text)
        if words == [""]:
            return
        if words[0] == "" and self.line:
            self.blank = True
        kept = " ".join(w for w in words if w)
        if kept:
            self.put(kept)
        if words[-1] == "" and (self.line or kept):
            self.blank = True

    def put(self, text: str) -> None:
        if not self.line:
            if self.gap and self.done:
                self.done.append("")
            self.gap = False
            self.line.append(" " * max(0, min(self.indent, INDENT) - len(self.mark)) + self.mark)
            self.mark = ""
        elif self.blank:
            self.line.append(" ")
        self.blank = False
        self.line.append(text)

    def end(self, even_empty: bool = False) -> None:
        if self.line:
            self.done.append("".join(self.line).rstrip())
        elif even_empty and self.done:
            self.done.append("")
        self.line, self.blank = [], False

    def text(self) -> str:
        self.end()
        while self.done and not self.done[-1]:
            self.done.pop()
        return "\n".join(self.done)


def _table(rows: list[list[str]]) -> list[str]:
    widths = [min(PAD, max((len(r[i]) for r in rows if i < len(r)), default=0)) for i in range(max(map(len, rows), default=0))]
    return [" | ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() for row in rows if any(row)]


def render(root: Node) -> tuple[str, int, int]:
    """Text, list items and table cells of a tree."""
    flow, flows, tables, lists = Lines(), [], [], []
    items = cells = preformatted = 0
    steps: list[tuple] = [(root, False)]
    while steps:
        node, leaving = steps.pop()
        if isinstance(node, str):
            flow.write(unescape(node), preformatted > 0)
            continue
        name = node.name
        if not leaving:
            if node.hidden():
                continue
            if name == "br":
                flow.end(True)
                continue
            if name in BLOCK and not (name == "tr" and tables):
                flow.end()
                if name in SPACED:
                    flow.gap = not (name in ("ul", "ol") and lists)
            if name == "pre":
                preformatted += 1
            elif name in ("ul", "ol", "menu", "dir"):
                start = node.attribute("start") or "1"
                lists.append([name == "ol", int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
                flow.indent += 3 if name == "ol" else 2
            elif name == "li":
                items += 1
                if lists and lists[-1][0]:
                    flow.mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    flow.mark = "- "
            elif name == "dd":
                flow.indent += 2
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                cells += 1
                flows.append((flow, lists))
                flow, lists = Lines(), []
            elif name == "img" and node.attribute("alt"):
                flow.write(node.attribute("alt"), False)
            steps.append((node, True))
            steps.extend((child, False) for child in reversed(node.children))
            continue
        if name == "pre":
            preformatted -= 1
        elif name in ("ul", "ol", "menu", "dir"):
            lists.pop()
            flow.indent -= 3 if name == "ol" else 2
        elif name == "dd":
            flow.indent -= 2
        elif name in ("td", "th") and tables:
            inner = " ".join(x.strip() for x in flow.text().split("\n") if x.strip())
            flow, lists = flows.pop()
            if not tables[-1]:
                tables[-1].append([])
            span = node.attribute("colspan") or "1"
            tables[-1][-1] += [inner] + [""] * (min(int(span), 1000) - 1 if re.fullmatch(r"[0-9]{1,9}", span) else 0)
        elif name == "table":
            for line in _table(tables.pop()):
                flow.end()
                flow.put(line)
        if name in BLOCK and not (name == "tr" and tables):
            flow.end()
            if name in SPACED:
                flow.gap = not (name in ("ul", "ol") and lists)
            if name == "li":
                flow.mark = ""
    return flow.text(), items, cells


def _render_batch(batch: pa.RecordBatch) -> list[pa.Array]:
    found = [render(parse(x.as_py() or "")) for x in batch.column(batch.schema.names.index("html"))]
    texts, items, cells = zip(*found) if found else ((), (), ())
    counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [t.count("\n") + 1 if t else 0 for t in texts], items, cells)]
    return [pa.array(texts, pa.string()), *counts]


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` plus the visible ``text``, its ``n_chars``, ``n_lines``, and the ``n_items`` and ``n_cells`` laid out."""
    return add_in_arrow(pages, "text string, n_chars long, n_lines long, n_items long, n_cells long", _render_batch)
