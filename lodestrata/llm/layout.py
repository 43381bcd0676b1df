"""Visible text of HTML pages, laid out.

A scanner and a tree builder with the implied tags that browsers add (html,
head, body, ends of p, li, dt, dd, option, cells, rows and row groups), content
that a table can't hold put before it, then visibility rules, then a renderer:
blocks on lines of their own with the blank lines that they'd have, list items
with marks and indents, table cells in aligned columns, ``pre`` as it is, other
white space collapsed.

Time and output grow in proportion to a page, whatever its markup: open elements
are looked up by name, the scanner never goes back, and three measures of layout
are bounded (no text is): indents (``INDENT``), the width to which a column is
padded (``COLUMN``), and tables inside tables that are aligned (``NESTED``;
deeper ones have a line a row, their cells two spaces apart).
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDENT, COLUMN, NESTED = 64, 100, 8
#: Pixels of the screen that width conditions of style sheets are held against.
SCREEN = 1280

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("textarea title".split())
HIDDEN = frozenset("head script style template noscript title meta link datalist object iframe noembed noframes audio video canvas param source track area rp desc metadata annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul dir".split())
ENDS_P = BLOCK - frozenset("body html dd dt li option optgroup legend".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())

#: An open element that a start tag ends, and the elements beyond which it isn't looked for.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: End tags of other elements don't reach beyond these.
_WALLS = frozenset("table td th caption html template".split())
_TABLE = frozenset("table tbody thead tfoot tr td th caption colgroup".split())
_GROUPS = frozenset("tbody thead tfoot".split())
#: Where text and other elements can't stand: they're put before the table.
_FOSTER = frozenset("table tbody thead tfoot tr".split())
_STAYS = frozenset("script style template col form".split()) | _TABLE
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_NAME = re.compile(r"[a-zA-Z][^ \t\n\r\f/>]*+")
#: The next attribute of a start tag, or its end; a quote that isn't closed leaves its group for the closing one empty.
_ATTR = re.compile(r"[ \t\n\r\f/]*+(?:(>)|(=?[^ \t\n\r\f/>=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"([^\"]*+)(\"?)|'([^']*+)('?)|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+)?))?)")
_COMMENT_END, _BOGUS_END = re.compile(r"-->|(?<!<!)--!>"), re.compile(">")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_BLANK = " \t\n\r\f"


class Node:
    __slots__ = ("attrs", "kids", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.kids = name, attrs, []


class Builder:
    """The tree of a page; ``styles`` are (media, text) of its style elements, ``depth`` the most open elements."""

    def __init__(self, html: str):
        self.root = Node("html", {})
        self.stack, self.places, self.body, self.styles, self.depth = [self.root], {}, None, [], 1
        self._scan(html)

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.stack))
        self.stack.append(node)
        self.depth = max(self.depth, len(self.stack))

    def _cut(self, n: int) -> None:
        """Leave n elements open."""
        while len(self.stack) > n:
            self.places[self.stack.pop().name].pop()

    def _last(self, names) -> int:
        """How deep the innermost open element of these names is; 0: none is open."""
        at = 0
        for x in names:
            if p := self.places.get(x):
                at = max(at, p[-1])
        return at

    def _close(self, names, walls) -> bool:
        """End the innermost open element of these names, if no wall stands before it."""
        at = self._last(names)
        if at <= (self.body is not None) or at < self._last(walls):
            return False
        self._cut(at)
        return True

    def _in_body(self) -> None:
        """Content outside the head implies the body."""
        if self.body is None:
            self._cut(1)
            self.body = Node("body", {})
            self.root.kids.append(self.body)
            self._push(self.body)

    def _add(self, x: Node | str, stays: bool) -> None:
        kids = self.stack[-1].kids
        if not stays and self.stack[-1].name in _FOSTER and (at := self._last(("table",))):
            kids = self.stack[at - 1].kids
            kids.insert(len(kids) - 1, x)  # an open table is the last of its parent's
        else:
            kids.append(x)

    def _text(self, s: str) -> None:
        blank = not s.strip(_BLANK)
        if self.body is None:
            if blank:
                return
            self._in_body()
        if s:
            self._add(unescape(s), blank)

    def _scan(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                return
            after = html[lt + 1 : lt + 2]
            closing = after == "/"
            name = _NAME.match(html, lt + 1 + closing)
            if not name and after not in ("!", "?", "/"):
                # No tag: the sign is text, up to the next one.
                end = html.find("<", lt + 1)
                self._text(html[at : end if end >= 0 else n])
                at = end if end >= 0 else n
                continue
            if lt > at:
                self._text(html[at:lt])
            if not name:
                end = (_COMMENT_END if html.startswith("<!--", lt) else _BOGUS_END).search(html, lt + 2)
                if not end:
                    return
                at = end.end()
                continue
            attrs: dict[str, str] = {}
            at = name.end()
            while True:
                a = _ATTR.match(html, at)
                at = a.end()
                if a[1]:
                    break
                if at >= n or a[4] == "" or a[6] == "":
                    return  # the page ends inside a tag, which isn't one then
                if a[2]:
                    attrs.setdefault(a[2].lower(), unescape(a[3] or a[5] or a[7] or ""))
            if closing:
                self._end(name[0].lower())
            elif (at := self._start(name[0].lower(), attrs, html, at)) is None:
                return

    def _end(self, name: str) -> None:
        if name in ("html", "body", "head"):
            if name == "head" and self.body is None:
                self._cut(1)
        elif name == "br" or name == "p" and not self._last(("p",)):
            self._in_body()
            self._add(Node(name, {}), False)
        else:
            # Ends of a table's parts reach through its cells; other ends stay in theirs.
            walls = frozenset(("table",)) if name in _TABLE else _WALLS
            self._close(_HEADINGS if name in _HEADINGS else (name,), walls - {name} if name in walls else walls)

    def _start(self, name: str, attrs: dict[str, str], html: str, at: int) -> int | None:
        """Take a start tag; returns where the scanner goes on, None if that's nowhere."""
        if name == "html":
            for k, v in attrs.items():
                self.root.attrs.setdefault(k, v)
            return at
        if name == "head":
            if self.body is None and len(self.stack) == 1:
                node = Node("head", attrs)
                self.root.kids.append(node)
                self._push(node)
            return at
        if name == "body":
            self._in_body()
            for k, v in attrs.items():
                self.body.attrs.setdefault(k, v)
            return at
        if self.body is None and name not in HEAD_ONLY:
            self._in_body()
        table = self._last(("table",))
        if name == "table" and self.stack[-1].name in _FOSTER:
            self._cut(table or len(self.stack))
        elif name in _TABLE and table and name != "table":
            floor = max(table, self._last(_GROUPS)) if name in ("td", "th", "tr") else table
            row = self._last(("tr",)) if name in ("td", "th") else 0
            self._cut(max(row, floor) + 1)
            if name in ("td", "th") and row < floor:
                implied = Node("tr", {})
                self.stack[-1].kids.append(implied)
                self._push(implied)
        elif name in _CLOSES:
            names, walls = _CLOSES[name]
            self._close(names, walls)
        if name in ENDS_P:
            self._close(("p",), _WALLS | {"button"})
        if name in _HEADINGS and self.stack[-1].name in _HEADINGS:
            self._cut(len(self.stack) - 1)
        if name == "a":
            self._close(("a",), _WALLS)
        node = Node(name, attrs)
        self._add(node, name in _STAYS)
        if name in VOID:
            return at
        if name in RAW or name in ESCAPABLE:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>?", re.I).search(html, at)
            inner = html[at : end.start() if end else len(html)]
            if name == "style":
                self.styles.append((attrs.get("media", ""), inner))
            elif name in ESCAPABLE:
                node.kids.append(unescape(inner))
            return end.end() if end else None
        if name == "plaintext":
            node.kids.append(html[at:])
            return None
        self._push(node)
        return at


_QUERY = re.compile(r"\(\s*(min|max)-(?:device-)?width\s*:\s*([\d.]+)\s*(px|em|rem)?\s*\)")


def _on_screen(media: str) -> bool:
    """Whether a media query holds on a screen; conditions other than on width don't."""
    for part in media.lower().split(","):
        part = part.strip()
        words = re.sub(r"\([^)]*\)", " ", part).replace(" and ", " ").split()
        negated = words[:1] == ["not"]
        words = [w for w in words if w not in ("not", "only", "and")]
        holds = not words or words[0] in ("all", "screen")
        for c in re.findall(r"\([^)]*\)", part):
            q = _QUERY.fullmatch(c)
            px = float(q[2].strip(".") or 0) * (16 if q[3] in ("em", "rem") else 1) if q and q[2].count(".") <= 1 else None
            holds &= px is not None and (px <= SCREEN if q[1] == "min" else px >= SCREEN)
        if holds != negated:
            return True
    return False


def _rules(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules of a style sheet that hold on a screen."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S).replace("<!--", "").replace("-->", "")
    brace, at, mark = re.compile(r"[{}]"), 0, re.compile(r"[{};]")
    while m := mark.search(css, at):
        head, at = css[at : m.start()].strip(), m.end()
        if m[0] != "{":
            continue
        if not head.startswith("@"):
            end = css.find("}", at)
            end = len(css) if end < 0 else end
            yield head, css[at:end]
            at = end + 1
        elif not (re.match(r"@(supports|layer|container)\b", head) or head.startswith("@media") and _on_screen(head[6:])):
            depth = 1
            while depth and (m := brace.search(css, at)):
                depth, at = depth + (1 if m[0] == "{" else -1), m.end()
            if depth:
                return


def _declared(text: str) -> dict[str, tuple[bool, str]]:
    """display and visibility among declarations: (important, value)."""
    out: dict[str, tuple[bool, str]] = {}
    for d in text.lower().split(";"):
        k, _, v = d.partition(":")
        if (k := k.strip()) in ("display", "visibility"):
            strong = v.strip().endswith("!important") or "!" in v and v.partition("!")[2].strip() == "important"
            if strong or not out.get(k, (False,))[0]:
                out[k] = strong, v.partition("!")[0].strip()
    return out


_SELECTOR = re.compile(r"(?:\*|[\w-]+)?(?:[.#][\w-]+)?")


class Look:
    """What style sheets say of elements' display and visibility: simple selectors (*, tag, .class, #id, tag.class, tag#id), the stronger and then the later one wins."""

    def __init__(self, styles: list[tuple[str, str]]):
        self.said: dict[str, dict[str, tuple]] = {}
        n = 0
        for media, css in styles:
            for names, body in _rules(css) if _on_screen(media) else ():
                got = _declared(body)
                for x in names.split(",") if got else ():
                    x = x.strip()
                    if not x or not _SELECTOR.fullmatch(x):
                        continue
                    tag, sign, rest = re.fullmatch(r"([^.#]*)([.#]?)(.*)", x).groups()
                    n += 1
                    own = self.said.setdefault(("" if tag == "*" and sign else tag.lower()) + sign + rest, {})
                    for k, (strong, v) in got.items():
                        new = strong, (sign == "#", sign == ".", tag not in ("", "*")), n, v
                        if k not in own or new > own[k]:
                            own[k] = new

    def of(self, node: Node) -> tuple[bool, str | None]:
        """(whether it is displayed, its own visibility)."""
        a, got = node.attrs, {}
        if self.said:
            own = ["*", node.name]
            if "id" in a:
                own += [f"#{a['id']}", f"{node.name}#{a['id']}"]
            for c in a.get("class", "").split():
                own += [f".{c}", f"{node.name}.{c}"]
            for x in own:
                for k, v in self.said.get(x, {}).items():
                    if k not in got or v > got[k]:
                        got[k] = v
        got = {k: (v[0], v[3]) for k, v in got.items()}
        if "style" in a:
            for k, (strong, v) in _declared(a["style"]).items():
                if strong or not got.get(k, (False,))[0]:
                    got[k] = strong, v
        if node.name in HIDDEN or node.name == "input" or node.name == "dialog" and "open" not in a:
            return False, None
        display = got["display"][1] if "display" in got else "none" if "hidden" in a else ""
        return display != "none", got["visibility"][1] if "visibility" in got else None


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum((unicodedata.east_asian_width(c) in "WF") + (unicodedata.combining(c) == 0) for c in s)


class Page:
    """The lines of a rendered page, or of a cell in one."""

    def __init__(self, look: Look, nested: int = 0, seen: bool = True, drawn: bool = False):
        self.look, self.nested = look, nested
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space, self.indent, self.gap = False, "", 0
        self.mark = ""
        #: Whether text is visible here, and whether it's in a drawing, where only text elements show.
        self.seen, self.drawn = seen, drawn

    def put(self, s: str, pre: bool) -> None:
        if not self.seen or self.drawn:
            return
        if pre:
            parts = s.replace("\r\n", "\n").split("\n")
            for i, p in enumerate(parts):
                if i:
                    self.end(True)
                if p:
                    self.now.append(p)
            return
        lead, tail = s[:1] in _BLANK, s[-1:] in _BLANK
        s = _SPACE.sub(" ", s).strip(" ")
        if not s:
            self.space |= bool(self.now)
            return
        if self.now and (lead or self.space):
            self.now.append(" ")
        self.now.append(s)
        self.space = tail

    def end(self, keep: bool = False) -> None:
        """The line ends; ``keep``: even if it is empty."""
        s = "".join(self.now).rstrip(" ")
        self.now, self.space = [], False
        if not s and not keep:
            return
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        indent = self.indent[: max(0, len(self.indent) - len(self.mark))] + self.mark if self.mark else self.indent
        self.lines.append(indent + s if s else "")
        if s:
            self.mark = ""

    def part(self, spaced: bool) -> None:
        self.end()
        if spaced and self.lines:
            self.gap = 1

    def walk(self, node: Node, pre: bool = False) -> None:
        """Render a node's children."""
        number = 0
        if node.name == "ol":
            start = node.attrs.get("start", "1").strip()
            number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
        summary = node.name == "details" and "open" not in node.attrs
        for kid in node.kids:
            if isinstance(kid, str):
                if not summary:
                    self.put(kid, pre)
                continue
            name = kid.name
            shown, visibility = self.look.of(kid)
            if not shown or summary and name != "summary":
                continue
            was = self.seen, self.drawn
            if visibility is not None:
                self.seen = self.seen if visibility == "inherit" else visibility not in ("hidden", "collapse")
            if name == "br":
                self.end(True)
            elif name == "hr":
                self.part(True)
                if self.seen:
                    self.now.append("---")
                self.part(True)
            elif name == "img":
                if kid.attrs.get("alt", "").strip():
                    self.put(kid.attrs["alt"], False)
            elif name == "table":
                self.part(True)
                self.table(kid)
                self.part(True)
            elif name == "li":
                number += 1
                own = f"{number}. " if node.name == "ol" else "- "
                self.part(False)
                before = self.indent
                self.indent, self.mark = (before + " " * len(own))[:INDENT], own
                self.walk(kid, pre)
                self.part(False)
                self.indent, self.mark = before, ""
            elif name in BLOCK:
                spaced = name in SPACED and not (name in ("ul", "ol", "menu", "dir") and node.name == "li")
                self.part(spaced)
                before = self.indent
                if name in ("blockquote", "dd"):
                    self.indent = (before + "  ")[:INDENT]
                self.walk(kid, pre or name in ("pre", "listing"))
                self.part(spaced)
                self.indent = before
            elif name == "q":
                self.put('"', pre)
                self.walk(kid, pre)
                self.put('"', pre)
            elif name in ("td", "th", "tr", "tbody", "thead", "tfoot"):
                self.walk(kid, pre)
                self.put(" ", False)
            else:
                if name == "svg":
                    self.drawn = True
                elif name in ("text", "foreignobject"):
                    self.drawn = False
                self.walk(kid, pre or name == "textarea")
                if name == "text" and was[1]:
                    self.drawn = False
                    self.put(" ", False)
            self.seen, self.drawn = was

    def table(self, node: Node) -> None:
        """Cells in columns as wide as their widest line; a cell that spans several takes the first."""
        rows: list[list[tuple[int, list[str]]]] = []
        held: list[list[int]] = []  # first column, the one after the last, rows to go: of cells that reach into further rows
        self.rows(node, rows, held)
        self.end()
        widths: dict[int, int] = {}
        for row in rows:
            for j, cell in row:
                for line in cell:
                    widths[j] = max(widths.get(j, 0), _width(line))
        starts, at = {}, 0
        for j in sorted(widths):
            starts[j] = at
            at += min(widths[j], COLUMN) + 2
        for row in rows:
            full = [(starts[j], cell) for j, cell in row if cell]
            for i in range(max([len(c) for _, c in full], default=0)):
                line, wide = [], 0
                for start, cell in full:
                    if i < len(cell) and cell[i]:
                        gap = max(start - wide, 2 if wide else 0)
                        line.append(" " * gap + cell[i])
                        wide += gap + _width(cell[i])
                self.now = line
                self.end(True)

    def rows(self, node: Node, rows: list, held: list) -> None:
        for k in node.kids:
            if isinstance(k, str):
                self.put(k, False)
                continue
            shown, visibility = self.look.of(k)
            if not shown:
                continue
            was = self.seen
            if visibility is not None:
                self.seen = self.seen if visibility == "inherit" else visibility not in ("hidden", "collapse")
            if k.name in _GROUPS:
                self.rows(k, rows, held)
                held.clear()  # no cell reaches out of its group
            elif k.name == "tr":
                self.end()
                self.row(k, rows, held)
            elif k.name == "caption":
                self.walk(k)
                self.end()
            elif k.name not in ("col", "colgroup"):
                self.walk(_wrap(k))
            self.seen = was

    def row(self, node: Node, rows: list, held: list) -> None:
        row, at, next_held, over = [], 0, [], 0
        for c in node.kids:
            if isinstance(c, str):
                self.put(c, False)
                continue
            shown, visibility = self.look.of(c)
            if not shown:
                continue
            seen = self.seen if visibility in (None, "inherit") else visibility not in ("hidden", "collapse")
            while over < len(held) and held[over][0] <= at:
                at = max(at, held[over][1])
                over += 1
            cell = c if c.name in ("td", "th") else _wrap(c)
            if self.nested >= NESTED:
                was, self.seen = self.seen, seen
                if self.now:
                    self.now.append("  ")
                    self.space = False
                self.walk(cell)
                self.seen = was
                continue
            page = Page(self.look, self.nested + 1, seen, self.drawn)
            page.walk(cell)
            page.end()
            row.append((at, page.lines))
            wide, tall = _span(c.attrs.get("colspan"), 1000), _span(c.attrs.get("rowspan"), 65534)
            if tall > 1:
                next_held.append([at, at + wide, tall])
            at += wide
        rows.append(row)
        if self.nested >= NESTED:
            self.end()
        joined: list[list[int]] = []
        for first, last, left in sorted([h for h in held if h[2] > 0] + next_held):
            if joined and joined[-1][1] == first and joined[-1][2] == left:
                joined[-1][1] = last
            else:
                joined.append([first, last, left])
        held[:] = [[a, b, n - 1] for a, b, n in joined if n > 1]


def _wrap(node: Node) -> Node:
    out = Node("div", {})
    out.kids.append(node)
    return out


def _span(v: str | None, most: int) -> int:
    """A span as the HTML standard has it: ``most`` is its limit there."""
    return min(int(v), most) if v and re.fullmatch(r"\s*[1-9]\d{0,8}\s*", v) else 1


def render(html: str | None) -> str | None:
    """All visible text of a page; null of null, empty of empty."""
    if html is None:
        return None
    tree = Builder(html)
    look = Look(tree.styles)
    page = Page(look)
    shown, visibility = look.of(tree.root)
    if shown:
        page.seen = visibility not in ("hidden", "collapse")
        before = sys.getrecursionlimit()
        sys.setrecursionlimit(before + 6 * tree.depth + 1000)  # calls of Python by Python take heap, not stack
        try:
            page.walk(tree.root)
        finally:
            sys.setrecursionlimit(before)
        page.end()
    lines = page.lines
    first, last = 0, len(lines)
    while last > first and not lines[last - 1]:
        last -= 1
    while first < last and not lines[first]:
        first += 1
    return "\n".join(lines[first:last])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id long, text string) of each row of ``pages``.

    A null page gives a null text, one without visible text an empty one.
    Ids are cast to long; what can't be cast is null. Repeated rows and null ids
    keep their rows; an empty table gives an empty one; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([render(x) for x in part.column(1).to_pylist()], pa.string())], ["page_id", "text"])

    return pages.select(F.expr(f"try_cast(`{id_col}` as long)").alias("page_id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, text string")
