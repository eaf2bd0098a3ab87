"""Layout-aware text of HTML pages.

One pass over the tags keeps the stack of open elements: start tags imply the end of what cannot
hold them (``p`` before a block, ``li`` before ``li``, cells and rows of tables, ...), end tags
close up to their element if it is open in scope, void elements hold nothing, raw text elements
hold text only.  Elements that a browser does not render hide all they hold: head, scripts,
styles, templates, embedded media and their fallbacks (canvas, object, video, audio, iframe), closed
details and dialogs, ``hidden`` and ``display: none``; ``visibility`` is inherited, so a part of
a hidden element may be shown again; of svg all but its
labels (``text``, ``foreignObject``), of math its annotations and phantoms.  Formulas are written in
the order of their parts, ``textarea`` with its lines.  Left out on purpose, although browsers show
them: the option shown by ``select``, placeholders, and text that style sheets add.

What is visible comes out as laid-out text: white space collapses (but not in ``pre`` or where the ``style`` says so), inline text
flows, blocks start lines, paragraphs and the like stand between blank lines, ``br`` breaks lines,
list items are indented below their list with ``-`` or their number (downwards in a ``reversed`` list with a start), and table cells are set in
columns of equal width (spanning cells take their columns, wide characters two places).

Edge cases: null html is the empty page and gives ``''``; broken or unclosed markup gives the text
that was read; nesting is kept on a stack, so its depth is only bounded by the page; repeated rows
repeat their results; empty tables give empty results; an input column named like the output
column is replaced.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_blocks

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes object video audio canvas datalist area param rp select meta link base".split())
HIDDEN_IN = {"svg": frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()), "math": frozenset("annotation annotation-xml mphantom".split())}
FOREIGN = frozenset(HIDDEN_IN)
#: What holds HTML again inside of foreign elements, and the start tags that end these.
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
LEAVES = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Elements whose parts stand apart, and svg labels.
APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mtable mtr mtd".split())
GAP = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure fieldset hr menu dir".split())
BLOCK = GAP | frozenset("address article aside body center dd details dialog div dt figcaption footer form header hgroup html legend li main nav optgroup option search section summary tr caption thead tbody tfoot td th".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
#: What a start tag closes first, and what that search does not look beyond.
IMPLIED = {
    "li": ({"li"}, LISTS | {"table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "caption": ({"caption"}, {"table"}),
    "body": ({"head"}, set()),
}
IN_HEAD = frozenset("base link meta title style script noscript template".split())
SCOPE = frozenset("table td th caption html template".split())

TAG = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HIDES = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
WHITE_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(pre|pre-wrap|break-spaces|normal|nowrap)\b(?!-)", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
SPACE = re.compile(r"[ \t\n\f\r]+")


def width(s: str) -> int:
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


class Box:
    """Lines of one flow of blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.gap = False
        self.indent, self.marker = "", ""

    def text(self, s: str) -> None:
        """Inline text with collapsed white space."""
        words = SPACE.sub(" ", s)
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        if self.space and self.parts:
            self.parts.append(" ")
        self.space = words[-1] == " "
        self.parts.append(words[:-1] if self.space else words)

    def pre(self, s: str) -> None:
        first, *rest = s.split("\n")
        self.parts.append(first)
        for line in rest:
            self.end_line(True)
            self.parts.append(line)

    def end_line(self, always: bool = False) -> None:
        if self.parts or always:
            self.put("".join(self.parts))
        self.parts, self.space = [], False

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        lead = self.indent
        if self.marker:
            lead, self.marker = self.indent[:-len(self.marker)] + self.marker, ""
        self.lines.append((lead + line).rstrip())

    def block(self, gap: bool) -> None:
        self.end_line()
        self.gap |= gap


class Table:
    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.captions: list[str] = []

    def lines(self) -> list[str]:
        """Cells in columns of equal width, two spaces apart."""
        grid: list[dict[int, tuple[int, list[str]]]] = []
        busy: dict[int, int] = {}
        for row in self.rows:
            at, placed, now = 0, {}, {c: n for c, n in busy.items() if n > 0}
            for span, down, lines in row:
                while now.get(at, 0) > 0:
                    at += 1
                placed[at] = (span, lines)
                for c in range(at, at + span):
                    busy[c] = max(busy.get(c, 0), down)
                at += span
            grid.append(placed)
            busy = {c: n - 1 for c, n in busy.items() if n > 1}
        size: dict[int, int] = {}
        for several in (False, True):
            for row in grid:
                for c, (span, lines) in row.items():
                    need = max(map(width, lines), default=0)
                    if span == 1 and not several:
                        size[c] = max(size.get(c, 0), need)
                    elif span > 1 and several:
                        last = c + span - 1
                        before = sum(size[i] + 2 for i in range(c, last) if size.get(i, 0))  # columns without text have no gap
                        if need > (before + size[last] if size.get(last, 0) else max(0, before - 2)):
                            size[last] = max(1, need - before)
        start, x, wide = {}, 0, sorted((c for c, n in size.items() if n), reverse=True)
        for c in sorted({c for row in grid for c in row}):
            while wide and wide[-1] < c:
                x += size[wide.pop()] + 2
            start[c] = x
        out = list(self.captions)
        for row in grid:
            for i in range(max((len(lines) for _, lines in row.values()), default=0)):
                line, used = [], 0
                for c, (_, lines) in sorted(row.items()):
                    if i < len(lines) and lines[i]:
                        line.append(" " * (start[c] - used) + lines[i])
                        used = start[c] + width(lines[i])
                out.append("".join(line))
        return out


class Page:
    """The stack of open elements and what they have rendered."""

    def __init__(self):
        self.open: list[str] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of each name
        self.hidden = 0
        self.hides: list[bool] = []
        self.seen: list[bool] = []  # visibility and kept white space, both inherited
        self.keeps: list[bool] = []
        self.box = Box()
        self.outer: list[tuple] = []  # boxes around cells and captions
        self.tables: list[Table] = []
        self.lists: list[list] = []
        self.undo: list[tuple[str, str]] = []  # indent and marker around list items and quotes
        self.cells: list[tuple[int, int]] = []
        self.details: list[bool] = []

    # -- tree building ----------------------------------------------------------
    def foreign(self) -> str:
        """The svg or math element that the next tag is in; '' where HTML is."""
        at = self.top(FOREIGN)
        return self.open[at] if at > self.top(HOLDS_HTML) else ""

    def start(self, tag: str, rest: str) -> None:
        while tag in LEAVES and self.foreign():
            self.end_top()
        if tag in CLOSES_P:
            self.close_within("p", SCOPE | {"button"})
        if tag in HEADINGS and self.open and self.open[-1] in HEADINGS:
            self.end_top()
        if tag in IMPLIED:
            targets, limit = IMPLIED[tag]
            floor = self.top(limit)
            found = [at[i] for t in targets if (at := self.places.get(t)) and (i := bisect_right(at, floor)) < len(at)]
            while found and len(self.open) > min(found):
                self.end_top()
        elif self.open and self.open[-1] == "head" and tag not in IN_HEAD and tag != "head":
            self.end_top()
        if tag in ("td", "th") and self.tables and self.top({"tr"}) < self.top({"table"}):
            self.push("tr", {})
        attrs = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)} if rest.strip(" \t\n\f\r/") else {}
        if tag in VOID:
            self.void(tag, attrs)
        else:
            self.push(tag, attrs)

    def top(self, tags) -> int:
        """Place of the innermost open element of these names; -1 if there is none."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=-1)

    def close_within(self, tag: str, limit) -> None:
        at = self.top({tag})
        if at >= 0 and at >= self.top(limit):
            while len(self.open) > at:
                self.end_top()

    def end(self, tag: str) -> None:
        if tag == "br":
            self.void("br", {})
        elif tag == "p" and not self.places.get("p"):
            self.push("p", {})
            self.end_top()
        elif tag in HEADINGS:
            if (at := self.top(HEADINGS)) >= 0:
                self.close_within(self.open[at], SCOPE)
        elif tag not in ("body", "html"):
            limit = {"html"} if tag == "table" else {"table", "html"} if tag in SCOPE or tag in ("tr", "thead", "tbody", "tfoot") else SCOPE if tag in BLOCK or tag == "select" else SCOPE | BLOCK
            self.close_within(tag, limit)

    # -- rendering ----------------------------------------------------------------
    def push(self, tag: str, a: dict) -> None:
        style = COMMENT.sub("", a["style"]) if "style" in a else ""
        hide = tag in HIDDEN or any(tag in HIDDEN_IN[f] for f in FOREIGN if self.places.get(f)) or "hidden" in a and a["hidden"].lower() != "until-found" or bool(HIDES.search(style)) or tag == "dialog" and "open" not in a
        said, space = VISIBILITY.findall(style), WHITE_SPACE.findall(style)
        self.seen.append(said[-1].lower() == "visible" if said else not self.seen or self.seen[-1])
        self.keeps.append(space[-1].lower() not in ("normal", "nowrap") if space else tag in ("pre", "textarea") or bool(self.keeps) and self.keeps[-1])
        if tag == "details":
            self.details.append("open" in a)
        elif self.details and not self.details[-1] and tag != "summary" and self.open and self.open[-1] == "details":
            hide = True
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(tag)
        self.hides.append(hide)
        self.hidden += hide
        if tag == "text" or len(self.open) > 1 and self.open[-2] in APART:
            self.box.space = True
        if tag in BLOCK and not self.hidden:
            self.box.block(tag in GAP and not (tag in LISTS and self.lists))
        if tag in LISTS:
            start = int(a["start"]) if re.fullmatch(r"-?\d{1,9}", a.get("start", "")) else None
            self.lists.append([tag == "ol", 1 if start is None else start, -1 if "reversed" in a and start is not None else 1])
        elif tag in ("li", "blockquote", "dd"):
            self.undo.append((self.box.indent, self.box.marker))
            mark = "  "
            if tag == "li":
                mark = "- "
                if self.lists and self.lists[-1][0]:
                    n = int(a["value"]) if re.fullmatch(r"-?\d{1,9}", a.get("value", "")) else self.lists[-1][1]
                    self.lists[-1][1], mark = n + self.lists[-1][2], f"{n}. "
                if not self.hidden and self.seen[-1]:
                    self.box.marker = mark
            self.box.indent += " " * len(mark)
        elif tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables and not self.hidden:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            number = lambda k, most: max(1, min(most, int(a[k]))) if a.get(k, "").isascii() and a.get(k, "").isdigit() else 1
            self.cells.append((number("colspan", 1000), number("rowspan", 65534)))
            self.outer.append((self.box, self.lists))
            self.box, self.lists = Box(), []

    def end_top(self) -> None:
        tag = self.open.pop()
        self.places[tag].pop()
        if tag in ("td", "th", "caption") and self.cells:
            self.box.end_line()
            lines, (span, down) = self.box.lines, self.cells.pop()
            self.box, self.lists = self.outer.pop()
            if not self.hidden and self.tables:
                t = self.tables[-1]
                if tag == "caption":
                    t.captions += lines
                else:
                    if not t.rows:
                        t.rows.append([])
                    t.rows[-1].append((span, down, lines))
        elif tag == "table" and self.tables:
            for line in self.tables.pop().lines():
                if not self.hidden:
                    self.box.put(line)
        if tag in BLOCK and not self.hidden:
            self.box.block(tag in GAP and not (tag in LISTS and len(self.lists) > 1))
        if tag == "text" or tag in APART:
            self.box.space = True
        if tag in LISTS and self.lists:
            self.lists.pop()
        elif tag in ("li", "blockquote", "dd") and self.undo:
            if self.box.marker and not self.hidden:
                self.box.put("")  # an empty item keeps its marker
            self.box.indent, self.box.marker = self.undo.pop()
        elif tag == "details" and self.details:
            self.details.pop()
        self.hidden -= self.hides.pop()
        self.seen.pop()
        self.keeps.pop()

    def void(self, tag: str, a: dict) -> None:
        if self.hidden or "hidden" in a:
            return
        if tag == "br":
            self.box.end_line(True)
        elif tag == "hr":
            self.box.block(True)
        elif tag == "input" and (not self.seen or self.seen[-1]) and a.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number") and a.get("value"):
            self.text(a["value"])

    def text(self, s: str) -> None:
        if not s or self.hidden or self.seen and not self.seen[-1] or self.details and not self.details[-1] and self.open[-1] == "details":
            return
        if self.open and self.open[-1] in ("table", "thead", "tbody", "tfoot", "tr") and not s.strip(" \t\n\f\r"):
            return
        if self.places.get("svg") and self.top({"svg"}) > self.top({"text", "foreignobject"}):
            return  # svg shows text in its labels only
        if self.keeps and self.keeps[-1]:
            self.box.pre(s.replace("\r\n", "\n"))
        else:
            self.box.text(s)


def render(source: str) -> str:
    """All visible text of a page, laid out."""
    page, at, last = Page(), 0, source.rfind(">")
    unescape = html.unescape
    while True:
        m = TAG.search(source, at) if at <= last or source.find("<!", at) >= 0 else None
        text = source[at:m.start()] if m else source[at:]
        if text:
            if page.open and page.open[-1] == "head" and text.strip(" \t\n\f\r"):
                page.end_top()
            page.text(unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            page.end(tag)
            continue
        rest = m[3] or m[6] or ""
        empty = rest.endswith("/") and tag not in VOID and (tag in FOREIGN or tag not in LEAVES and page.foreign())
        page.start(tag, rest)
        if empty:
            page.end_top()
        elif tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at) if tag != "plaintext" else None
            text = source[at:close.start() if close else len(source)]
            page.text(unescape(text).removeprefix("\n") if tag == "textarea" else text)
            page.end_top()
            at = close.end() if close else len(source)
        elif tag == "pre" and source.startswith("\n", at):
            at += 1
    while page.open:
        page.end_top()
    page.box.end_line()
    lines = page.box.lines
    return "\n".join(lines).strip("\n")


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """``pages`` with ``visible_text``."""
    def start():
        def rows(batch, buf, offs):
            data = buf.tobytes()
            return [pa.array([render(data[a:b].decode("utf-8", "replace")) for a, b in zip(offs[:-1], offs[1:])], pa.string())]
        return rows
    return map_blocks(pages, source, "visible_text string", start)
