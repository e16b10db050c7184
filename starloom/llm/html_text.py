"""Layout-aware text of HTML pages.

A page is cut into tags and text. The tree builder keeps the stack of open
elements, closes those that a tag implies to be over (``head`` before what is not
its content, ``p`` before a block, list items, table parts and cells, options) and
opens table parts that are missing.
The layout follows its start and end events: elements that are not displayed give
nothing; in invisible ones only what is made visible again gives text. Blocks
start on a new line, paragraphs, headings, lists and tables have a blank line
around them, list items are marked and indented, ``pre`` keeps its spaces, and
the cells of a table are aligned in columns, also past cells that span rows.

Defined results: a null page gives null, a page without visible text ''. Unclosed
tags, quotes and comments end with the page; unknown tags are inline. Other
columns are not read.
"""

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PIECE = re.compile(r"[\s/]++|=?[^\s/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"?|'[^']*+'?|[^\s\"']\S*+)?+)?+|=")
_SPACES = re.compile(r"[ \t\n\r\f]+")

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HEAD = set("base link meta title style script noscript noframes template".split())
FOREIGN = {"svg", "math"}
HIDDEN = set(
    "script style template head title noscript iframe noembed noframes object audio video canvas svg math datalist param".split()
)
BLOCKS = set(
    "address article aside blockquote body center details dd dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "ul xmp caption".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol menu dir dl table figure fieldset address xmp".split())
LISTS = set("ul ol menu dir".split())
CLOSES_P = BLOCKS - set("html body caption legend optgroup option".split())
CELLS, GROUPS = {"td", "th"}, {"thead", "tbody", "tfoot"}
PARTS = CELLS | GROUPS | {"tr", "caption", "colgroup", "col"}

# What a start tag ends: the elements it closes, and those beyond which it does not look.
_SCOPE = {"table", "td", "th", "caption", "template", "html"}
_ENDS = {
    "body": ({"head"}, {"template"}),
    "li": ({"li"}, _SCOPE | LISTS),
    "dt": ({"dt", "dd"}, _SCOPE | {"dl"}),
    "dd": ({"dt", "dd"}, _SCOPE | {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    **{c: (CELLS | {"caption", "colgroup"}, {"table", "tr", "template"}) for c in CELLS},
    "tr": (CELLS | {"tr", "caption", "colgroup"}, {"table", "template"}),
    **{g: (PARTS, {"table", "template"}) for g in GROUPS | {"caption", "colgroup"}},
}
_TABLE_OPENS = {"td": ("tbody", "tr"), "th": ("tbody", "tr"), "tr": ("tbody",)}


class Builder:
    """Turns a page into properly nested start, text and end events for a layout."""

    def __init__(self, layout):
        self.layout, self.stack = layout, []
        self.there = Counter()

    def page(self, source):
        at, end = 0, len(source)
        while at < end:
            token = _TOKEN.match(source, at)
            at = token.end()
            name = token["name"] or token["name2"]
            if name:
                name = name.lower()
                attributes = token["attributes"] or token["attributes2"] or ""
                if token["close"] or token["close2"]:
                    self.close(name)
                elif self._is_empty(name, attributes):
                    self.open(name, attributes)
                    self._pop()
                else:
                    self.open(name, attributes)
                    if name in RAW:
                        stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                        stop = stop.start() if stop else end
                        raw = source[at:stop]
                        self.layout.text(html.unescape(raw) if name in ("textarea", "title") else raw)
                        at = stop
            elif token["text"] is not None:
                text = html.unescape(token["text"])
                if text.strip(" \t\n\r\f"):
                    self._end_head()
                self.layout.text(text)
        while self.stack:
            self._pop()

    def _pop(self):
        name = self.stack.pop()
        self.there[name] -= 1
        self.layout.end(name)

    def _push(self, name, attributes=""):
        self.stack.append(name)
        self.there[name] += 1
        self.layout.start(name, attributes)

    def _end_through(self, names, stops):
        """Close up to the outermost of ``names`` that is nearer than any of ``stops``."""
        if not any(self.there[n] for n in names):
            return
        found = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i] in names:
                found = i
            elif self.stack[i] in stops:
                break
        if found is not None:
            while len(self.stack) > found:
                self._pop()

    def _end_head(self):
        while self.stack and self.stack[-1] == "head":
            self._pop()

    def _is_empty(self, name, attributes):
        """Whether this is a self-closed ``svg`` or ``math``, or raw text in one; elsewhere the slash means nothing."""
        if not attributes.endswith("/") or name not in FOREIGN | RAW:
            return False
        if name in RAW and not any(self.there[n] for n in FOREIGN):
            return False
        return not _PIECE.findall(attributes)[-1].strip(" \t\n\r\f/")

    def open(self, name, attributes):
        if name not in HEAD:
            self._end_head()
        if name in CLOSES_P:
            self._end_through({"p"}, _SCOPE | {"button", "object"})
        if name in _ENDS:
            self._end_through(*_ENDS[name])
        if name in PARTS and not self.there["table"]:
            return
        for part in _TABLE_OPENS.get(name, ()):
            if not self._inside(part):
                self._push(part)
        if name in VOID:
            self.layout.void(name, attributes)
        else:
            self._push(name, attributes)

    def _inside(self, part):
        wanted = GROUPS if part == "tbody" else {part}
        for name in reversed(self.stack):
            if name in wanted:
                return True
            if name == "table":
                return False
        return False

    def close(self, name):
        if name == "br":
            self.layout.void("br", "")
        elif name == "p" and not self.there["p"]:
            self.open("p", "")
            self._pop()
        elif name in ("body", "html") or not self.there[name]:
            return
        else:
            stops = set() if name == "table" else {"table"} if name in PARTS else CELLS | {"caption", "table"}
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i] == name:
                    while len(self.stack) > i:
                        self._pop()
                    return
                if self.stack[i] in stops:
                    return


class _Flow:
    """Lines of a page, or of one cell."""

    def __init__(self):
        self.lines, self.line, self.space, self.gap = [], "", False, False
        self.indent, self.mark = 0, ""

    def add(self, text):
        """Text without line breaks whose spaces collapse."""
        words = _SPACES.sub(" ", text)
        body = words.strip(" ")
        if not body:
            self.space = self.space or words != ""
            return
        if self.line and (self.space or words[0] == " "):
            self.line += " "
        self.line += body
        self.space = words[-1] == " "

    def add_kept(self, text):
        """Preformatted text."""
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line += first
        for line in rest:
            self._emit(True)
            self.line = line

    def _emit(self, keep_empty=False):
        if self.line.strip() or keep_empty or self.mark:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append((" " * self.indent + self.mark + self.line).rstrip())
            if self.mark:
                self.indent += len(self.mark)
                self.mark = ""
        self.line, self.space = "", False

    def next_line(self, keep_empty=False):
        if self.line.strip() or keep_empty:
            self._emit(keep_empty)
        self.line, self.space = "", False

    def blank_line(self):
        self.next_line()
        self.gap = True


class Layout:
    """Follows the events of the builder."""

    def __init__(self):
        self.flows = [_Flow()]
        self.hidden, self.kept, self.visible = 0, 0, True
        self.frames, self.lists, self.tables = [], [], []

    def text(self, text):
        if self.hidden or not self.visible or not text or self._closed_details("text"):
            return
        if self.tables and len(self.flows) == self.tables[-1][1]:
            if not text.strip():
                return
        flow = self.flows[-1]
        if self.kept:
            flow.add_kept(text)
        else:
            flow.add(text)

    def void(self, name, attributes):
        if self.hidden or not self.visible:
            return
        flow = self.flows[-1]
        if name == "br":
            flow.next_line(keep_empty=True)
        elif name == "hr" and not _is_hidden(name, attributes) and _visibility(attributes, True):
            flow.blank_line()
            flow.add("---")
            flow.blank_line()
        elif name == "wbr":
            return

    def start(self, name, attributes):
        concealed = bool(self.hidden) or _is_hidden(name, attributes) or self._closed_details(name)
        flow = self.flows[-1]
        is_open = "open" in _attributes(attributes) if name == "details" else True
        self.frames.append((name, concealed, flow.indent, is_open, self.visible))
        if concealed:
            self.hidden += 1
            return
        self.visible = _visibility(attributes, self.visible)
        if name in BLOCKS:
            if name in SPACED and not (name in LISTS and self.lists):
                flow.blank_line()
            else:
                flow.next_line()
        if name in ("pre", "textarea", "xmp"):
            self.kept += 1
        if name in LISTS:
            start = _attributes(attributes).get("start") or "1"
            self.lists.append([name, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            flow.indent += 2
        elif name in ("blockquote", "dd"):
            flow.indent += 2
        elif name == "li" and self.visible:
            numbered = self.lists and self.lists[-1][0] == "ol"
            flow.mark = f"{self.lists[-1][1]}. " if numbered else "- "
            if numbered:
                self.lists[-1][1] += 1
        elif name == "table":
            self.tables.append(([], len(self.flows)))
        elif name == "tr":
            self.tables[-1][0].append([])
        elif name in CELLS:
            known = _attributes(attributes)
            span = known.get("colspan") or "1"
            span = min(1000, max(1, int(span))) if span.isdecimal() and len(span) < 6 else 1
            rows = known.get("rowspan") or "1"
            rows = min(65_534, int(rows)) if rows.isdecimal() and len(rows) < 9 else 1
            self.tables[-1][0][-1].append([None, span, rows or 65_534])
            self.flows.append(_Flow())

    def _closed_details(self, name):
        return bool(self.frames) and self.frames[-1][0] == "details" and not self.frames[-1][3] and name != "summary"

    def end(self, name):
        _, concealed, indent, _, visible = self.frames.pop()
        if concealed:
            self.hidden -= 1
            return
        self.visible = visible
        flow = self.flows[-1]
        if name in ("pre", "textarea", "xmp"):
            self.kept -= 1
        if name in CELLS:
            flow.next_line()
            self.flows.pop()
            self.tables[-1][0][-1][-1][0] = flow.lines or [""]
            return
        if name == "table":
            rows, _ = self.tables.pop()
            flow.next_line()
            for line in _aligned(rows):
                flow.line = line
                flow.next_line()
        elif name in BLOCKS:
            if flow.mark and flow.line:
                flow._emit()
            flow.next_line()
            flow.mark = ""
        if name in LISTS:
            self.lists.pop()
        if name in BLOCKS:
            flow.indent = indent
            if name in SPACED and not (name in LISTS and self.lists):
                flow.blank_line()

    def result(self):
        flow = self.flows[0]
        flow.next_line()
        return "\n".join(flow.lines).strip("\n")


def _aligned(rows):
    """Lines of a table: columns as wide as their widest cell, two spaces apart."""
    widths, placed = {}, []
    # Columns that cells of earlier rows reach into, and for how many rows more.
    taken = {}
    for row in rows:
        at, cells, reaching = 0, [], {}
        for lines, span, deep in row:
            while taken.get(at):
                at += 1
            cells.append((at, lines))
            if span == 1:
                widths[at] = max([widths.get(at, 0), *map(len, lines)])
            if deep > 1:
                reaching |= dict.fromkeys(range(at, at + span), deep - 1)
            at += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | reaching
        placed.append(cells)
    last = max(widths, default=-1)
    start, total = [], 0
    for i in range(last + 2):
        start.append(total)
        total += widths[i] + 2 if widths.get(i) else 0
    for cells in placed:
        for k in range(max((len(lines) for _, lines in cells), default=0)):
            line = ""
            for at, lines in cells:
                if k < len(lines) and lines[k]:
                    place = start[min(at, last + 1)]
                    line = line.ljust(place) if len(line) < place or not line else line + "  "
                    line += lines[k]
            yield line


def _attributes(source):
    if not source:
        return {}
    found = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def _style(known):
    """Declarations of a style attribute, the last of a name; without comments and marks of importance."""
    source = re.sub(r"/\*.*?(?:\*/|\Z)", " ", known.get("style", ""), flags=re.S).lower()
    pairs = (part.partition(":") for part in source.split(";"))
    return {name.strip(): re.sub(r"\s*!\s*important$", "", value.strip()) for name, colon, value in pairs if colon}


def _is_hidden(name, attributes):
    """Whether an element and all in it is not displayed."""
    if name in HIDDEN:
        return True
    lowered = attributes.lower()
    known = _attributes(attributes) if "hidden" in lowered or "style" in lowered else {}
    if "hidden" in known or name == "input" and known.get("type", "").lower() == "hidden":
        return True
    style = _style(known)
    if style.get("display") == "none" or style.get("content-visibility") == "hidden":
        return True
    return name == "dialog" and "open" not in _attributes(attributes)


def _visibility(attributes, inherited):
    """Whether the text of an element is visible, given that of its parent."""
    if "visibility" not in attributes.lower():
        return inherited
    value = _style(_attributes(attributes)).get("visibility")
    return {"visible": True, "initial": True, "hidden": False, "collapse": False}.get(value, inherited)


def render(source):
    """Visible text of a page; None for None."""
    if source is None:
        return None
    layout = Layout()
    Builder(layout).page(source)
    return layout.result()


def visible_text(page: Column) -> Column:
    """Visible text of each whole page."""

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([render(p.as_py()) for p in pages], pa.string())

    return extract(page)
