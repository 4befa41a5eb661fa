"""Layout-aware text of web pages: a forgiving tree builder and a renderer of everything visible.

The builder turns markup into properly nested open, text and close events: void elements close at
once, implied end tags (p, li, dt, dd, option, table parts) and implied rows are put in, stray end
tags fall away, and open elements close at the end. The renderer skips what a browser would not show,
takes the chosen option of a select and the text of SVG and MathML, and lays out the rest: margins
between blocks, bullets and numbers of nested lists, preformatted text as it is, and tables as cells
aligned in columns, spanned rows and columns included. What is hidden follows from elements, attributes,
style attributes, and those rules of the page's style sheets that name a tag, a class or an id (no
combinators, no at-rules). Both keep explicit stacks, so neither the depth nor the length of a page
matters, and both take time in proportion to the page.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist "
                   "object audio video canvas".split())
FOREIGN = frozenset("svg math".split())
# Not drawn inside SVG and MathML.
UNDRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl figure table fieldset".split())
BLOCK = MARGIN | frozenset("html body div section article aside header footer nav main address form "
                           "li dt dd tr td th thead tbody tfoot caption hr details summary dialog "
                           "figcaption legend center optgroup menu search hgroup".split())
CLOSES_P = BLOCK - frozenset("html body tr td th thead tbody tfoot caption".split())
# Opening the key closes an open element of the values, unless one of the third is nearer.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")),
    "optgroup": (("optgroup",), ("select",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
# What may stand in the head; anything else ends it.
IN_HEAD = frozenset("head html base basefont bgsound link meta noframes noscript script style template title".split())
# Only the first one counts.
ONCE = frozenset("html head body".split())
# End tags and implied ends do not reach beyond these.
WALLS = frozenset("table td th caption template".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
# Between attributes; a name, which may start with "="; a value, where only a quote right at its start
# delimits (one without a fellow is read as a plain value).
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"""(=?[^\s/>=]*)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT_END = re.compile(r"--!?>")
_REMARK = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_SELECTOR = re.compile(r"^(\*|[A-Za-z][\w-]*)?((?:[.#][\w-]+)*)$")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}

Event = tuple[str, str, dict]


def tokens(page: str) -> Iterator[Event]:
    """("start" | "end" | "text", name or text, attributes), as written."""
    at, n, foreign = 0, len(page), 0
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", html.unescape(page[at:]), {}
            return
        if lt > at:
            yield "text", html.unescape(page[at:lt]), {}
        if page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):
                at = page.find(">", lt) + 1
                continue
            end = _COMMENT_END.search(page, lt + 4)
            at = end.end() if end else n
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = page.startswith("/", lt + 1)
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            yield "text", "<", {}
            at = lt + 1
            continue
        tag, attributes, end = name.group().lower(), {}, name.end()
        while True:
            gap = _GAP.match(page, end)
            end = gap.end()
            if end == n:
                return
            if page[end] == ">":
                break
            m = _ATTRIBUTE.match(page, end)
            end = m.end()
            value = m.group(2) or m.group(3) or m.group(4) or ""
            attributes.setdefault(m.group(1).lower(), html.unescape(value))
        at = end + 1
        if closing:
            foreign -= tag in FOREIGN and foreign > 0
            yield "end", tag, {}
            continue
        if (foreign or tag in FOREIGN) and tag not in VOID and gap.group().endswith("/"):
            yield "start", tag, attributes
            yield "end", tag, {}
            continue
        foreign += tag in FOREIGN
        yield "start", tag, attributes
        if tag in RAW:
            closed = _RAW_END[tag].search(page, at)
            stop_at = closed.start() if closed else n
            inner = page[at:stop_at]
            yield "text", html.unescape(inner) if tag in ("textarea", "title") else inner, {}
            yield "end", tag, {}
            skip = page.find(">", stop_at)
            at = n if skip < 0 else skip + 1


def build(page: str) -> Iterator[Event]:
    """("open" | "text" | "close", ...) in document order, properly nested."""
    stack: list[str] = []
    open_: dict[str, int] = {}

    def push(tag: str) -> None:
        stack.append(tag)
        open_[tag] = open_.get(tag, 0) + 1

    def pop_to(depth: int) -> Iterator[Event]:
        while len(stack) > depth:
            tag = stack.pop()
            open_[tag] -= 1
            yield "close", tag, {}

    def find(tags: tuple[str, ...], walls: Iterable[str]) -> int:
        if not any(open_.get(t) for t in tags):
            return -1
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] in tags:
                return k
            if stack[k] in walls:
                return -1
        return -1

    for kind, name, attributes in tokens(page):
        if kind == "text":
            if stack and stack[-1] == "head" and name.strip(" \t\n\r\f"):
                yield from pop_to(len(stack) - 1)
            yield kind, name, attributes
        elif kind == "start":
            if name in ONCE and (open_.get(name) or name == "head" and open_.get("body")):
                continue
            if open_.get("head") and name not in IN_HEAD and (k := find(("head",), ("template",))) >= 0:
                yield from pop_to(k)
            if name in CLOSES_P and (k := find(("p",), WALLS)) >= 0:
                yield from pop_to(k)
            if name in IMPLIED_END:
                tags, walls = IMPLIED_END[name]
                if (k := find(tags, walls)) >= 0:
                    yield from pop_to(k)
            if name in ("td", "th") and open_.get("table") and find(("tr",), ("table",)) < 0:
                push("tr")
                yield "open", "tr", {}
            yield "open", name, attributes
            if name in VOID:
                yield "close", name, {}
            else:
                push(name)
        elif name == "p" and find(("p",), WALLS) < 0:
            # An end tag without a start is an empty paragraph.
            yield "open", "p", {}
            yield "close", "p", {}
        elif name == "br":
            yield "open", "br", {}
            yield "close", "br", {}
        elif name not in VOID:
            if (k := find((name,), () if name in WALLS else WALLS)) >= 0:
                yield from pop_to(k)
    yield from pop_to(0)


def width(text: str) -> int:
    """Columns that a line takes: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1
               for c in text)


class Flow:
    """Lines of one box: the page or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.space = False
        self.indent = 0
        self.marker = ""

    def break_line(self, margin: int = 0) -> None:
        if self.line:
            self.lines.append((" " * self.indent + self.marker + "".join(self.line)).rstrip())
            self.line, self.gap = [], 0
            self.indent += len(self.marker)
            self.marker = ""
        self.space = False
        self.gap = max(self.gap, margin)

    def put(self, text: str) -> None:
        if not self.line and self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.line.append(text)

    def words(self, text: str) -> None:
        """Text whose white space collapses."""
        parts = _SPACE.sub(" ", text)
        if not parts.strip(" "):
            self.space = self.space or bool(parts and self.line)
            return
        if (self.space or parts[0] == " ") and self.line and not self.line[-1].endswith(" "):
            self.put(" ")
        self.put(parts.strip(" "))
        self.space = parts[-1] == " "

    def verbatim(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        if first:
            self.put(first)
        for line in rest:
            if self.line:
                self.break_line()
            else:
                self.gap += 1
            if line:
                self.put(line)

    def block(self, lines: list[str]) -> None:
        for line in lines:
            self.break_line()
            if line:
                self.put(line)
            else:
                self.gap = 1
        self.break_line()

    def finish(self) -> list[str]:
        self.break_line()
        return self.lines


def aligned(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Rows of (columns spanned, rows spanned, lines) as text: every column as wide as its widest single cell."""
    widths: list[int] = []
    placed: list[list[tuple[int, list[str]]]] = []
    held: dict[int, int] = {}
    for row in rows:
        at, cells, down = 0, [], {}
        for span, deep, lines in row:
            while at in held:
                at += 1
            widths.extend([0] * (at + span - len(widths)))
            if span == 1:
                widths[at] = max([widths[at], *map(width, lines)])
            cells.append((at, lines))
            if deep != 1:
                # Nought reaches to the end of the table.
                down.update(dict.fromkeys(range(at, at + span), deep - 1 if deep else len(rows)))
            at += span
        held = {c: n - 1 for c, n in held.items() if n > 1} | down
        placed.append(cells)
    starts = [0]
    for w in widths:
        starts.append(starts[-1] + w + 2)
    out = []
    for cells in placed:
        for k in range(max((len(lines) for _, lines in cells), default=0)):
            line, filled = "", 0
            for at, lines in cells:
                if k < len(lines) and lines[k]:
                    gap = max(starts[at] - filled, 2 if line else 0)
                    line += " " * gap + lines[k]
                    filled += gap + width(lines[k])
            out.append(line.rstrip())
    return out


def number(attributes: dict, name: str, low: int, high: int) -> int:
    """A whole number of an attribute between bounds; 1 if there is none."""
    try:
        return min(max(int(attributes.get(name, "1")), low), high)
    except ValueError:
        return 1


def declarations(text: str) -> dict[str, tuple[bool, str]]:
    """display and visibility of a list of declarations: (important, value); the last one counts."""
    out: dict[str, tuple[bool, str]] = {}
    for part in _REMARK.sub("", text).split(";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if colon and name in ("display", "visibility"):
            value, important, _ = value.strip().lower().partition("!")
            if important or name not in out or not out[name][0]:
                out[name] = (bool(important), value.strip())
    return out


class Style:
    """Rules on display and visibility, by their plain selectors."""

    def __init__(self) -> None:
        self.rules: dict[str, list] = {}
        self.count = 0

    def read(self, sheet: str) -> None:
        """Add the rules of a style sheet; at-rules are passed over whole."""
        sheet = _REMARK.sub("", sheet)
        at = 0
        while (brace := sheet.find("{", at)) >= 0:
            head = sheet[at:brace]
            if (semicolon := head.rfind(";")) >= 0:
                head = head[semicolon + 1:]
            end, depth = brace + 1, 1
            if head.strip().startswith("@"):
                while depth and end < len(sheet):
                    depth += {"{": 1, "}": -1}.get(sheet[end], 0)
                    end += 1
                at = end
                continue
            end = sheet.find("}", brace)
            end = len(sheet) if end < 0 else end
            at = end + 1
            found = declarations(sheet[brace + 1:end])
            for selector in head.split(",") if found else ():
                m = _SELECTOR.match(selector.strip())
                if m and m.group():
                    marks = re.findall(r"[.#][\w-]+", m.group(2))
                    tag = "" if m.group(1) in (None, "*") else m.group(1).lower()
                    rank = (sum(x[0] == "#" for x in marks), sum(x[0] == "." for x in marks), bool(tag), self.count)
                    self.count += 1
                    self.rules.setdefault((marks or [tag or "*"])[0], []).append((tag, set(marks), rank, found))

    def of(self, tag: str, attributes: dict) -> dict[str, str]:
        """display and visibility of an element, where a rule or its style attribute sets them."""
        if not self.rules and "style" not in attributes:
            return {}
        marks = {"." + c for c in attributes.get("class", "").split()}
        if attributes.get("id"):
            marks.add("#" + attributes["id"])
        best: dict[str, tuple] = {}
        for key in ({"*", tag} | marks if self.rules else ()):
            for wanted, needed, rank, found in self.rules.get(key, ()):
                if (not wanted or wanted == tag) and needed <= marks:
                    for name, (important, value) in found.items():
                        best[name] = max(best.get(name, ()), (important, False, rank, value))
        for name, (important, value) in declarations(attributes.get("style", "")).items():
            best[name] = max(best.get(name, ()), (important, True, (), value))
        return {name: b[3] for name, b in best.items()}


_SHEETS = re.compile(r"<style[\s/>]", re.I)


def page_style(page: str) -> Style:
    """The rules of all style sheets of a page, wherever they stand."""
    style = Style()
    if _SHEETS.search(page):
        sheet = False
        for kind, name, _ in tokens(page):
            if kind == "text" and sheet:
                style.read(name)
            sheet = kind == "start" and name == "style"
    return style


def hidden(tag: str, attributes: dict, style: dict[str, str], foreign: int = 0) -> bool:
    """Whether the element and all in it stay unseen."""
    if tag in UNSEEN or tag in UNDRAWN and foreign:
        return True
    if style.get("display") == "none":
        return True
    if "hidden" in attributes and attributes["hidden"].lower() != "until-found":
        return "display" not in style
    return tag == "dialog" and "open" not in attributes


def shown(attributes: dict, options: list[tuple[dict, list[str]]]) -> list[list[str]]:
    """The lines of the options that a select shows: all of a list box, else the chosen or first one."""
    try:
        size = int(attributes.get("size", "1"))
    except ValueError:
        size = 1
    if "multiple" in attributes or size > 1:
        return [lines for _, lines in options]
    chosen = [o for o in options if "selected" in o[0]][-1:]
    return [lines for _, lines in (chosen or [o for o in options if "disabled" not in o[0]][:1])]


def render(page: str) -> str:
    """The visible text of a page."""
    flow = Flow()
    boxes: list[Flow] = []
    tables: list[list] = []
    lists: list[list] = []
    undo: list[tuple] = []
    selects: list[list] = []
    unseen = pre = foreign = 0
    closed_details: list[int] = []
    style = page_style(page)
    veils: list[bool] = []
    veiled = False
    for kind, name, attributes in build(page):
        if kind == "text":
            if not unseen and not veiled and not (closed_details and closed_details[-1] == 1):
                flow.verbatim(name) if pre else flow.words(name)
            continue
        if kind == "open":
            veils.append(veiled)
            own = {} if unseen else style.of(name, attributes)
            if "visibility" in own and own["visibility"] in ("hidden", "collapse", "visible"):
                veiled = own["visibility"] != "visible"
            outside = bool(closed_details) and closed_details[-1] == 1 and name != "summary"
            if unseen or outside or hidden(name, attributes, own, foreign):
                unseen += 1
                undo.append(("unseen",))
                continue
            if name == "br":
                if flow.line:
                    flow.break_line()
                else:
                    flow.gap += 1
                undo.append(())
                continue
            if name == "select" or name == "option" and selects:
                boxes.append(flow)
                undo.append((name, attributes, pre))
                if name == "select":
                    selects.append([])
                flow, pre = Flow(), 0
                continue
            if name in FOREIGN:
                foreign += 1
            if name in ("td", "th") and tables:
                boxes.append(flow)
                undo.append(("cell", number(attributes, "colspan", 1, 1000), number(attributes, "rowspan", 0, 65534), pre))
                flow, pre = Flow(), 0
                continue
            if name == "tr" and tables:
                tables[-1].append([])
                undo.append(())
                continue
            if name == "table":
                flow.break_line(1)
                boxes.append(flow)
                tables.append([])
                undo.append(("table", pre))
                # Text between the cells of a table stands before it, as in a browser.
                flow, pre = Flow(), 0
                continue
            if name == "text" and foreign:
                flow.break_line()
            if name in BLOCK:
                flow.break_line(1 if name in MARGIN and not (lists and name in ("ul", "ol")) else 0)
            saved = (flow.indent, flow.marker)
            state = ["plain", saved, name]
            if name in ("ul", "ol", "menu"):
                try:
                    start = int(attributes.get("start", "1"))
                except ValueError:
                    start = 1
                lists.append([name, start])
            elif name == "li":
                if lists and lists[-1][0] == "ol":
                    flow.marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    flow.marker = "- "
            elif name in ("blockquote", "dd"):
                flow.indent += 2
            elif name == "pre":
                pre += 1
            elif name == "details" and "open" not in attributes:
                closed_details.append(1)
            elif name == "details":
                closed_details.append(0)
            elif name == "summary" and closed_details:
                state.append(closed_details[-1])
                closed_details[-1] = 0
            undo.append(tuple(state))
            continue
        state = undo.pop()
        veiled = veils.pop()
        if not state:
            continue
        if state[0] == "unseen":
            unseen -= 1
        elif state[0] == "option":
            selects[-1].append((state[1], flow.finish()))
            flow, pre = boxes.pop(), state[2]
        elif state[0] == "select":
            # Text beside the options is not shown.
            flow, pre = boxes.pop(), state[2]
            for k, lines in enumerate(shown(state[1], selects.pop())):
                if k:
                    flow.break_line()
                flow.words(" ".join(lines))
        elif state[0] == "cell":
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((state[1], state[2], flow.finish()))
            flow, pre = boxes.pop(), state[3]
        elif state[0] == "table":
            before = flow.finish()
            rows = aligned(tables.pop())
            flow, pre = boxes.pop(), state[1]
            flow.block(before + rows)
            flow.break_line(1)
        else:
            _, (indent, marker), tag, *held = state
            if tag in FOREIGN:
                foreign -= 1
            elif tag == "text" and foreign:
                # Each text element of SVG stands at a place of its own.
                flow.break_line()
            if tag in BLOCK:
                flow.break_line(1 if tag in MARGIN and not (len(lists) > 1 and tag in ("ul", "ol")) else 0)
            if tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag == "pre":
                pre -= 1
            elif tag == "details":
                closed_details.pop()
            elif held:
                closed_details[-1] = held[0]
            if tag in ("li", "blockquote", "dd"):
                flow.indent, flow.marker = indent, marker
    return "\n".join(flow.finish()).strip("\n")


def page_texts(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """(key, text, n_lines) for every row of ``pages``: all visible text of ``source``.

    Null or empty markup gives an empty text and no lines; a page without tags is text itself. Rows
    that repeat, or have no key, are rendered like all others. Other columns are not read.
    """
    kind = pages.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x.as_py() or "") for x in batch.column("_html")]
            lines = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(texts, pa.string()), pa.array(lines, pa.int64())],
                ["_key", "text", "n_lines"])

    out = pages.select(F.col(key).alias("_key"), F.col(source).alias("_html"))
    return out.mapInArrow(run, f"_key {kind.simpleString()}, text string, n_lines long"
                          ).withColumnRenamed("_key", key)
