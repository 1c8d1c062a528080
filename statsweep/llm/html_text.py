"""HTML extraction by layout-aware rendering.

A tolerant tree builder (implied end tags, void and raw-text elements) makes a tree; visibility rules drop what a
browser doesn't show; the renderer emits all other text with block spacing, list markers and aligned table cells.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALIGNED = 200  # columns of a table that start further right are not aligned
MAX_DEPTH = 200  # elements nested deeper become children of the element at this depth; no text is lost

# an attribute: its name, and a value after "="; a quote opens a value only there and is an ordinary character elsewhere
ATTR = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+""")
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|""" + ATTR.pattern.replace("([^", "(?:[^", 1).replace('("', '(?:"', 1)
                   + r""")*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<""", re.S)
WHITE = re.compile(r"[ \t\n\r\f]+")
HIDING = re.compile(r"(?<![\w-])(?:display\s*:\s*none|content-visibility\s*:\s*hidden)", re.I)
VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(visible|hidden|collapse|initial)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in "script style textarea title xmp iframe noembed noframes".split()}
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes audio video canvas datalist rp area".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp ul ol dl table figure form fieldset hr listing".split())  # a blank line around
BLOCK = SPACED | frozenset(
    "html body address article aside center details dialog dd dir div dt figcaption footer header hgroup legend li main menu nav search section summary "
    "caption tr optgroup option select textarea".split())
# a start tag of the key ends an open element of the values, up to the nearest boundary
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th", "caption", "colgroup"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "optgroup": {"option", "optgroup"}, **dict.fromkeys(("thead", "tbody", "tfoot"), {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"})}
CLOSES_P = (BLOCK - frozenset("html body option optgroup select textarea caption tr legend".split())) | {"hr"}
BOUND = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"},
         **dict.fromkeys(("tr", "td", "th", "thead", "tbody", "tfoot"), {"table"})}
for _tags in BOUND.values():
    _tags.add("foreignobject")

# svg and math: start tags that end them, elements whose content is HTML again, elements that aren't shown
FOREIGN = re.compile("<(?:svg|math)", re.I)
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby "
                     "s small span strong strike sub sup table tt u ul var".split())
MATH_TOKENS = frozenset("mi mn mo ms mtext".split())
INNER_HTML = MATH_TOKENS | frozenset("foreignobject desc title".split())
FOREIGN_HIDDEN = frozenset("title desc metadata defs style script symbol clippath mask pattern marker filter lineargradient radialgradient annotation annotation-xml".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag, attrs=""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attr(self, name: str) -> str | None:
        for k, v in ATTR.findall(self.attrs):
            if k.lower() == name:
                return unescape(v[1:-1] if v[:1] in "\"'" and v else v)
        return None

    def shown(self) -> bool:
        a = self.attrs
        if self.tag in HIDDEN or self.tag == "input":
            return False
        if not a or a.isspace():
            return self.tag != "dialog"
        if "hidden" in a.lower() and (h := self.attr("hidden")) is not None and h.lower() != "until-found":
            return False
        if "style" in a.lower() and HIDING.search(self.attr("style") or ""):
            return False
        return self.tag != "dialog" or self.attr("open") is not None

    def visible(self, inherited: bool) -> bool:
        """CSS visibility, which a child can set anew; text that isn't visible is left out, its children aren't."""
        if "visibility" in self.attrs.lower() and (found := VISIBILITY.findall(self.attr("style") or "")):
            return found[-1].lower() in ("visible", "initial")
        return inherited


def _close(stack: list[Node], tags, bound) -> None:
    """Ends the nearest open element in ``tags`` and all inside it, if no boundary stands between; then looks again."""
    at = len(stack) - 1
    while at > 0 and stack[at].tag not in bound:
        if stack[at].tag in tags:
            del stack[at:]
        at -= 1


def _foreign(stack: list[Node]) -> str:
    """``svg`` or ``math`` if the innermost open element is one of their elements, else empty."""
    for node in reversed(stack):
        if node.tag in ("svg", "math"):
            return node.tag
        if node.tag in INNER_HTML or (node.tag == "annotation-xml" and "html" in node.attrs.lower()):
            return ""
    return ""


def parse(html: str) -> Node:
    """Tree of the markup. Stray end tags are ignored, open elements end with the text."""
    root = Node("#root")
    stack, pos, n = [root], 0, len(html)
    mixed = FOREIGN.search(html) is not None
    while pos < n:
        m = TOKEN.match(html, pos)
        start, pos = pos, m.end()
        tag = m[2]
        foreign = _foreign(stack) if mixed else ""
        if tag is None:
            s = m[0]
            if foreign and s.startswith("<![CDATA["):
                end = html.find("]]>", start)
                stack[-1].kids.append(html[start + 9:end if end >= 0 else n])
                pos = end + 3 if end >= 0 else n
                continue
            if s[0] != "<" or s == "<":
                stack[-1].kids.append(unescape(s) if "&" in s else s)
            continue
        tag = tag.lower()
        if foreign and (tag in ("p", "br") if m[1] else tag in BREAKOUT):
            while _foreign(stack):
                stack.pop()
            foreign = ""
        if m[1]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == tag:
                    del stack[at:]
                    break
                if stack[at].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body", "svg", "math"):
                    break
                if stack[at].tag == "foreignobject" and tag not in ("html", "body", "svg"):
                    break
            else:
                if tag == "br":
                    stack[-1].kids.append(Node("br"))
            continue
        if foreign:
            node = Node(tag, m[3])
            stack[-1].kids.append(node)
            # a text element is opened even at the limit, so that its text counts as such
            if not m[3].endswith("/") and len(stack) < MAX_DEPTH + (tag in ("text", "foreignobject")):
                stack.append(node)
            continue
        if tag in ENDS:
            _close(stack, ENDS[tag], BOUND[tag])
        elif tag == "body":
            _close(stack, {"head"}, ())
        if tag in CLOSES_P:
            _close(stack, {"p"}, {"td", "th", "table", "button", "foreignobject", "#root"})
            if tag[0] == "h" and tag[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
                stack.pop()
        node = Node(tag, m[3])
        stack[-1].kids.append(node)
        if tag in VOID or (m[3].endswith("/") and tag in ("svg", "math")):
            continue
        if tag in RAW:
            end = RAW[tag].search(html, pos)
            stop = end.start() if end else n
            node.kids.append(html[pos:stop] if tag not in ("textarea", "title") else unescape(html[pos:stop]))
            pos = stop if not end else (html.find(">", stop) + 1 or n)
            continue
        if tag == "plaintext":
            node.kids.append(html[pos:])
            break
        if len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


class Layout:
    """Lines of rendered text."""

    def __init__(self):
        self.lines, self.line, self.gap, self.indent, self.marker = [], [], False, "", ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            if first:
                self.line.append(first)
            for x in rest:
                self.flush(True)
                if x:
                    self.line.append(x)
            return
        s = WHITE.sub(" ", s)
        if s[:1] == " " and (not self.line or self.line[-1][-1:] == " "):
            s = s[1:]
        if s:
            self.line.append(s)

    def flush(self, even_empty: bool = False, pre: bool = False) -> None:
        s = "".join(self.line).rstrip(" ")
        self.line = []
        if not s and not (even_empty and self.lines):
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        lead = self.indent[:len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent
        self.lines.append((lead + s).rstrip())
        self.marker = ""

    def block(self, spaced: bool) -> None:
        self.flush()
        if spaced:
            self.gap = True

    def result(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(value: str | None, default: int) -> int:
    value = (value or "").strip()
    return int(value[:9]) if re.fullmatch(r"-?\d{1,9}", value) else default


def _walk(node: Node, out: Layout, pre: bool, nested: int, seen: bool) -> None:
    count = _number(node.attr("start"), 1) if node.tag == "ol" else 0
    kids = node.kids
    if node.tag == "details" and node.attr("open") is None:
        kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
    for kid in kids:
        if isinstance(kid, str):
            if seen:
                out.text(kid, pre)
            continue
        tag = kid.tag
        if not kid.shown():
            continue
        see = kid.visible(seen)
        if tag == "br":
            out.flush(see)
        elif tag == "hr":
            out.block(True)
            if see:
                out.line.append("---")
            out.block(True)
        elif tag in ("svg", "math"):
            _drawing(kid, out, nested, see, tag == "math")
        elif tag == "table":
            out.block(True)
            for line in _table(kid, nested, see):
                out.line.append(line)
                out.flush()
            out.block(True)
        elif tag == "li":
            out.flush()
            mark = "- "
            if node.tag == "ol":
                count = _number(kid.attr("value"), count)
                mark, count = f"{count}. ", count + 1
            before = out.indent
            out.indent, out.marker = before + " " * len(mark), mark if see else ""
            _walk(kid, out, pre, nested + 1, see)
            out.flush()
            out.indent, out.marker = before, ""
        elif tag in ("td", "th"):
            out.text(" ", False)
            _walk(kid, out, pre, nested, see)
            out.text(" ", False)
        elif tag in BLOCK:
            spaced = tag in SPACED and not (tag in ("ul", "ol") and node.tag == "li")
            out.block(spaced)
            before = out.indent
            if tag in ("blockquote", "dd"):
                out.indent += "  "
            _walk(kid, out, pre or tag in ("pre", "xmp", "listing", "textarea"), nested, see)
            out.flush()
            out.indent = before
            out.block(spaced)
        else:
            _walk(kid, out, pre, nested, see)


def _drawing(node: Node, out: Layout, nested: int, seen: bool, text: bool) -> None:
    """Text of an svg or math element: in svg only what stands in ``text`` or is HTML; a space between its pieces."""
    for kid in node.kids:
        if isinstance(kid, str):
            if text and seen:
                out.text(kid, False)
            continue
        tag = kid.tag
        if tag in FOREIGN_HIDDEN or not kid.shown() or (kid.attr("display") or "").strip().lower() == "none":
            continue
        see = kid.visible(seen) and tag != "mphantom"
        if "style" not in kid.attrs.lower() and (v := (kid.attr("visibility") or "").strip().lower()) in ("visible", "hidden", "collapse"):
            see = v == "visible"
        if tag == "foreignobject":
            out.block(False)
            _walk(kid, out, False, nested, see)
            out.block(False)
        elif tag == "text" or tag in MATH_TOKENS:
            out.text(" ", False)
            (_drawing(kid, out, nested, see, True) if tag == "text" else _walk(kid, out, False, nested, see))
            out.text(" ", False)
        else:
            _drawing(kid, out, nested, see, text)


def _table(table: Node, nested: int, seen: bool) -> list[str]:
    """Rows as lines; the cells of a column start at the same place, two spaces apart, as long as that place is within
    the first ``ALIGNED`` characters of the line (half as many in a table within a table, and so on). Cells further right
    follow the cell before them, so a wide cell or many columns can't multiply a page by padding; no text is lost."""
    before, rows = [], []

    def cell(node: Node, see: bool) -> list[str]:
        inner = Layout()
        _walk(node, inner, False, nested + 1, see)
        return inner.result()

    def collect(node: Node, seen: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                if seen and kid.strip():
                    before.append(WHITE.sub(" ", kid).strip())
            elif not kid.shown() or kid.tag in ("col", "colgroup"):
                continue
            elif kid.tag == "tr":
                row, see = [], kid.visible(seen)
                for c in kid.kids:
                    if isinstance(c, Node) and c.tag in ("td", "th"):
                        if c.shown():
                            row += [cell(c, c.visible(see)), *[None] * (max(1, min(_number(c.attr("colspan"), 1), 1000)) - 1)]
                    elif (isinstance(c, str) and c.strip()) or (isinstance(c, Node) and c.shown()):
                        one = Node("td")
                        one.kids = [c]
                        row.append(cell(one, see))
                rows.append(row)
            elif kid.tag in ("thead", "tbody", "tfoot"):
                collect(kid, kid.visible(seen))
            elif kid.tag in ("td", "th"):
                rows.append([cell(kid, kid.visible(seen))])
            else:
                one = Node("td")
                one.kids = [kid]
                before.extend(cell(one, seen))

    collect(table, seen)
    widths: list[int] = []
    for row in rows:
        for i, c in enumerate(row):
            if i == len(widths):
                widths.append(0)
            if c is None or (i + 1 < len(row) and row[i + 1] is None):
                continue  # a cell that spans columns doesn't widen its first one
            widths[i] = max(widths[i], max(map(len, c), default=0))
    lines, room = list(before), ALIGNED >> nested
    for row in rows:
        for k in range(max((len(c) for c in row if c), default=0)):
            line, at = "", 0
            for c, w in zip(row, widths):
                if c is not None and at > room:
                    line += "  " + c[k] if k < len(c) and c[k] else ""
                elif c is not None:
                    line = (line.ljust(at) if len(line) <= at else line + "  ") + (c[k] if k < len(c) else "")
                at += w + 2
            lines.append(line.rstrip())
    return [x for x in lines if x]


def render(html: str | None) -> str:
    """All visible text of a page; empty for null or empty markup."""
    out = Layout()
    if html:
        _walk(parse(html), out, False, 0, True)
    return "\n".join(out.result())


def extract_text(pages: DataFrame, text: bool = True) -> DataFrame:
    """Per row of ``pages(page_id, html, ...)``: ``page_id, n_chars, n_lines, text_sha256`` and, with ``text``, ``text``.

    A null or empty page has an empty text of no lines. Rows with a repeated or null ``page_id`` keep their own row;
    other columns aren't read.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = [render(h) for h in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array([len(t) for t in out], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in out], pa.int64()),
                        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in out], pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([t.encode("utf-8", "replace").decode() for t in out], pa.string())] * text,
                                                 names=["page_id", "n_chars", "n_lines", "text_sha256", *["text"] * text])

    return pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(
        run, "page_id bigint, n_chars bigint, n_lines bigint, text_sha256 string" + ", text string" * text)
