"""Text of web pages as a reader sees it.

A small tree builder reads tags, closes what HTML leaves open (paragraphs, list items,
table cells, options) and drops what is not shown: head, scripts, styles, templates,
comments, ``hidden`` elements, ``display:none`` (inline or by a plain tag, class or id rule of a
style sheet in the page), titles and definitions of drawings, annotations of formulas, and options of a
drop-down list but the chosen one (the last marked, or else the first that is not disabled).
``visibility`` is inherited: a visible element in a hidden one is shown. A renderer then writes all text
that is left: blocks on lines of their own, blank lines around paragraphs, headings, lists and tables, list markers
with indents, line breaks, preformatted text as it is, and table cells in aligned columns, those that
span rows or columns included. Padding is bounded, text never: a cell wider than ``MAX_PAD`` is not
padded against, and a column that starts beyond ``MAX_LINE`` follows the one before after two blanks.

Defined cases: a null or empty page gives an empty text. Unclosed and stray tags never
lose text: a ``<`` that opens no tag is text, a tag with an unclosed quote ends at the next ``>``, and an open head ends where the HTML standard ends it. Nesting beyond ``MAX_DEPTH`` is flattened, text is kept.
Repeated pages get equal texts. Extra columns of the input are not looked at.
"""

from __future__ import annotations

import html
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import strings, with_columns

# fixed values of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template noscript title iframe noembed noframes datalist object audio video canvas".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul caption".split()
)
SPACED = set("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
CLOSES_P = BLOCKS - {"body", "html", "li", "dd", "dt", "caption"}
# drawings and formulas: what is not shown of them, what holds HTML, and what HTML ends them
FOREIGN = {"svg", "math"}
FOREIGN_UNSEEN = set("desc defs metadata annotation annotation-xml".split())
HOLDS_HTML = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = BLOCKS - set("address article aside figcaption figure footer form header hgroup html legend main details dialog fieldset search section summary caption".split()) | set(
    "b big br code em embed i img meta s small span strike strong sub sup tt u var".split()
)
IN_HEAD = set("title meta link base basefont bgsound style script noscript noframes template".split())
ROW_GROUPS = {"thead", "tbody", "tfoot"}
# an open element on the left is ended by a start tag on the right; the search stops at the barriers
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "p": CLOSES_P,
    "td": {"td", "th", "tr"} | ROW_GROUPS, "th": {"td", "th", "tr"} | ROW_GROUPS, "tr": {"tr"} | ROW_GROUPS,
    "thead": ROW_GROUPS, "tbody": ROW_GROUPS, "tfoot": ROW_GROUPS, "caption": {"tr", "col", "colgroup"} | ROW_GROUPS,
    "colgroup": {"tr"} | ROW_GROUPS,
}
BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "p": {"td", "th", "li", "dd", "button", "caption"}}
TABLE_PARTS = {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}

MAX_DEPTH = 400
MAX_PAD = 80  # characters that a cell is padded to at most
MAX_LINE = 240  # characters of a line within which columns are aligned
MAX_SPANNED = 100  # columns in which spans are followed
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "parent", "depth")

    def __init__(self, tag: str, attributes: dict, parent: Node | None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []
        self.depth = parent.depth + 1 if parent else 0


def _styled(style: str) -> tuple[bool, bool | None]:
    """Whether a style removes an element, and the visibility that it sets, if it sets one."""
    flat = _SPACE.sub("", style.lower())
    last = max(("hidden", "collapse", "visible"), key=lambda v: flat.rfind("visibility:" + v))
    return "display:none" in flat, (last == "visible") if "visibility:" + last in flat else None


class Rules:
    """What the style sheets of a page remove, and the visibility that they set; the last rule of a selector holds."""

    def __init__(self):
        self.removed: set[str] = set()
        self.visible: dict[str, bool] = {}

    def read(self, sheet: str) -> None:
        for selectors, style in _RULE.findall(sheet):
            removes, visible = _styled(style)
            for selector in map(str.strip, selectors.split(",")):
                if removes:
                    self.removed.add(selector)
                if visible is not None:
                    self.visible[selector] = visible

    def shown(self, node: Node, inherited: bool) -> bool:
        """The visibility of an element, given that of its parent."""
        style = node.attributes.get("style") if node.attributes else None
        own = _styled(style)[1] if style else None
        if own is None and self.visible:
            own = next((self.visible[n] for n in _names(node) if n in self.visible), None)
        return inherited if own is None else own


def _names(node: Node) -> list[str]:
    """Plain selectors that name an element, the strongest first."""
    a = node.attributes
    marks = ["#" + a.get("id", ""), *(f".{c}" for c in a.get("class", "").split())]
    return [*(node.tag + m for m in marks), *marks, node.tag]


def _foreign(node: Node) -> Node | None:
    """The drawing or formula that the content of a node belongs to, if it is not HTML within one."""
    while node and node.tag not in HOLDS_HTML:
        if node.tag in FOREIGN:
            return node
        node = node.parent
    return None


def _text(node: Node, value: str) -> Node:
    """Append a text; the node that is open then, as text that is not blank ends an open head."""
    if node.tag == "head" and not _SPACE.fullmatch(value):
        node = node.parent
    node.children.append(value)
    return node


def _ends(node: Node, tag: str) -> Node:
    """Close what a start tag ends; the node that the new element goes into."""
    while True:
        at, fences = node, set()
        while at.parent:
            if tag in ENDED_BY.get(at.tag, ()) and not fences & (BARRIERS.get(at.tag, set()) | {"table"}):
                break
            fences.add(at.tag)
            at = at.parent
        if not at.parent:
            return node
        node = at.parent


def build(page: str) -> tuple[Node, Rules]:
    """The tree, and the rules of the style sheets in the page."""
    root = node = Node("#root", {}, None)
    rules = Rules()
    at, lowered, drawn = 0, None, False
    for m in iter(lambda: _TAG.search(page, at), None):
        if m.start() > at:
            node = _text(node, page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            open_ = node
            while open_.parent and open_.tag != tag and not (open_.tag == "table" and tag not in TABLE_PARTS):
                open_ = open_.parent
            if open_.parent and open_.tag == tag:
                node = open_.parent
            elif tag == "p":  # a stray end of a paragraph is an empty one
                node.children.append(Node("p", {}, node))
            continue
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(m[3])} if m[3] else {}
        if node.tag == "head" and tag not in IN_HEAD:
            node = node.parent
        foreign = _foreign(node) if drawn else None
        if foreign and tag in ENDS_FOREIGN:
            node, foreign = foreign.parent, None
        drawn = drawn or tag in FOREIGN
        if not foreign:
            node = _ends(node, tag)
        element = Node(tag, attributes, node)
        node.children.append(element)
        if tag in VOID or (foreign or tag in FOREIGN) and m[3].endswith("/"):
            continue
        if tag in RAW:
            lowered = lowered or page.lower()
            end = lowered.find(f"</{tag}", at) if len(lowered) == len(page) else page.find(f"</{tag}", at)
            end = len(page) if end < 0 else end
            if tag == "style":
                rules.read(page[at:end])
            element.children.append(page[at:end])
            close = page.find(">", end)
            at = close + 1 if close >= 0 else len(page)
        elif element.depth < MAX_DEPTH:
            node = element
    if at < len(page):
        _text(node, page[at:])
    return root, rules


def _seen(node: Node, rules: Rules) -> bool:
    if node.tag in UNSEEN or node.tag in FOREIGN_UNSEEN and _foreign(node.parent):
        return False
    a = node.attributes
    if a and ("hidden" in a or node.tag == "input" or _styled(a.get("style") or "")[0]):
        return False
    return not rules.removed or rules.removed.isdisjoint(_names(node))


def _span(cell: Node, name: str, most: int) -> int:
    """Columns or rows of a cell; 0 rows are all that are left."""
    value = cell.attributes.get(name, "") or ""
    n = int(value) if re.fullmatch(r"[0-9]{1,9}", value) else 1
    return most if n == 0 and name == "rowspan" else min(most, max(1, n))


def _chosen(select: Node, rules: Rules) -> list[Node]:
    """The option that is shown: the last one marked, or the first not disabled; of a list box all options."""
    options, left = [], [select]
    while left:
        node = left.pop()
        if node.tag == "option":
            options.append(node)
        elif node is select or node.tag == "optgroup":
            left += [c for c in reversed(node.children) if not isinstance(c, str) and _seen(c, rules)]
    size = select.attributes.get("size", "") or ""
    if "multiple" in select.attributes or re.fullmatch(r"[0-9]{1,9}", size) and int(size) > 1:
        return options
    free = [o for o in options if "disabled" not in o.attributes and "disabled" not in o.parent.attributes]
    return [o for o in options if "selected" in o.attributes][-1:] or free[:1]


class Renderer:
    """Lines of text under an indent; a line is closed by the block that ends it."""

    def __init__(self, rules: Rules, shown: bool = True):
        self.rules, self.shown, self.lines, self.now, self.indent, self.marker = rules, shown, [], [], "", ""

    def text(self, value: str, pre: bool) -> None:
        if not self.shown:
            return
        value = html.unescape(value) if "&" in value else value
        if pre:
            first, *rest = value.split("\n")
            self.now.append(first)
            for line in rest:
                self.close(keep=True)
                self.now.append(line)
            return
        value = _SPACE.sub(" ", value)
        if self.now and self.now[-1].endswith((" ", "\n")) or not self.now:
            value = value.lstrip(" ")
        if value:
            self.now.append(value)

    def close(self, keep: bool = False) -> None:
        line = "".join(self.now)
        line = line.rstrip() if not keep else line
        if line or keep:
            head = self.marker or self.indent
            self.lines.append((head + line).rstrip())
            self.marker = ""
        self.now = []

    def gap(self) -> None:
        self.close()
        if self.lines and self.lines[-1] and not self.marker:
            self.lines.append("")

    def walk(self, node: Node, pre: bool = False, ordered: list | None = None) -> None:
        for child in node.children:
            if isinstance(child, str):
                self.text(child, pre)
            elif _seen(child, self.rules):
                was, self.shown = self.shown, self.rules.shown(child, self.shown)
                self.element(child, pre, ordered)
                self.shown = was

    def element(self, child: Node, pre: bool, ordered: list | None) -> None:
        tag = child.tag
        if tag == "br":
            if self.shown:
                self.close(keep=True)
        elif tag == "img":
            if child.attributes.get("alt"):
                self.text(child.attributes["alt"], pre)
        elif tag == "hr":
            self.gap()
        elif tag == "select":
            for option in _chosen(child, self.rules):
                self.text(" ", False)
                self.walk(option)
                self.text(" ", False)
        elif tag == "text":  # labels of a drawing stand apart
            self.text(" ", False)
            self.walk(child, pre, ordered)
            self.text(" ", False)
        elif tag == "table":
            self.gap()
            self.table(child)
            self.gap()
        elif tag in ("ul", "ol", "menu"):
            (self.gap if not self.indent else self.close)()
            start = child.attributes.get("start", "")
            self.walk(child, pre, [int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1] if tag == "ol" else None)
            (self.gap if not self.indent else self.close)()
        elif tag == "li":
            self.close()
            mark = "- "
            if ordered:
                mark, ordered[0] = f"{ordered[0]}. ", ordered[0] + 1
            mark = mark if self.shown else " " * len(mark)
            was, self.marker = self.indent, self.indent + mark
            self.indent += " " * len(mark)
            self.walk(child, pre)
            self.close()
            self.indent, self.marker = was, ""
        elif tag in BLOCKS:
            (self.gap if tag in SPACED else self.close)()
            was = self.indent
            self.indent += "  " if tag in ("blockquote", "dd") else ""
            self.walk(child, pre or tag == "pre")
            (self.gap if tag in SPACED else self.close)()
            self.indent = was
        else:
            self.walk(child, pre, ordered)

    def table(self, table: Node) -> None:
        """Rows of cells, each column as wide as its widest cell; cells of several lines take several rows.

        Places that a cell spans beside its first one are empty.
        """
        rows, captions = [], []

        def row_of(row: Node, spans: list[int]) -> None:
            """The texts of a row; ``spans`` holds how many rows more each column is taken from above."""
            texts, below = [], []

            def place(text: str, more: int) -> None:
                texts.append(text)
                if len(below) < MAX_SPANNED:
                    below.append(more)

            def taken() -> None:
                while len(texts) < len(spans) and spans[len(texts)]:
                    place("", spans[len(texts)] - 1)

            loose = []
            for child in row.children:
                if isinstance(child, str) or child.tag not in ("td", "th"):
                    loose.append(child)
                elif _seen(child, self.rules):
                    taken()
                    more = _span(child, "rowspan", 65534) - 1
                    place(self.block(child), more)
                    for _ in range(_span(child, "colspan", 1000) - 1):
                        if len(texts) < MAX_SPANNED:
                            place("", more)
            ends = max((k + 1 for k, n in enumerate(spans) if n), default=0)
            while len(texts) < ends:
                place("", max(0, spans[len(texts)] - 1))
            spans[:] = below
            rows.append(texts if len(loose) < len(row.children) else [])
            captions.extend(x for x in (self.block_of(loose),) if x.strip())

        def cells(node: Node) -> None:
            spans: list[int] = []
            for child in node.children:
                if isinstance(child, str):
                    if child.strip() and self.shown:
                        captions.append(_SPACE.sub(" ", html.unescape(child)).strip())
                    continue
                if not _seen(child, self.rules):
                    continue
                was, self.shown = self.shown, self.rules.shown(child, self.shown)
                if child.tag in ROW_GROUPS:
                    cells(child)
                elif child.tag == "tr":
                    row_of(child, spans)
                elif child.tag in ("td", "th"):
                    rows.append([self.block_of(child.children)])
                else:
                    captions.append(self.block_of(child.children))
                self.shown = was

        cells(table)
        self.lines += [self.indent + line for c in captions for line in c.split("\n") if line]
        split = [[c.split("\n") for c in row] for row in rows]
        width: list[int] = []
        for row in split:
            for k, cell in enumerate(row):
                wide = max((len(line) for line in cell if len(line) <= MAX_PAD), default=0)
                if k < len(width):
                    width[k] = max(width[k], wide)
                else:
                    width.append(wide)
        aligned, at = 0, 0
        while aligned < len(width) and at <= MAX_LINE:
            at += width[aligned] + 2
            aligned += 1
        for row in split:
            for i in range(max(map(len, row), default=0)):
                parts = [cell[i] if i < len(cell) else "" for cell in row]
                near = [p.ljust(w) for p, w in zip(parts[:aligned], width, strict=False)]
                self.lines.append((self.indent + "  ".join([*near, *filter(None, parts[aligned:])])).rstrip())

    def block(self, node: Node) -> str:
        was, self.shown = self.shown, self.rules.shown(node, self.shown)
        text = self.block_of(node.children)
        self.shown = was
        return text

    def block_of(self, children: list) -> str:
        inner, holder = Renderer(self.rules, self.shown), Node("#cell", {}, None)
        holder.children = children
        inner.walk(holder)
        return inner.done()

    def done(self) -> str:
        self.close()
        return "\n".join(self.lines).strip("\n")


def render(page: str) -> str:
    # nested tables take several calls a level
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * MAX_DEPTH))
    root, rules = build(page)
    out = Renderer(rules)
    out.walk(root)
    return out.done()


def extract(pages: DataFrame, key: str = "page_id", markup: str = "html") -> DataFrame:
    """The key and the visible text of each page; whole pages, in batches."""

    def run(batches):
        for batch in batches:
            texts = [render(p) for p in strings(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    rows = pages.select(F.col(key), F.coalesce(F.col(markup).cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, with_columns(rows.select(key).schema, ("text", "string")))
