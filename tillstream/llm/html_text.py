"""Layout-aware text of web pages.

A page is cut into tags and texts, and a tree is built with the tags that HTML implies: a new
paragraph, list item, row or cell ends the open one, rows and cells get their missing parents,
stray end tags are ignored. Rendering walks the tree and leaves out what a browser doesn't show.
Blocks start on their own line, paragraphs and headings with an empty line around them; lists get
markers and indents; table cells are aligned in columns; preformatted text keeps its spaces.
All visible text is kept, whether article, menu or footer.

Of style sheets and style attributes, display and visibility count, with the weights of the cascade,
for a screen `WIDTH` pixels wide. Rules under other conditions and selectors other than tags, ids
and classes of one element aren't applied, whether they hide or show.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import small_batches

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NOT_SHOWN = frozenset("""head script style template noscript title iframe noembed noframes object video audio
    canvas datalist annotation annotation-xml""".split())
# Of a drawing, texts and embedded pages are shown, unless they only define something.
SVG_TEXT = frozenset("text foreignobject".split())
SVG_UNSEEN = frozenset("defs symbol clippath mask pattern marker metadata desc".split()) | NOT_SHOWN
# These tags end an open drawing or formula, unless they are where it holds a page's content.
ENDS_FOREIGN = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img
    li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
PAGE_WITHIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr details".split())
BLOCK = SPACED | frozenset("""html body div section article aside nav header footer main address form li dt dd
    figcaption legend summary caption center dialog menu search hgroup listing xmp plaintext""".split())
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup col".split())
# A start tag ends these open elements, up to the nearest of the second set.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "table")), "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")), "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th", "caption", "colgroup"), ("tr", "table")), "th": (("td", "th", "caption", "colgroup"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "body": (("head",), ()),
}
P_SCOPE = ("table", "td", "th", "caption", "button", "body", "html")

TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)|[!?/][^>]*+>)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
SPACES = re.compile(r"[ \t\n\r\f]+")
STYLE_TOKEN = re.compile(r"""\"(?:[^"\\]|\\.)*\"?|'(?:[^'\\]|\\.)*'?|[{};]|[^{};"']+""", re.S)
DECLARED = re.compile(r"\s*(display|visibility)\s*:\s*([a-z][a-z -]*?)\s*(!\s*important\s*)?", re.I)
COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
MEDIA = re.compile(r"(?:(?:only\s+)?(?:screen|all)|(?=\())(?:(?:\s+and\s+)?\(\s*(?:min|max)-width\s*:\s*\d+(?:\.\d+)?(?:px|r?em)\s*\))*")
BOUND = re.compile(r"(min|max)-width\s*:\s*(\d+(?:\.\d+)?)(px|r?em)")
# Style sheets count as on a screen this wide.
WIDTH = 1_280
# Columns wider than this aren't padded: alignment costs no more than so many spaces a cell.
PADDED = 60


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    if text in (">", "/>"):
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text[:-1])}


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    open_nodes = [root]
    at, end = 0, len(html)
    foreign = False  # whether there was a drawing or a formula

    def close(tags, stops) -> None:
        for i in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[i].tag in tags:
                keep = i
                while keep > 1 and open_nodes[keep - 1].tag in tags:
                    keep -= 1
                del open_nodes[keep:]
                return
            if open_nodes[i].tag in stops:
                return

    def enter(tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        open_nodes[-1].children.append(node)
        open_nodes.append(node)
        return node

    while at < end:
        m = TAG.search(html, at)
        if m is None:
            open_nodes[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            open_nodes[-1].children.append(unescape(html[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(x.tag == "p" for x in open_nodes):
                open_nodes[-1].children.append(Node("p", {}))
            for i in range(len(open_nodes) - 1, 0, -1):
                name = open_nodes[i].tag
                if name == tag:
                    del open_nodes[i:]
                    break
                # A table's parts end only with it, and inline tags don't end blocks.
                if name == "table" or name in ("td", "th") and tag not in TABLE_PARTS and tag != "table":
                    break
                if tag not in BLOCK and tag not in TABLE_PARTS and name in BLOCK:
                    break
            continue
        if tag in ("html",):
            continue
        if foreign and tag in ENDS_FOREIGN:
            inner = _foreign(open_nodes)
            if inner:
                del open_nodes[inner:]
        if tag in BLOCK:
            close(("p",), P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and re.fullmatch("h[1-6]", open_nodes[-1].tag):
            open_nodes.pop()
        if open_nodes[-1].tag == "head" and (tag in BLOCK or tag == "body"):
            open_nodes.pop()
        if tag in ("td", "th") and not _within(open_nodes, "tr") or tag == "tr" and not _within(open_nodes, "table"):
            if tag != "tr":
                if not _within(open_nodes, "table"):
                    enter("table", {})
                enter("tr", {})
            else:
                enter("table", {})
        node = enter(tag, _attributes(m[3]))
        foreign = foreign or tag in ("svg", "math")
        if tag in VOID or foreign and m[3].endswith("/>") and _foreign(open_nodes):
            open_nodes.pop()
        elif tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>|</{tag}\\Z", re.I).search(html, at)
            text = html[at:stop.start() if stop else end]
            node.children.append(unescape(text) if tag in ("textarea", "title") else text)
            open_nodes.pop()
            at = stop.end() if stop else end
    return root


def _within(open_nodes: list[Node], tag: str) -> bool:
    """Whether an element of this tag is open within the nearest table."""
    for node in reversed(open_nodes):
        if node.tag == tag:
            return True
        if node.tag == "table":
            return False
    return False


def _foreign(open_nodes: list[Node]) -> int:
    """The place of the drawing or formula that the next tag is in, or 0."""
    for i in range(len(open_nodes) - 1, 0, -1):
        if open_nodes[i].tag in ("svg", "math"):
            return i
        if open_nodes[i].tag in PAGE_WITHIN:
            return 0
    return 0


def _on_screen(media: str) -> bool:
    """Whether one of these media queries holds on a screen of the assumed width."""
    for one in media.lower().split(","):
        if not one.strip():
            return not media.strip()
        if MEDIA.fullmatch(one.strip()):
            bounds = [(side, float(n) * (1 if unit == "px" else 16)) for side, n, unit in BOUND.findall(one)]
            if all(WIDTH >= n if side == "min" else WIDTH <= n for side, n in bounds):
                return True
    return False


def _applies(at_rule: str) -> bool:
    name, _, condition = at_rule[1:].partition(" ")
    if name.lower().startswith("media"):
        return _on_screen(at_rule[len("@media"):])
    return name.lower() == "layer" or name.lower() == "supports" and "not" not in condition.lower()


def _declared(parts: list[str]) -> list[tuple[str, str, bool]]:
    """(property, value, whether important) of what bears on visibility."""
    found = (DECLARED.fullmatch(part) for part in parts)
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in found if m]


def _rules(sheet: str):
    """(selectors, declarations) of the rules that count, in order."""
    sheet = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", sheet, flags=re.S)
    blocks: list = []  # open blocks: whether a condition holds, or a rule's selectors and parts
    now: list[str] = []
    for token in [*STYLE_TOKEN.findall(sheet), *"}" * (1 + sheet.count("{"))]:
        inside = blocks and isinstance(blocks[-1], tuple)
        if token == "{":
            start = "".join(now).strip()
            blocks.append(False if inside else _applies(start) if start.startswith("@") else (start, []))
            now = []
        elif token == "}":
            if inside:
                blocks[-1][1].append("".join(now))
                if all(x for x in blocks[:-1]):
                    yield blocks[-1][0], _declared(blocks[-1][1])
            if blocks:
                blocks.pop()
            now = []
        elif token == ";":
            if inside:
                blocks[-1][1].append("".join(now))
            now = []
        else:
            now.append(token)


def _styles(root: Node, fold: bool) -> dict[str, list]:
    """By a tag, .class, #id or *: the rules of the page's style sheets whose selector has it.

    A rule is (tag, ids, classes, weight, declarations); names are in lower case if `fold`.
    """
    sheets, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "style" and _on_screen(node.attrs.get("media", "")):
            sheets.append("".join(x for x in node.children if isinstance(x, str)))
        if node.tag != "template":
            todo.extend(x for x in reversed(node.children) if isinstance(x, Node))
    found: dict[str, list] = {}
    for order, (selectors, declared) in enumerate(x for sheet in sheets for x in _rules(sheet)):
        for one in selectors.split(",") if declared else ():
            m = COMPOUND.fullmatch(one.strip())
            if not m or not m[0]:
                continue
            tag = "" if m[1] in (None, "*") else m[1].lower()
            names = re.findall(r"[.#][\w-]+", m[2].lower() if fold else m[2])
            ids, classes = ([n for n in names if n[0] == kind] for kind in "#.")
            weight = (len(ids), len(classes), bool(tag), order)
            found.setdefault((ids + classes + [tag or "*"])[0], []).append((tag, ids, classes, weight, declared))
    return found


def _style(node: Node, styles: dict[str, list], fold: bool) -> dict[str, str]:
    """What the page says of the element's display and visibility."""
    a = node.attrs
    best: dict[str, tuple] = {}

    def say(declared, weight) -> None:
        for n, (name, value, important) in enumerate(declared):
            rank = (important, weight, n)
            if name not in best or rank > best[name][0]:
                best[name] = rank, value

    if styles:
        own, names = a.get("id", ""), a.get("class", "")
        own, names = (own.lower(), names.lower()) if fold else (own, names)
        held = {f"#{own}", *(f".{c}" for c in names.split())}
        for key in (*held, node.tag, "*"):
            for tag, ids, classes, weight, declared in styles.get(key, ()):
                if (not tag or tag == node.tag) and held.issuperset(ids) and held.issuperset(classes):
                    say(declared, (0, *weight))
    if "style" in a:
        say(_declared(a["style"].split(";")), (1, 0, 0, 0, 0))
    return {name: value for name, (_, value) in best.items()}


def _shown(node: Node, styles: dict[str, list], fold: bool) -> bool | None:
    """Whether the element is shown; None if it isn't, but elements in it may be."""
    if node.tag in NOT_SHOWN or node.tag == "input":
        return False
    a = node.attrs
    style = _style(node, styles, fold) if styles or "style" in a else {}
    if style.get("display", "none" if "hidden" in a or node.tag == "dialog" and "open" not in a else "") == "none":
        return False
    return None if style.get("visibility") in ("hidden", "collapse") else True


def _visible_within(node: Node, styles: dict[str, list], fold: bool) -> list:
    """Of an invisible element, the elements that are made visible again."""
    out, todo = [], list(reversed(node.children))
    while todo:
        item = todo.pop()
        if isinstance(item, Node) and _shown(item, styles, fold):
            if _style(item, styles, fold).get("visibility") == "visible":
                out += [" ", item, " "]
            else:
                todo.extend(reversed(item.children))
        elif isinstance(item, Node) and _shown(item, styles, fold) is None:
            todo.extend(reversed(item.children))
    return out


def _texts(node: Node) -> str:
    """All text in an element."""
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag not in NOT_SHOWN:
            todo.extend(reversed(item.children))
    return "".join(out)


def _drawn(svg: Node) -> list:
    """The texts of a drawing."""
    out, todo = [], list(reversed(svg.children))
    while todo:
        item = todo.pop()
        if isinstance(item, Node) and item.tag in SVG_TEXT:
            out += [" ", item, " "]
        elif isinstance(item, Node) and item.tag not in SVG_UNSEEN:
            todo.extend(reversed(item.children))
    return out


def _chosen(select: Node) -> list:
    """What a closed select shows, its selected option; of a list box, all options and their groups."""
    options, todo = [], list(reversed(select.children))
    while todo:
        item = todo.pop()
        if isinstance(item, Node) and "hidden" not in item.attrs:
            if item.tag in ("option", "optgroup"):
                options.append(item)
            if item.tag != "option":
                todo.extend(reversed(item.children))
    rows = _span(select, "size", 1_000)
    if "multiple" not in select.attrs and rows == 1:
        options = [x for x in options if x.tag == "option"]
        marked = [x for x in options if "selected" in x.attrs]
        options = marked[-1:] or [x for x in options if "disabled" not in x.attrs][:1]
    return [y for x in options for y in (" ", x.attrs.get("label") or (_texts(x) if x.tag == "option" else ""), " ")]


class Lines:
    """Text laid out in lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = self.empty_line = False
        self.indents: list[str] = []
        self.marker: str | None = None

    def flow(self, text: str) -> None:
        if not text:
            return
        inner = SPACES.sub(" ", text)
        if inner[0] == " ":
            self.space = True
            inner = inner[1:]
        if not inner:
            return
        if self.space and self.now:
            self.now.append(" ")
        self.space = inner[-1] == " "
        self.now.append(inner[:-1] if self.space else inner)

    def keep(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for line in rest:
            self.end(force=True)
            self.now.append(line)

    def end(self, force: bool = False) -> None:
        """End the line, if there is one."""
        text = "".join(self.now).replace("\xa0", " ").rstrip()
        self.now, self.space = [], False
        if not text and not force:
            return
        if text and self.empty_line and self.lines:
            self.lines.append("")
        self.empty_line = self.empty_line and not text
        lead = "".join(self.indents)
        if text and self.marker is not None:
            lead, self.marker = "".join(self.indents[:-1]) + self.marker, None
        self.lines.append((lead + text).rstrip())

    def block(self, spaced: bool) -> None:
        self.end()
        self.empty_line = self.empty_line or spaced


def _table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, column span, row span) as aligned lines."""
    taken: dict[tuple[int, int], bool] = {}
    placed, widths = [], {}
    for r, row in enumerate(rows):
        at, out = 0, []
        for lines, across, down in row:
            while (r, at) in taken:
                at += 1
            out.append((at, across, lines))
            if across == 1:
                widths[at] = max(widths.get(at, 0), max(map(len, lines), default=0))
            for y in range(r + 1, min(r + down, len(rows))):
                for x in range(at, at + across):
                    taken[y, x] = True
            at += across
        placed.append(out)
    found = []
    for out in placed:
        for k in range(max((len(lines) for _, _, lines in out), default=0)):
            parts, at = [], 0
            for column, across, lines in out:
                parts += [" " * min(widths.get(x, 0), PADDED) for x in range(at, column) if x in widths]
                width = min(sum(widths.get(x, 0) + 3 for x in range(column, column + across)) - 3, PADDED)
                parts.append((lines[k] if k < len(lines) else "").ljust(max(width, 0)))
                at = column + across
            found.append(" | ".join(parts).rstrip())
    return found


def _span(node: Node, name: str, most: int) -> int:
    text = node.attrs.get(name, "1").strip()
    return min(max(int(text), 1), most) if text.isascii() and text.isdigit() and len(text) < 9 else 1


def render(html: str) -> str:
    """The visible text of a page."""
    root, fold = parse(html), not re.match(r"\s*<!doctype", html, re.I)
    styles = _styles(root, fold)
    outs = [Lines()]
    tables: list[list] = []
    lists: list[list] = []
    preformatted = 0
    todo: list = [root]
    while todo:
        item = todo.pop()
        out = outs[-1]
        if isinstance(item, str):
            (out.keep if preformatted else out.flow)(item)
            continue
        if isinstance(item, tuple):  # the end of an element
            tag, node = item[0].tag, item[0]
            if tag == "pre":
                preformatted -= 1
            if tag in ("td", "th", "caption"):
                out.end()
                outs.pop()
                if tag == "caption":
                    outs[-1].block(True)
                    for line in out.lines:
                        outs[-1].keep(line)
                        outs[-1].end()
                else:
                    tables[-1][-1].append((out.lines, _span(node, "colspan", 1_000), _span(node, "rowspan", 65_534)))
            elif tag == "table":
                for line in _table(tables.pop()):
                    out.keep(line)
                    out.end()
                out.block(True)
            else:
                out.end()
                if tag in ("li", "dd", "blockquote"):
                    out.indents.pop()
                    out.marker = None
                if tag in ("ul", "ol", "menu"):
                    lists.pop()
                out.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            continue
        tag = item.tag
        shown = _shown(item, styles, fold)
        if not shown:
            if shown is None:
                todo.extend(reversed(_visible_within(item, styles, fold)))
            continue
        children = item.children
        if tag == "br":
            out.end(force=True)
            continue
        if tag == "hr":
            out.block(True)
            out.now.append("---")
            out.block(True)
            continue
        if tag == "svg":
            children = _drawn(item)
        elif tag == "select":
            children = _chosen(item)
        if tag == "details" and "open" not in item.attrs:
            children = [x for x in children if isinstance(x, Node) and x.tag == "summary"]
        if tag in ("td", "th", "caption"):
            if not tables:
                tables.append([])
            if tag != "caption" and not tables[-1]:
                tables[-1].append([])
            outs.append(Lines())
            todo.append((item,))
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in BLOCK:
            out.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "table":
                tables.append([])
            elif tag in ("ul", "menu"):
                lists.append([None])
            elif tag == "ol":
                lists.append([_span(item, "start", 10 ** 8)])
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] is not None:
                    marker = f"{lists[-1][0]}. "
                    lists[-1][0] += 1
                out.indents.append(" " * len(marker))
                out.marker = marker
            elif tag in ("dd", "blockquote"):
                out.indents.append("  ")
            elif tag == "pre":
                preformatted += 1
            todo.append((item,))
        todo.extend(reversed(children))
    outs[0].end()
    return "\n".join(outs[0].lines).strip("\n")


def _rendered(html: pd.Series) -> pd.Series:
    return html.map(lambda page: render(page) if isinstance(page, str) else "")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text (all visible text), n_chars and n_lines of each page.

    Reads page_id and html, whatever else the table has. A null or empty page has the empty text
    and no lines; a null page_id stays null; repeated rows give equal rows; an empty table none.
    """
    small_batches(pages.sparkSession)
    text = F.pandas_udf(_rendered, "string")(F.col("html").cast("string"))
    return (pages.select("page_id", text.alias("text"))
            .select("page_id", "text", F.length("text").cast("long").alias("n_chars"),
                    F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines")))
