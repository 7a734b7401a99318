"""HTML steps that need a parsed document: stripping, tables, spans, page facts.

A small tree builder on the standard library's parser stands in for a full HTML
engine: void elements, and implied ends of paragraphs, list items, rows and cells.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

from sheafwork.functions.text import clean_text_py

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends the open elements named for it.
_IMPLIED_END = {
    "p": {"p"}, "div": {"p"}, "table": {"p"}, "ul": {"p"}, "ol": {"p"}, "li": {"li", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
}
_SCOPE = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

# Backgrounds that do not mark a table as numeric.
PLAIN_BACKGROUNDS = frozenset(["none", "transparent", "#ffffff", "#fff", "white"])


class _Data(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def drop_tags(html: str) -> str:
    """Character data with entities decoded; an unfinished tag or comment at the end is lost, script text stays."""
    parser = _Data()
    parser.feed(html)
    return "".join(parser.parts)


# Which tags give line feeds or blanks; letter case and attributes matter.
_BLOCK_END = re.compile(r"<\s*/\s*(?:div|tr|p|li|)\s*>")
_BREAK = re.compile(r"<br\s*/?>")
_CELL_END = re.compile(r"<\s*/\s*(?:th|td)\s*>")


def strip_markup(html: str) -> str:
    """Block ends and breaks to line feeds, cell ends to blanks, then tags dropped."""
    html = _BLOCK_END.sub(lambda m: m.group() + "\n\n", html)
    html = _BREAK.sub(lambda m: m.group() + "\n\n", html)
    return drop_tags(_CELL_END.sub(lambda m: f" {m.group()} ", html))


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """All descendants in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)

    def text(self) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(out)

    def replace_with(self, *items: Node | str) -> None:
        parent = self.parent
        if parent is None:
            return
        at = next(i for i, c in enumerate(parent.children) if c is self)
        parent.children[at : at + 1] = items
        for item in items:
            if isinstance(item, Node):
                item.parent = parent
        self.parent = None

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def serialise(self) -> str:
        out: list[str] = []
        stack: list[Node | str | tuple[str]] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(escape(item, quote=False))
            else:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in item.attrs.items())
                if item.tag in _VOID:
                    out.append(f"<{item.tag}{attrs}/>")
                    continue
                if item.tag != "#root":
                    out.append(f"<{item.tag}{attrs}>")
                    stack.append((f"</{item.tag}>",))
                stack.extend(reversed(item.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _close(self, tags: set[str], stop: set[str]) -> None:
        node, top = self.at, None
        while node.parent is not None and node.tag not in stop:
            if node.tag in tags:
                top = node
            node = node.parent
        if top is not None:
            self.at = top.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _IMPLIED_END:
            self._close(_IMPLIED_END[tag], _SCOPE.get(tag, {"table", "td", "th", "li", "div"}) | {"#root"})
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag == "table" and tag != "table":
                return  # an end inside a table closes nothing outside it
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def is_html(root: Node) -> bool:
    """A document counts as HTML if it has at least one cell and one row."""
    return bool(root.find_all("td")) and bool(root.find_all("tr"))


def _coloured(node: Node) -> bool:
    style = dict(
        (name.strip().lower(), value.replace("!important", "").strip().lower())
        for name, _, value in (part.partition(":") for part in node.attrs.get("style", "").split(";"))
    )
    if node.attrs.get("bgcolor", "none").lower() not in PLAIN_BACKGROUNDS:
        return True  # also an empty one
    return any(v and v not in PLAIN_BACKGROUNDS for v in (style.get("background"), style.get("background-color")))


def drop_numeric_tables(root: Node, item_header: re.Pattern) -> None:
    """Remove tables with a coloured row or cell, unless an item header stands in them."""
    for table in root.find_all("table"):
        top = table
        while top.parent is not None:
            top = top.parent
        if top is not root:
            continue  # went with an outer table
        if item_header.search(clean_text_py(strip_markup(table.serialise()))):
            continue
        if any(_coloured(n) for n in table.find_all("tr", "td", "th")):
            table.replace_with()


def resolve_spans(root: Node) -> None:
    """Spans with text dissolve into their content, every other becomes a blank; each node's children are rebuilt once."""
    for node in [*reversed(list(root.walk())), root]:  # inner spans first
        if not any(isinstance(c, Node) and c.tag == "span" for c in node.children):
            continue
        merged: list[Node | str] = []
        for c in node.children:
            if isinstance(c, Node) and c.tag == "span":
                merged += c.children if c.text().strip() else [" "]
            else:
                merged.append(c)
        for c in merged:
            if isinstance(c, Node):
                c.parent = node
        node.children = merged


# ---- pages of the filing archive -------------------------------------------------------------------------------

# Labels on the pages.
_STATE_LABELS = ("State of Incorp.", "State of Inc.", "State of Incorporation.")
_FILES_TABLE = "Document Format Files"
_COMPLETE = "Complete submission text file"


def index_page_facts(html: str, filing_types: list[str]) -> dict:
    """Facts of a filing's index page: dates, company facts, and the document to take.

    ``document_type`` null with a link means the complete submission was taken.
    """
    root = parse(html)
    labels = [n for n in root.find_all("div") if n.has_class("infoHead") or n.has_class("info")]
    pairs = {}
    for head, value in zip(labels, labels[1:]):
        if head.has_class("infoHead") and value.has_class("info"):
            pairs[head.text()] = value.text()
    facts = dict.fromkeys(["filing_date", "period_of_report", "state_of_inc", "fiscal_year_end", "sic", "htm_link", "text_link", "document_type"])
    facts["filing_date"], facts["period_of_report"] = pairs.get("Filing Date"), pairs.get("Period of Report")
    company = root.first(lambda n: n.tag == "div" and n.has_class("companyInfo"))
    ident = company.first(lambda n: n.tag == "p" and n.has_class("identInfo")) if company else None
    if ident is not None:
        text = ident.text()
        for part in text.split("|"):
            label, colon, value = part.partition(":")
            if colon and label.strip() in _STATE_LABELS:
                facts["state_of_inc"] = value.split(":")[0].strip()
        year_end = re.search(r"Fiscal Year End: *(\d{4})", text)
        facts["fiscal_year_end"] = year_end.group(1) if year_end else None
    sic = root.first(lambda n: n.tag == "a" and "SIC" in n.attrs.get("href", "") and _inside(n, "identInfo"))
    facts["sic"] = sic.text() if sic else None
    for table in root.find_all("table"):
        if table.attrs.get("summary") == _FILES_TABLE:
            facts |= _document_of(table, filing_types)
    return facts


def _inside(node: Node, class_name: str) -> bool:
    while node is not None:
        if node.has_class(class_name):
            return True
        node = node.parent
    return False


def _document_of(table: Node, filing_types: list[str]) -> dict:
    """The first row with a wanted type and an HTML document, or the complete submission if that comes first."""
    chosen = {"htm_link": None, "text_link": None, "document_type": None}
    for row in table.find_all("tr")[1:]:
        cells = row.find_all("td", "th")
        if len(cells) < 4:
            continue
        kind, name = cells[3].text(), cells[1].text()
        link = cells[2].first(lambda n: n.tag == "a")
        href = link.attrs.get("href", "") if link else ""
        if kind in filing_types:
            chosen["document_type"] = kind
            if href.rpartition(".")[2] in ("htm", "html"):
                chosen["htm_link"] = href
                break
        elif name == _COMPLETE:
            chosen["document_type"] = None
            chosen["text_link"] = href
            break
    return chosen


def company_page_facts(html: str) -> dict:
    """Facts of a company's page; all null if it has no company block."""
    facts = dict.fromkeys(["company_name", "sic", "state_location", "state_of_inc", "fiscal_year_end"])
    block = parse(html).first(lambda n: n.tag == "div" and n.has_class("companyInfo"))
    if block is None:
        return facts
    name = block.first(lambda n: n.tag == "span" and n.has_class("companyName"))
    if name is not None and name.children:
        first = name.children[0]
        facts["company_name"] = (first if isinstance(first, str) else first.text()).strip()
    ident = block.first(lambda n: n.tag == "p" and n.has_class("identInfo"))
    contents = ident.children if ident is not None else []
    for i, item in enumerate(contents):
        raw = item if isinstance(item, str) else item.attrs.get("href", "") + " " + item.text()
        if not isinstance(item, str) and ";SIC=" in raw.replace("&SIC=", ";SIC="):
            facts["sic"] = item.text()
        if not isinstance(item, str) and ";State=" in raw.replace("&State=", ";State="):
            facts["state_location"] = item.text()
        if "State of Inc" in raw and i + 1 < len(contents):
            following = contents[i + 1]
            facts["state_of_inc"] = following if isinstance(following, str) else following.text()
        if "Fiscal Year End" in raw:
            facts["fiscal_year_end"] = raw.split()[-1]
    return facts
