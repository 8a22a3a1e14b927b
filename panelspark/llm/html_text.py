"""Main text of HTML pages by tree scoring.

A page is parsed into a tree. What is never article text is cut: scripts, styles, forms, menus, headers,
footers, sidebars, and elements whose class, id or role names an advert, notice, comment or the
like. A form, or an element that such a name says something about (``no-sidebar``, ``has-comments``), is not cut where it
holds nearly all paragraphs of the page. Every remaining block of text passes points for its length and commas to its ancestors, half
as many a level up; a container's points are discounted by its share of link text. The best
container is kept with those siblings that score near it, and all their blocks are the text.

Null, empty and textless pages give the empty text. Broken markup is read as far as it goes: unclosed
elements end with their parent, stray end tags are skipped, tags without an end are text. Time and memory grow
with the length of a page, however deep or broken it is. Equal scores go to the outermost container. Rows are
independent; extra columns stay, repeated rows repeat, an empty table stays empty. A column of the result's name is an error.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from panelspark.llm.common import Batches, map_batches, texts_of

# Element names of HTML, and the words that mark what is not an article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_CUT = frozenset(
    "script style noscript template iframe nav header footer aside form button select textarea input fieldset dialog "
    "svg math canvas object audio video map menu head title datalist label option".split())
_BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption "
    "table thead tbody tfoot tr td th caption address details summary center hgroup hr".split())
_CONTAINER = frozenset("html body article main section div td blockquote center".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = _BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"} | {"form", "nav", "header", "footer", "aside", "fieldset"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert alerts popup modal overlay newsletter subscribe subscription signup signin login sidebar sidenav "
    "aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies respond disqus "
    "discussion related recommended recommendations share sharing social toolbar pager pagination widget widgets skip "
    "search searchbox form".split())
# Names that always mean a notice or an advert; the others may also tell how a whole page is laid out.
_NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert alerts popup modal overlay newsletter".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_UNENDED = re.compile(r"<[!?]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/\"'>]+)")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SEPARATOR = re.compile(r"[^a-z]+")
#: Paragraph text that makes an element with an unwanted name the article, and how much more than elsewhere.
_LEAST_PROSE, _MORE_PROSE = 200, 4

_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "points", "length", "linked", "why", "block")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.points, self.length, self.linked = 0.0, 0, 0
        self.why: str | None = None
        self.block: Node = self if tag in _BLOCK or parent is None else parent.block


def parse(page: str) -> Node:
    """The tree of a page. Text is kept raw, with its character references."""
    root = at = Node("html", "", None)
    open_: dict[str, int] = {}
    position, ends = 0, {}
    limit = page.rfind(">") + 1  # no tag ends behind it

    def close(to: Node) -> Node:
        node = at
        while node is not to:
            open_[node.tag] -= 1
            node = node.parent
        return to

    while True:
        token = _TOKEN.search(page, position, limit)
        if token and token.end() == limit and token[0][-1] != ">":
            token = None  # a comment or declaration that does not end
        if not token:
            rest = _UNENDED.search(page, position)
            text = page[position : rest.start() if rest else len(page)]
            if text:
                at.children.append(text)
            return root
        if token.start() > position:
            at.children.append(page[position : token.start()])
        position = token.end()
        end, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue  # the root stands for both
        if end:
            if open_.get(tag):
                node = at
                while node.tag != tag:
                    node = node.parent
                at = close(node.parent)
            continue
        if tag in _CLOSES_P and open_.get("p"):
            node = at
            while node.tag != "p":
                node = node.parent
            at = close(node.parent)
        if tag in _ENDS:
            same, within = _ENDS[tag]
            node = at
            while node is not root and node.tag not in same and node.tag not in within:
                node = node.parent
            if node.tag in same:
                at = close(node.parent)
        new = Node(tag, attributes, at)
        at.children.append(new)
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK and tag not in _RAW:
            continue
        if tag in _RAW:
            if tag not in ends:
                ends[tag] = re.compile(f"</{tag}\\s*[^>]*>", re.I)
            found = ends[tag].search(page, position, limit)
            new.children.append(page[position : found.start() if found else len(page)])
            position = found.end() if found else len(page)
            continue
        at = new
        open_[tag] = open_.get(tag, 0) + 1


def _attributes(node: Node) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(node.attributes)}


def _unwanted(node: Node) -> str:
    """Whether attributes say that an element is cut, as ``_cut`` does."""
    if not node.attributes.strip():
        return ""
    attributes = _attributes(node)
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return "always"
    if attributes.get("role", "").lower() in _ROLES:
        return "always"
    if node.tag in ("article", "main"):
        return ""
    found = ""
    for name in [*attributes.get("class", "").split(), *attributes.get("id", "").split()]:
        words = _SEPARATOR.split(_CAMEL.sub("-", name).lower())
        if not _NOTICES.isdisjoint(words):
            return "always"
        if not _NAMED.isdisjoint(words):
            found = "layout"
    return found


def _cut(node: Node) -> str:
    """Why an element is cut: "always", "layout" if it may hold the article all the same, or "" if it stays."""
    if node.why is None:
        if node.tag in _CUT:
            node.why = "layout" if node.tag in ("form", "fieldset") else "always"
        else:
            node.why = _unwanted(node)
    return node.why


def _holders(root: Node) -> set[Node]:
    """Forms and elements of unwanted names that hold nearly all paragraphs of the page, or of such an element around them."""
    order, prose = [], {}
    stack = [(root, False)]
    while stack:
        node, paragraph = stack.pop()
        order.append(node)
        prose[node] = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if paragraph else 0
        for child in node.children:
            if isinstance(child, Node) and child.tag != "a" and _cut(child) != "always":
                stack.append((child, paragraph or child.tag == "p"))
    clean, largest = dict(prose), {}
    for node in reversed(order):  # children first
        parent = node.parent
        if parent is None:
            continue
        prose[parent] += prose[node]
        inner = node if _cut(node) else largest.get(node)
        if not _cut(node):
            clean[parent] += clean[node]
        if inner is not None and prose[inner] >= prose.get(largest.get(parent), 0):
            largest[parent] = inner
    stay, scope = set(), root
    while scope in largest and prose[largest[scope]] >= max(_LEAST_PROSE, _MORE_PROSE * clean[scope]):
        scope = largest[scope]
        stay.add(scope)
    return stay


class _Block:
    """Text of one block: its container, and how much of it is link text."""

    __slots__ = ("node", "parts", "linked")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked = node, [], 0


def _walk(root: Node) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """All wanted blocks in page order with their nodes, and all wanted nodes, parents first."""
    stay = _holders(root)
    blocks: list[tuple[Node, str, int]] = []
    nodes: list[Node] = []
    current = _Block(root)

    def flush(node: Node) -> None:
        nonlocal current
        text = " ".join("".join(current.parts).split())
        if text:
            blocks.append((current.node, text, min(current.linked, len(text))))
        current = _Block(node)

    stack: list[tuple[Node, int, int]] = [(root, 0, 0)]
    nodes.append(root)
    while stack:
        node, at, links = stack.pop()
        if at == len(node.children):
            if node.tag in _BLOCK and stack:
                flush(node.parent.block)
            continue
        stack.append((node, at + 1, links))
        child = node.children[at]
        if isinstance(child, str):
            text = html.unescape(child) if "&" in child else child
            current.parts.append(text)
            if links:
                current.linked += len(text.strip())
            continue
        tag = child.tag
        if tag == "br":
            current.parts.append(" ")
            continue
        if tag == "header" and _inside(child, ("article", "main")):
            # The head of an article holds its title, and bylines that are no part of it.
            child.children = [c for c in child.children if isinstance(c, Node) and c.tag in _HEADING | {"hgroup"}]
        elif _cut(child) and child not in stay:
            if tag in _BLOCK or tag in ("form", "nav", "header", "footer", "aside", "fieldset", "menu"):
                flush(node.block)
            continue
        nodes.append(child)
        if tag in _BLOCK:
            flush(child)
        stack.append((child, 0, links + (tag == "a")))
    flush(root)
    return blocks, nodes


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def extract(page: str | None) -> str:
    """The main text of one page: its blocks, joined by line feeds."""
    if not page:
        return ""
    blocks, nodes = _walk(parse(page))
    if not blocks:
        return ""
    for node, text, linked in blocks:
        points = min(len(text) / 25, 1.0) + text.count(",") + min(len(text) / 100, 3.0)
        up = node if node.tag in _CONTAINER else node.parent or node
        up.points += points * (1 - linked / len(text))
        up.length += len(text)
        up.linked += linked
    # Lengths of blocks and of what lies between them and their container, for the share of links.
    between = {node: [0, 0] for node in nodes}
    for node, text, linked in blocks:
        between[node][0] += len(text)
        between[node][1] += linked
    for node in reversed(nodes):  # children first
        inner, parent = node.parent is not None and node.tag not in _CONTAINER, node.parent
        if parent is not None:
            parent.points += node.points / 2
            parent.length += node.length
            parent.linked += node.linked
            if inner:
                between[parent][0] += between[node][0]
                between[parent][1] += between[node][1]
        if inner:
            node.length += between[node][0]
            node.linked += between[node][1]
    score = {}
    for node in nodes:
        if node.length and (node.tag in _CONTAINER or node.parent is None):
            bonus = 25.0 if node.tag in ("article", "main") else 0.0
            score[node] = (node.points + bonus) * (1 - node.linked / node.length)
    best = max(score, key=score.get)  # the first of equals, which is the outermost
    for tag in ("article", "main"):  # a part of an article stands for the article
        up = best
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None:
            best = up
            break
    kept = {best}
    for sibling in best.parent.children if best.parent is not None else ():
        if isinstance(sibling, Node) and sibling is not best and sibling.length:
            text_like = sibling.tag == "p" and sibling.length >= 80 and sibling.linked < 0.25 * sibling.length
            if sibling.tag in _HEADING or text_like or score.get(sibling, 0.0) >= max(10.0, 0.5 * score[best]):
                kept.add(sibling)
    # Whether a node lies in what is kept, and below that in a list of links.
    inside: dict[Node, tuple[bool, bool]] = {}
    for node in nodes:
        if node in kept:
            inside[node] = (True, False)
        else:
            within, menu = inside.get(node.parent, (False, False))
            links = node.tag in ("ul", "ol") and node.length and node.linked > 0.8 * node.length and len(node.children) > 2
            inside[node] = (within, bool(menu or links))
    return "\n".join(text for node, text, _ in blocks if inside[node] == (True, False))


def main_text(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every page."""
    if text.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {text} exists already")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = pa.array([extract(p) for p in texts_of(batch, page)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, text])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return map_batches(df, run, ", ".join([*fields, f"`{text}` string"]))
