"""Main text of web pages by tag-path ratios.

A page's text blocks are grouped by their root-to-leaf tag path.  A path's text length and
punctuation per block are smoothed over neighbouring paths, fused with what the path's
elements stand for and, outside articles, with the share of its text that is no link, and
compared with a threshold; the blocks on paths that pass are the content, widened to the
container that covers them, less boilerplate parts.

Time and memory are linear in the page at any depth: a path is the number of its parent's
path and a step, open elements are found by name, and no walk to the root is made twice.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeshore.sources.tables import read_table

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_NAME = re.compile(r"[a-z]+")

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr ruby rb rp rt".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
PARAGRAPHS = frozenset("p li dt dd td th tr h1 h2 h3 h4 h5 h6 pre blockquote figcaption caption".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody"), "body": ("head",)}
SCOPE = frozenset("html body table ul ol dl select article section main div td th".split())
#: Elements, roles and words of class or id that mark boilerplate.
DROPPED = RAW | frozenset("head nav footer aside form button select option svg canvas object audio video dialog menu search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social comment "
    "comments disqus reply replies respond footer copyright legal disclaimer toolbar pagination pager paywall".split())
#: A class or id with one of these words tells about the element's surroundings, as in
#: "no-sidebar" or "comments-open", and does not mark it.
STATES = frozenset("no not with without has have is hide hides show shows open opened closed enabled disabled".split())
#: Only outside an article: the page's own header.
DROPPED_HEADERS = frozenset("header masthead topbar".split())
#: Nodes that stand for the whole page, which is no container of its text.
WHOLE = frozenset(["", "html", "body"])
MAIN_WORDS = frozenset("article content main post story entry body text".split())
#: Weight of a path with an article or main element or a word of MAIN_WORDS, and others.
MAIN_WEIGHT, OTHER_WEIGHT = 3.0, 1.0
#: Factor of paths below an element that may be boilerplate, by a part of its class or id.
MARKED_WEIGHT = 0.1
#: Smoothing over neighbouring paths, and the share of the best fused value that passes.
SMOOTHING = (0.25, 0.5, 0.25)
THRESHOLD = 0.15


@dataclass(slots=True, eq=False)
class Node:
    name: str
    path: int
    parent: Node | None
    depth: int
    dropped: bool
    main: float
    in_article: bool
    in_link: bool = False
    marked: bool = False

    @property
    def weight(self) -> float:
        return self.main * (MARKED_WEIGHT if self.marked else 1.0)


@dataclass(slots=True, eq=False)
class Block:
    node: Node
    pieces: list[str] = field(default_factory=list)
    text: str = ""
    letters: int = 0  # characters of the pieces, less white space at their ends, and those inside links
    linked: int = 0


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}


def _marks(tokens: list[list[str]], outside: bool) -> tuple[bool, bool]:
    """Whether one of the classes and ids, each given as its words, consists of boilerplate
    words, and whether one holds such a word besides others."""
    whole = part = False
    for words in tokens:
        if not STATES.isdisjoint(words):
            continue
        found = [w in DROPPED_WORDS for w in words]
        if outside and MAIN_WORDS.isdisjoint(words):
            found = [f or w in DROPPED_HEADERS for f, w in zip(found, words, strict=True)]
        whole = whole or (bool(words) and all(found))
        part = part or any(found)
    return whole, part


def _open(name: str, rest: str, parent: Node, paths: dict[tuple[int, str], int]) -> Node:
    in_article = parent.in_article
    outside = not in_article and name != "article"
    dropped = parent.dropped or name in DROPPED or (outside and name == "header")
    marked, role, step, main = parent.marked, "", name, parent.main
    if rest and not rest.isspace():
        marks = _attributes(rest)
        tokens = [_NAME.findall(t) for t in f"{marks.get('class', '')} {marks.get('id', '')}".lower().split()]
        role = marks.get("role", "").lower()
        if name not in ("html", "body", "main") and not dropped:
            dropped = (role in DROPPED_ROLES or "hidden" in marks or marks.get("aria-hidden", "").lower() == "true"
                       or "display:none" in marks.get("style", "").replace(" ", "").lower())
            whole, part = _marks(tokens, outside)
            # a container of main text is not dropped for its class; an article in an article may be a comment
            holds = any(len(t) == 1 and t[0] in MAIN_WORDS for t in tokens) or role == "main"
            if whole and not holds and (in_article or name != "article"):
                dropped = True
            marked = marked or part
        for word in (w for t in tokens for w in t):
            step += f".{word}"
            if word in MAIN_WORDS:
                main = MAIN_WEIGHT
    in_article = in_article or name in ("article", "main") or role == "main"
    if in_article:
        main = MAIN_WEIGHT
    path = paths.setdefault((parent.path, step), len(paths) + 1)
    return Node(name, path, parent, parent.depth + 1, dropped, main, in_article,
                parent.in_link or name == "a", marked)


class _Open:
    """The open elements: the innermost one, and by name the depths at which they stand."""

    def __init__(self) -> None:
        self.nodes = [Node("", 0, None, 0, False, OTHER_WEIGHT, False)]
        self.paths: dict[tuple[int, str], int] = {}
        self.places: dict[str, list[int]] = {}
        self.scopes = [0]
        self.owners = [self.nodes[0]]  # of each open element, the innermost that is not inline

    def enter(self, name: str, rest: str) -> None:
        node = _open(name, rest, self.nodes[-1], self.paths)
        self.nodes.append(node)
        self.places.setdefault(name, []).append(node.depth)
        self.owners.append(self.owners[-1] if name in INLINE else node)
        if name in SCOPE:
            self.scopes.append(node.depth)

    def leave(self, names: tuple[str, ...], scope: bool) -> None:
        """Close up to the innermost element of ``names``; with ``scope`` only if no element
        that bounds a scope is open inside it."""
        depth = 0
        for name in names:
            if (places := self.places.get(name)) and places[-1] > depth:
                depth = places[-1]
        if not depth or scope and self.scopes[-1] > depth:
            return
        while len(self.nodes) > depth:
            self.places[self.nodes.pop().name].pop()
            self.owners.pop()
        while self.scopes[-1] >= depth:
            self.scopes.pop()


def text_blocks(page: str) -> list[Block]:
    """The page's text blocks, in order: text between two block boundaries."""
    tree = _Open()
    blocks: list[Block] = []
    current: Block | None = None

    def add(text: str) -> None:
        nonlocal current
        node = tree.nodes[-1]
        if node.dropped or not text:
            return
        if current is None:
            current = Block(tree.owners[-1])
            blocks.append(current)
        current.pieces.append(text)
        letters = len(text.strip())
        current.letters += letters
        if node.in_link:
            current.linked += letters

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at: m.start()])
        at = m.end()
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if name not in INLINE:
            current = None
        if m["close"]:
            tree.leave((name,), scope=False)
            continue
        if name in ENDS_PARAGRAPH:
            tree.leave(("p",), scope=True)
        if name in SIBLINGS:
            tree.leave(SIBLINGS[name], scope=True)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not m["rest"].endswith("/"):
            tree.enter(name, m["rest"])
    add(page[at:])
    for block in blocks:
        block.text = " ".join(html.unescape("".join(block.pieces)).split())
    return [b for b in blocks if b.text]


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks on tag paths whose fused ratio passes the threshold."""
    paths: dict[tuple[int, float, bool], list[float]] = {}
    for b in blocks:
        row = paths.setdefault(_path(b), [0, 0, 0, b.node.weight, 0, 0])
        row[0] += len(b.text)
        row[1] += len(_PUNCTUATION.findall(b.text))
        row[2] += 1
        row[4] += 0 if b.node.in_article else b.linked
        row[5] += b.letters
    table = np.array(list(paths.values()), float)
    text, marks = table[:, 0] / table[:, 2], (table[:, 1] + 1) / table[:, 2]
    smooth = [np.convolve(np.pad(x, 1, "edge"), SMOOTHING, "valid") for x in (text, marks)]
    fused = np.sqrt(smooth[0] * smooth[1]) * table[:, 3] * (1 - table[:, 4] / np.maximum(table[:, 5], 1))
    passing = {path for path, x in zip(paths, fused, strict=True) if x >= THRESHOLD * fused.max()}
    return [b for b in blocks if _path(b) in passing]


def _path(block: Block) -> tuple[int, float, bool]:
    return block.node.path, block.node.weight, block.node.in_article


def _common(nodes: list[Node], top: Node | None = None) -> Node:
    """The deepest node that covers all ``nodes``, which lie below ``top``, and is no
    paragraph or the like."""
    seen = set()
    at: Node | None = nodes[0]
    while at is not None:  # the first node's way up
        seen.add(id(at))
        at = None if at is top else at.parent
    way, least = set(seen), nodes[0]
    for node in nodes[1:]:
        at = node
        while id(at) not in seen:
            seen.add(id(at))
            at = at.parent
        if id(at) in way and at.depth < least.depth:
            least = at
    while least.name in PARAGRAPHS:
        least = least.parent
    return least


def containers(chosen: list[Block]) -> list[Node]:
    """The node that covers all chosen blocks; where that is the whole page, the node of
    each of its parts that covers the part's chosen blocks, if there is one."""
    keep = _common([b.node for b in chosen])
    if keep.name not in WHOLE:
        return [keep]
    parts: dict[int, list[Node]] = {}
    part_of: dict[int, int] = {}
    for b in chosen:
        at, seen = b.node, []
        while id(at) not in part_of and at is not keep and at.parent is not keep:
            seen.append(id(at))
            at = at.parent
        part = part_of.setdefault(id(at), id(at))
        part_of.update(dict.fromkeys(seen, part))
        parts.setdefault(part, []).append(b.node)
    return [node for nodes in parts.values() if (node := _common(nodes, keep)).name not in WHOLE]


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by blanks; empty if there is none."""
    blocks = text_blocks(page or "")
    if not blocks:
        return ""
    chosen = content_blocks(blocks)
    passing = set(map(id, chosen))
    inside: dict[int, bool] = {id(node): True for node in containers(chosen)}

    def below(node: Node) -> bool:
        seen = []
        at: Node | None = node
        while at is not None and id(at) not in inside:
            seen.append(id(at))
            at = at.parent
        found = at is not None and inside[id(at)]
        inside.update(dict.fromkeys(seen, found))
        return found

    return " ".join(b.text for b in blocks if id(b) in passing or (not b.node.marked and below(b.node)))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every row; a null or empty page has an empty text.
    Repeated rows give repeated results; other columns are ignored."""
    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, url, "text", "n_chars"])

    return pages.select(pages[key], pages[url], pages[page]).mapInArrow(run, f"{', '.join(kinds)}, text string, n_chars long")


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read_table(spark, sf_dir, "pages"))
