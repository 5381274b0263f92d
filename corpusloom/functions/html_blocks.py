"""HTML to structural blocks (pure Python on the standard library; shipped to workers as it is).

Three extractors share one tree: generic_blocks() for any page, wiki_blocks_streamed() which gives text to the innermost
open block and emits blocks as they close, and wiki_blocks_tree() which walks the tree in document order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from typing import Any
from urllib.parse import urljoin, urlsplit

from .chunking import OVERLAP_TOKENS, TARGET_TOKENS, chunk_blocks

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_P_ENDERS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = {f"h{n}": n for n in range(1, 7)}
SKIPPED_TAGS = frozenset("aside nav footer header figure noscript sup table style script".split())
#: Class names of page furniture, as the data of the rule has them.
SKIPPED_CLASSES = frozenset(
    """ambox authority-control autocollapse catlinks cmbox collapsible-list dablink fmbox hatnote imbox infobox infobox-above infobox-caption
    infobox-data infobox-full-data infobox-header infobox-image infobox-label infobox-signature infobox-subheader infobox-title mbox-image mbox-small
    mbox-text messagebox metadata multiple-issues mw-collapsible mw-collapsible-content mw-editsection mw-editsection-bracket mw-footer
    mw-footer-container mw-hidden-catlinks mw-normal-catlinks mw-portlet-sticky-header-toc mw-references-columns mw-references-wrap navbox
    navbox-abovebelow navbox-columns-table navbox-even navbox-group navbox-image navbox-inner navbox-list navbox-list-with-group navbox-odd
    navbox-styles navbox-subgroup navbox-title nowraplinks ombox pie-thumb printfooter refbegin reference reference-text references
    references-column-width reflist shortdescription sidebar sidebar-content sidebar-navbar sidebar-title thumb thumbcaption thumbimage thumbinner toc
    toccolours vector-page-titlebar-toc vector-sticky-header-toc vertical-navbox""".split()
)
SKIPPED_PREFIXES = ("toclimit-", "vector-toc")
_SPACES = re.compile(r"\s+")
_AMPERSAND = re.compile(r"&(?:#[0-9]+;|#[xX][0-9a-fA-F]+;|[a-zA-Z][a-zA-Z0-9]*;)?")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        """This element and all below, in document order."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def text(self, skip=None) -> str:
        out: list[str] = []
        stack: list[Any] = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            elif skip is None or not skip(c):
                stack += reversed(c.children)
        return "".join(out)

    def ancestors(self) -> Iterator[Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent


class _Tree(HTMLParser):
    """A tree with void elements closed, and the end tags of p and li that HTML lets authors leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#document", {}, None)

    def _close(self, tags: frozenset[str] | set[str], stop: set[str]) -> None:
        n = self.at
        while n.parent is not None and n.tag not in stop:
            if n.tag in tags:
                self.at = n.parent
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag in _P_ENDERS:
            self._close({"p"}, {"button", "td", "th", "table", "li", "body"})
        if tag == "li":
            self._close({"li"}, {"ul", "ol", "menu", "table"})
        if tag in HEADINGS and self.at.tag in HEADINGS:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            if n.tag in ("table", "td", "th") and tag in ("p", "li", "b", "i", "a", "span"):
                return
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        kids = self.at.children
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)


def parse(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def collapse(text: str) -> str:
    return " ".join(text.split())


def collapse_lines(text: str) -> str:
    """Lines trimmed at the right, blank ones left out."""
    return "\n".join(x for x in (line.rstrip() for line in text.split("\n")) if x.strip())


def estimate_tokens(text: str) -> int:
    return max(1, len(text.split()))


class _Path:
    def __init__(self):
        self.entries: list[tuple[int, str]] = []

    def push(self, level: int, title: str) -> None:
        while self.entries and self.entries[-1][0] >= level:
            self.entries.pop()
        self.entries.append((level, title))

    def titles(self) -> list[str]:
        return [t for _, t in self.entries]

    def sections(self) -> list[dict[str, Any]]:
        return [{"level": a, "title": t} for a, t in self.entries]


def _first(root: Node, test) -> Node | None:
    return next((n for n in root.walk() if test(n)), None)


def generic_blocks(html: str, strict_boilerplate: bool = False) -> list[dict[str, Any]]:
    """Blocks of the first article, main or body (else of all): headings, paragraphs, list items, quotes, code.

    Elements below one with a navigation-box class are left out. A block within a block gives both. With
    strict_boilerplate, elements within scripts, styles, navigation, headers and footers are left out too.
    """
    doc = parse(html)
    root = next((r for r in (_first(doc, lambda n, t=t: n.tag == t) for t in ("article", "main", "body")) if r), doc)
    path, out = _Path(), []
    kinds = {"p": "Paragraph", "li": "ListItem", "blockquote": "Quote", "pre": "Preformatted", "code": "Preformatted"}
    for n in root.walk():
        kind = "Heading" if n.tag in HEADINGS else kinds.get(n.tag)
        if kind is None:
            continue
        if any("navbox" in c.lower() for a in n.ancestors() for c in a.classes()):
            continue
        if strict_boilerplate and any(a.tag in SKIPPED_TAGS for a in n.ancestors()):
            continue
        text = collapse_lines(n.text()) if kind == "Preformatted" else collapse(n.text())
        if not text.strip():
            continue
        level = HEADINGS.get(n.tag)
        if level:
            path.push(level, text)
        out.append({"kind": kind, "heading_level": level, "text": text, "section_path": path.sections()})
    return out


def skipped(n: Node) -> bool:
    if n.tag in ("html", "body", "#document"):
        return False
    return n.tag in SKIPPED_TAGS or any(c in SKIPPED_CLASSES or c.startswith(SKIPPED_PREFIXES) for c in n.classes())


def _wiki_root(doc: Node) -> Node | None:
    """The content element: the parser output in the content, else the content, else the body's; by a fixed order of places."""

    def output_in(ident: str | None):
        def test(n: Node) -> bool:
            return "mw-parser-output" in n.classes() and (ident is None or any(a.attrs.get("id") == ident for a in n.ancestors()))

        return test

    def has_id(ident: str):
        return lambda n: n.attrs.get("id") == ident

    tests = [output_in("mw-content-text"), has_id("mw-content-text"), output_in("bodyContent"), has_id("bodyContent"), output_in(None), lambda n: n.tag == "body"]
    return next((r for r in (_first(doc, t) for t in tests) if r is not None), None)


_WIKI_KINDS = {"p": "paragraph", "li": "list_item", "pre": "code"}


def _wiki_text(kind: str, raw: str) -> str:
    return raw.strip() if kind == "code" else collapse(raw)


def _number(blocks: list[tuple[str, int | None, str]]) -> list[dict[str, Any]]:
    path, out = _Path(), []
    for kind, level, text in blocks:
        if level:
            path.push(level, text)
        out.append({"type": kind, "text": text, "section_path": path.titles(), "index": len(out)})
    return out


def wiki_blocks_tree(html: str) -> list[dict[str, Any]]:
    """Paragraphs, headings, list items and code of the content in document order; nested blocks give their text twice.

    Furniture (by tag and class) is left out with all below it. Without any block, the content's whole text is one.
    """
    doc = parse(html)
    root = _wiki_root(doc) or doc  # a page without a body tag is all body
    found = []
    for n in root.walk():
        kind = "heading" if n.tag in HEADINGS else _WIKI_KINDS.get(n.tag)
        if kind is None or skipped(n) or any(skipped(a) for a in n.ancestors()):
            continue
        text = _wiki_text(kind, n.text(skipped))
        if text:
            found.append((kind, HEADINGS.get(n.tag), text))
    if not found:
        text = collapse(root.text(skipped))
        found = [("paragraph", None, text)] if text else []
    return _number(found)


def wiki_blocks_streamed(html: str) -> list[dict[str, Any]]:
    """Like wiki_blocks_tree(), but text belongs to the innermost open block alone, and blocks come as they close."""
    doc = parse(html)
    root = _wiki_root(doc)
    if root is None:
        return []
    found: list[tuple[str, int | None, str]] = []
    open_blocks: list[tuple[str, int | None, list[str]]] = []
    stack: list[tuple[str, Any]] = [("in", c) for c in reversed(root.children)]
    while stack:
        step, c = stack.pop()
        if step == "out":
            kind, level, parts = open_blocks.pop()
            text = _wiki_text(kind, "".join(parts))
            if text:
                found.append((kind, level, text))
        elif isinstance(c, str):
            if open_blocks:
                open_blocks[-1][2].append(c)
        elif not skipped(c):
            kind = "heading" if c.tag in HEADINGS else _WIKI_KINDS.get(c.tag)
            if kind:
                open_blocks.append((kind, HEADINGS.get(c.tag), []))
                stack.append(("out", None))
            stack += [("in", x) for x in reversed(c.children)]
    if not found:
        text = collapse(root.text(skipped))
        found = [("paragraph", None, text)] if text else []
    return _number(found)


def wiki_text(html: str) -> str:
    return "\n".join(b["text"] for b in wiki_blocks_tree(html))


def _from_wiki(html: str) -> list[dict[str, Any]]:
    kinds = {"paragraph": "Paragraph", "heading": "Heading", "list_item": "ListItem", "code": "Preformatted"}
    out = []
    for b in wiki_blocks_streamed(html):
        titles = b["section_path"]
        level = min(6, max(1, len(titles))) if b["type"] == "heading" else None
        out.append({"kind": kinds[b["type"]], "heading_level": level, "text": b["text"], "section_path": [{"level": min(6, k + 1), "title": t} for k, t in enumerate(titles)]})
    return out


def is_wiki_host(url: str | None) -> bool:
    return "wikipedia.org" in (urlsplit(url or "").hostname or "")


def close_references(html: str) -> str:
    """html in which each ampersand that starts no character reference with a semicolon is written as one, so that it stays an ampersand."""
    return _AMPERSAND.sub(lambda m: m[0] if m[0][1:2] == "#" or m[0][1:] in html5 else "&amp;" + m[0][1:], html)


def decode(body: bytes) -> tuple[str, bool]:
    """(text, whether bytes were replaced)."""
    try:
        return body.decode("utf-8"), False
    except UnicodeDecodeError:
        return body.decode("utf-8", "replace"), True


def normalize(url: str | None, body: bytes | None, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS, max_blocks: int | None = None, strict_boilerplate: bool = False, closed_references: bool = False) -> dict[str, Any]:
    """Blocks, chunks, text and checksum of a page; error tells why there are none. Offsets are UTF-8 bytes of body_text.

    closed_references: "&amp" without a semicolon stays as it is.
    """
    if not body:
        return {"body_text": None, "blocks": [], "chunks": [], "checksum": None, "content_length": len(body or b""), "lossy_decoding": False, "error": "empty body"}
    html, lossy = decode(body)
    if closed_references:
        html = close_references(html)
    blocks = (_from_wiki(html) if is_wiki_host(url) else generic_blocks(html, strict_boilerplate))[:max_blocks]
    at = 0
    for i, b in enumerate(blocks):
        size = len(b["text"].encode())
        b |= {"block_index": i, "char_start": at, "char_end": at + size, "token_estimate": estimate_tokens(b["text"])}
        at += size + 2
    return {
        "body_text": "\n\n".join(b["text"] for b in blocks),
        "blocks": blocks,
        "chunks": chunk_blocks(blocks, target, overlap),
        "checksum": zlib.crc32(body),
        "content_length": len(body),
        "lossy_decoding": lossy,
        "error": None,
    }


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href")
            if href is not None:
                self.hrefs.append(href)


def links(url: str | None, html: str | None) -> list[str]:
    """Targets of all a[href] in document order, resolved against the page's URL; what does not resolve to a host is left out."""
    p = _Links()
    p.feed(html or "")
    out = []
    for h in p.hrefs:
        try:
            target = urljoin(url or "", h.strip())
            if urlsplit(target).scheme and urlsplit(target).netloc:
                out.append(target)
        except ValueError:
            continue
    return out
