"""HTML on the standard library's tokenizer: a small tree with implied end tags, selectors, text, and XHTML for native XPath."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from xml.sax.saxutils import escape, quoteattr

#: Elements without content, and which open elements an opening tag closes: fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_BOUND = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
_XML_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*\Z")
_NOT_XML = re.compile("[^\\t\\n\\r\\x20-\\ud7ff\\ue000-\\ufffd\\U00010000-\\U0010ffff]")


@dataclass
class Node:
    """An element; ``children`` are elements and strings."""

    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    parent: Node | None = None

    def walk(self) -> Iterator[Node]:
        """All elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        """All text below, script and style included, entities resolved."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return "".join(out)

    def html(self) -> str:
        """This element as well-formed XHTML."""
        out: list[str] = []
        stack: list[Node | str | tuple[str]] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                out.append(node[0])
            elif isinstance(node, str):
                out.append(escape(_NOT_XML.sub("", node)))
            else:
                attrs = "".join(f" {k}={quoteattr(_NOT_XML.sub('', v))}" for k, v in node.attrs.items() if _XML_NAME.match(k))
                if node.children:
                    out.append(f"<{node.tag}{attrs}>")
                    stack.append((f"</{node.tag}>",))
                    stack.extend(reversed(node.children))
                else:
                    out.append(f"<{node.tag}{attrs}/>")
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.at = self.root

    def _close(self, tags: set[str], bounds: set[str]) -> None:
        """Closes the innermost of ``tags`` that is open within ``bounds``, and any other of them around it."""
        while True:
            node: Node | None = self.at
            while node is not None and node.tag not in tags and node.tag not in bounds:
                node = node.parent
            if node is None or node.tag not in tags or node.parent is None:
                return
            self.at = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {k: v or "" for k, v in reversed(attrs)}
        if tag == "html":
            self.root.attrs |= values
            return
        if not _XML_NAME.match(tag):
            tag = "span"
        if tag in CLOSES:
            self._close(CLOSES[tag], _BOUND.get(tag, {"table"}))
        elif tag in BLOCK:
            self._close({"p"}, {"td", "th", "li", "div", "table", "dd"})
        node = Node(tag, values, parent=self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in VOID and self.at.parent is not None:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.tag != tag:
            if tag not in ("table", "html", "body") and node.tag == "table":
                return
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(text: str | None) -> Node:
    """The tree of a page; NULL and empty pages give an empty root. Never fails on malformed mark-up."""
    builder = _Builder()
    if text:
        builder.feed(text)
        builder.close()
    return builder.root


_PART = re.compile(r"""([a-zA-Z][\w-]*|\*)|\#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*|]?)=\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]|:nth-child\((\d+)\)|:first-child""")


@lru_cache(maxsize=256)
def _compile(selector: str) -> list[list[list[tuple]]]:
    """Groups of chains of compound selectors; only descendant and child combinators, the latter marked ``('>',)``."""
    groups = []
    for group in selector.split(","):
        chain: list[list[tuple]] = []
        for word in group.replace(">", " > ").split():
            if word == ">":
                chain.append([(">",)])
                continue
            tests, end = [], 0
            while end < len(word):
                m = _PART.match(word, end)
                if not m:
                    raise ValueError(f"selector not supported: {selector}")
                tests.append(m.groups() if not m.group().startswith(":first") else (None,) * 8 + ("1",))
                end = m.end()
            chain.append(tests)
        if not chain:
            raise ValueError(f"empty selector: {selector!r}")
        groups.append(chain)
    return groups


def _passes(node: Node, tests: list[tuple]) -> bool:
    for tag, ident, cls, name, op, q1, q2, bare, nth in tests:
        if tag and tag != "*" and node.tag != tag.lower():
            return False
        if ident and node.attrs.get("id") != ident:
            return False
        if cls and cls not in node.attrs.get("class", "").split():
            return False
        if name:
            have = node.attrs.get(name.lower())
            want = next((q for q in (q1, q2, bare) if q is not None), None)
            if have is None or want is not None and not {"": have == want, "^": have.startswith(want), "$": have.endswith(want), "*": want in have, "~": want in have.split(), "|": have == want or have.startswith(want + "-")}[op or ""]:
                return False
        if nth:
            peers = [c for c in node.parent.children if isinstance(c, Node)] if node.parent else [node]
            if not any(c is node and i == int(nth) for i, c in enumerate(peers, 1)):
                return False
    return True


def _matches(node: Node, chain: list[list[tuple]]) -> bool:
    if not _passes(node, chain[-1]):
        return False
    i, at = len(chain) - 2, node.parent
    while i >= 0:
        direct = chain[i] == [(">",)]
        i -= direct
        while at is not None and not _passes(at, chain[i]):
            if direct:
                return False
            at = at.parent
        if at is None:
            return False
        at, i = at.parent, i - 1
    return True


def select(root: Node, selector: str) -> list[Node]:
    """Elements below ``root`` that match a selector, in document order, each once."""
    groups = _compile(selector)
    return [n for n in root.walk() if any(_matches(n, chain) for chain in groups)]
