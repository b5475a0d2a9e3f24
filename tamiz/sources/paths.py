"""Paths of elements over a parsed page: child and descendant steps with predicates, as declarations use them.

Supported: ``/`` and ``//`` steps by tag or ``*``; predicates with ``and``, ``or``, ``not(...)``, brackets, positions and
``last()``; ``contains``, ``starts-with``, ``normalize-space``, ``translate``, ``string``; ``text()``, ``.``, attributes, child
elements and literals; ``=`` and ``!=``. Native XPath takes all other paths, but gives no text and attributes of the same
element together.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from tamiz.sources.html import Node

_TOKEN = re.compile(r"""\s*(//|!=|[/\[\]()@=,.*]|'[^']*'|"[^"]*"|\d+|[A-Za-z_][\w\-]*)""")

#: A predicate's parts: a value as text (or None where there is no such thing), and a test of a node with position and size.
Value = Callable[[Node], str | None]
Test = Callable[[Node, int, int], bool]


class _Reader:
    def __init__(self, path: str):
        self.path, self.tokens, end = path, [], 0
        while path[end:].strip():
            m = _TOKEN.match(path, end)
            if not m:
                raise self.refuse()
            self.tokens.append(m[1])
            end = m.end()
        self.at = 0

    def refuse(self) -> ValueError:
        return ValueError(f"path of elements not supported: {self.path}")

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ""

    def take(self, *wanted: str) -> str:
        token = self.peek()
        if not token or wanted and token not in wanted:
            raise self.refuse()
        self.at += 1
        return token

    def steps(self) -> list[tuple[bool, str, list[Test]]]:
        found = []
        while self.peek():
            deep = self.take("/", "//") == "//"
            tag, tests = self.take(), []
            if not re.match(r"[A-Za-z_*]", tag):
                raise self.refuse()
            while self.peek() == "[":
                self.take()
                tests.append(self.either())
                self.take("]")
            found.append((deep, tag.lower(), tests))
        if not found:
            raise self.refuse()
        return found

    def either(self) -> Test:
        tests = [self.both()]
        while self.peek() == "or":
            self.take()
            tests.append(self.both())
        return lambda n, i, size: any(t(n, i, size) for t in tests)

    def both(self) -> Test:
        tests = [self.one()]
        while self.peek() == "and":
            self.take()
            tests.append(self.one())
        return lambda n, i, size: all(t(n, i, size) for t in tests)

    def one(self) -> Test:
        token = self.peek()
        if token == "(":
            self.take()
            inner = self.either()
            self.take(")")
            return inner
        if token == "not" and self.peek(1) == "(":
            self.at += 2
            inner = self.either()
            self.take(")")
            return lambda n, i, size: not inner(n, i, size)
        if token.isdigit():
            place = int(self.take())
            return lambda n, i, size: i == place
        if token == "last":
            for t in ("last", "(", ")"):
                self.take(t)
            return lambda n, i, size: i == size
        if token in ("contains", "starts-with"):
            self.at += 1
            self.take("(")
            whole = self.value()
            self.take(",")
            part = self.value()
            self.take(")")
            if token == "contains":
                return lambda n, i, size: (part(n) or "") in (whole(n) or "")
            return lambda n, i, size: (whole(n) or "").startswith(part(n) or "")
        left = self.value()
        if self.peek() in ("=", "!="):
            same = self.take() == "="
            right = self.value()
            return lambda n, i, size: (a := left(n)) is not None and (b := right(n)) is not None and (a == b) == same
        return lambda n, i, size: bool(left(n)) if token in ("text", ".", "string", "normalize-space", "translate") else left(n) is not None

    def value(self) -> Value:
        token = self.take()
        if token[0] in "'\"":
            return lambda n: token[1:-1]
        if token == ".":
            return Node.text
        if token == "@":
            name = self.take().lower()
            return lambda n: n.attrs.get(name)
        if token == "text" and self.peek() == "(":
            self.take("(")
            self.take(")")
            return lambda n: next((c for c in n.children if isinstance(c, str)), None)
        if token in ("string", "normalize-space", "translate") and self.peek() == "(":
            self.take("(")
            inner: Value = Node.text if self.peek() == ")" else self.value()
            if token == "translate":
                self.take(",")
                source = self.value()
                self.take(",")
                target = self.value()
                self.take(")")
                return lambda n: _translated(inner(n) or "", source(n) or "", target(n) or "")
            self.take(")")
            return (lambda n: " ".join((inner(n) or "").split())) if token == "normalize-space" else (lambda n: inner(n) or "")
        if re.match(r"[A-Za-z_]", token) and self.peek() != "(":
            return lambda n: next((c.text() for c in n.children if isinstance(c, Node) and c.tag == token.lower()), None)
        raise self.refuse()


def _translated(text: str, source: str, target: str) -> str:
    table = {ord(c): (target[i] if i < len(target) else None) for i, c in reversed(list(enumerate(source)))}
    return text.translate(table)


@lru_cache(maxsize=256)
def compiled(path: str) -> tuple[tuple[bool, str, list[Test]], ...]:
    """Steps of a path; ValueError where it is not supported."""
    return tuple(_Reader(path).steps())


def elements(root: Node, path: str) -> list[Node]:
    """Elements that a path selects below ``root``, in document order, each once."""
    place = {id(n): k for k, n in enumerate(root.walk())}
    top = Node("", children=[root])  # so that a path may begin with the root element
    at = [top]
    for deep, tag, tests in compiled(path):
        found: dict[int, Node] = {}
        for context in at:
            for parent in [context, *context.walk()] if deep else [context]:
                peers = [c for c in parent.children if isinstance(c, Node) and tag in ("*", c.tag)]
                for test in tests:
                    peers = [c for i, c in enumerate(peers, 1) if test(c, i, len(peers))]
                found.update((id(c), c) for c in peers)
        at = sorted(found.values(), key=lambda n: place.get(id(n), -1))
    return at
