"""A tolerant HTML tree with a small selector language, on the standard library's tokenizer.

Void tags have no content. A closing tag closes the nearest open tag of its name with all that is open within it;
without one it is ignored. Nothing is closed implicitly (<p> neither).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


@dataclass(eq=False)
class Node:
    name: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # of Node and str
    parent: Node | None = None

    def walk(self) -> Iterator[Node]:
        """All nodes below, in document order."""
        return (x for x in self.below() if isinstance(x, Node))

    def texts(self) -> Iterator[str]:
        return (x for x in self.below() if isinstance(x, str))

    def below(self) -> Iterator[Node | str]:
        """Nodes and pieces of text below, in document order. A stack of open lists: tags may nest to any depth."""
        stack = [iter(self.children)]
        while stack:
            x = next(stack[-1], None)
            if x is None:
                stack.pop()
                continue
            yield x
            if isinstance(x, Node):
                stack.append(iter(x.children))

    def text(self, between: str = "") -> str:
        """Stripped pieces of text, without the empty ones, joined."""
        return between.join(t for t in (x.strip() for x in self.texts()) if t)

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def all(self, name: str, with_attr: str | None = None) -> list[Node]:
        return [n for n in self.walk() if n.name == name and (with_attr is None or n.attrs.get(with_attr) is not None)]

    def first(self, name: str) -> Node | None:
        return next((n for n in self.walk() if n.name == name), None)

    def by_id(self, value: str) -> Node | None:
        return next((n for n in self.walk() if n.attrs.get("id") == value), None)

    def select(self, selector: str) -> list[Node]:
        steps = _steps(selector)
        return [n for n in self.walk() if _fits(n, steps, self)]

    def select_first(self, selectors: list[str]) -> Node | None:
        """First node of the first selector that has one."""
        for s in selectors:
            if found := self.select(s):
                return found[0]
        return None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, [], self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v if v is not None else "" for k, v in attrs}, [], self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


_COMPOUND = re.compile(r"([A-Za-z][\w-]*)?((?:[#.][\w-]+)*)(:first-of-type)?$")


def _steps(selector: str) -> list[tuple[str, str | None, str | None, list[str], bool]]:
    """(relation to the step before, tag, id, classes, first of its type) for each compound."""
    out, relation = [], " "
    for token in selector.split():
        if token == ">":
            relation = ">"
            continue
        m = _COMPOUND.match(token)
        marks = re.findall(r"[#.][\w-]+", m.group(2) or "")
        out.append((relation, m.group(1), next((x[1:] for x in marks if x[0] == "#"), None), [x[1:] for x in marks if x[0] == "."], bool(m.group(3))))
        relation = " "
    return out


def _fits(node: Node, steps: list, top: Node) -> bool:
    relation, tag, id_, classes, first = steps[-1]
    if tag and node.name != tag or id_ and node.attrs.get("id") != id_ or not set(classes) <= set(node.classes):
        return False
    if first and node.parent is not None and next(c for c in node.parent.children if isinstance(c, Node) and c.name == node.name) is not node:
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    if relation == ">":
        return up is not None and up is not top and _fits(up, steps[:-1], top)
    while up is not None and up is not top:
        if _fits(up, steps[:-1], top):
            return True
        up = up.parent
    return False
