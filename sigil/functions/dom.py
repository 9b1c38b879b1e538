"""A small tolerant HTML tree on the standard library's parser."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

#: Elements without content (fixed by HTML).
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def get(self, name: str) -> str:
        return self.attrs.get(name.lower()) or ""

    @property
    def classes(self) -> str:
        return " ".join(self.get("class").split()).lower()

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order; iterative, so depth is no limit."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *tags: str, where: Callable[[Node], bool] | None = None) -> Iterator[Node]:
        return (n for n in self.walk() if n.tag in tags and (where is None or where(n)))

    def first(self, *tags: str, where: Callable[[Node], bool] | None = None) -> Node | None:
        return next(self.all(*tags, where=where), None)

    def inside(self, test: Callable[[Node], bool]) -> bool:
        node = self.parent
        while node is not None:
            if test(node):
                return True
            node = node.parent
        return False

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def inner(self) -> str:
        return "".join(escape(c, quote=False) if isinstance(c, str) else c.markup() for c in self.children)

    def markup(self) -> str:
        named = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{named}/>" if self.tag in VOID else f"<{self.tag}{named}>{self.inner()}</{self.tag}>"


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        known: dict[str, str] = {}
        for k, v in attrs:
            known.setdefault(k, v or "")
        node = Node(tag, known, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; NUL counts as a space. Unclosed elements close with their parents."""
    builder = _Builder()
    builder.feed((html or "").replace("\0", " "))
    builder.close()
    return builder.root
