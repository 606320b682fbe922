"""A lenient HTML tree over the standard library's parser, with the selectors that cleaning rules need."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open element of the same group when they begin.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
RAW = frozenset(("script", "style"))
#: The sign of a character reference that no ";" ends, outside scripts, styles and comments.
INCOMPLETE = re.compile(r"(<(script|style)\b.*?(?:</\2|\Z)|<!--.*?(?:-->|\Z))|&(?=#?\w)(?!#?\w+;)", re.I | re.S)


class Node:
    """An element; ``children`` holds elements and strings."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def ancestors(self) -> Iterator[Node]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent

    def walk(self) -> Iterator[Node]:
        """Elements below this one, in document order; safe against very deep trees."""
        open_ = [iter(self.children)]
        while open_:
            child = next(open_[-1], None)
            if child is None:
                open_.pop()
            elif isinstance(child, Node):
                yield child
                open_.append(iter(child.children))

    def strings(self) -> Iterator[str]:
        open_ = [iter(self.children)]
        while open_:
            child = next(open_[-1], None)
            if child is None:
                open_.pop()
            elif isinstance(child, Node):
                open_.append(iter(child.children))
            else:
                yield child

    def text(self, separator: str = "") -> str:
        """The strings below, stripped, blank ones left out."""
        return separator.join(s for s in map(str.strip, self.strings()) if s)

    def raw_text(self) -> str:
        return "".join(self.strings())

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def html(self) -> str:
        out: list[str] = []
        open_: list = [self]
        while open_:
            at = open_.pop()
            if isinstance(at, tuple):
                out.append(at[0])
            elif isinstance(at, str):
                out.append(escape(at, quote=False))
            elif at.tag == "#document":
                open_.extend(reversed(at.children))
            else:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in at.attrs.items())
                out.append(f"<{at.tag}{attrs}>")
                if at.tag in VOID:
                    continue
                open_.append((f"</{at.tag}>",))
                open_.extend((c,) if at.tag in RAW and isinstance(c, str) else c for c in reversed(at.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = self.now = Node("#document")

    def _close(self, tags: set[str] | frozenset[str], until: set[str]) -> None:
        at = self.now
        while at.parent is not None and at.tag not in until:
            if at.tag in tags:
                self.now = at.parent
            at = at.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"table", "td", "th", "li", "dd", "object", "button", "blockquote", "div", "section", "article"})
        known: dict[str, str] = {}
        for k, v in attrs:
            known.setdefault(k, v if v is not None else "")
        node = Node(tag, known, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        at = self.now
        while at.parent is not None:
            if at.tag == tag:
                self.now = at.parent
                return
            at = at.parent

    def handle_data(self, data: str) -> None:
        self.now.children.append(data)


def parse(html: str, complete_references: bool = False) -> Node:
    """The tree of a page or fragment; comments, declarations and instructions are left out.

    Character references that no ";" ends are resolved as browsers do, unless only complete ones are wanted.
    """
    builder = _Builder()
    builder.feed(INCOMPLETE.sub(lambda m: m[1] or "&amp;", html) if complete_references else html)
    builder.close()
    return builder.top


# --- selectors ------------------------------------------------------------------------------------

PART = re.compile(r"""(?P<tag>^[\w*-]+)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*|]?=)\s*["']?(?P<value>[^\]"']*)["']?\s*)?\]""")
TESTS = {
    "=": lambda has, v: has == v,
    "~=": lambda has, v: v in has.split(),
    "^=": lambda has, v: bool(v) and has.startswith(v),
    "$=": lambda has, v: bool(v) and has.endswith(v),
    "*=": lambda has, v: bool(v) and v in has,
    "|=": lambda has, v: has == v or has.startswith(v + "-"),
}


def _simple(text: str):
    """A test of one element."""
    tests, at = [], 0
    while at < len(text):
        m = PART.match(text, at) if at else PART.match(text)
        if not m or m.end() == at:
            raise ValueError(f"selector not understood: {text}")
        at = m.end()
        if m["tag"] and m["tag"] != "*":
            tests.append(lambda n, t=m["tag"].lower(): n.tag == t)
        elif m["cls"]:
            tests.append(lambda n, c=m["cls"]: c in n.classes)
        elif m["id"]:
            tests.append(lambda n, i=m["id"]: n.attrs.get("id") == i)
        elif m["attr"] and m["op"]:
            tests.append(lambda n, a=m["attr"].lower(), f=TESTS[m["op"]], v=m["value"]: a in n.attrs and f(n.attrs[a], v))
        elif m["attr"]:
            tests.append(lambda n, a=m["attr"].lower(): a in n.attrs)
    return lambda node: all(t(node) for t in tests)


@lru_cache(maxsize=256)
def selector(text: str):
    """A test of an element: comma lists, descendants (blank) and children (>) of simple selectors."""
    chains = []
    for chain in text.split(","):
        steps = re.findall(r">|(?:[^\s>\[]|\[[^\]]*\])+", chain)
        if not steps:
            raise ValueError(f"selector not understood: {text}")
        chains.append([s if s == ">" else _simple(s) for s in steps])

    def matches(chain: list, node: Node) -> bool:
        if not chain[-1](node):
            return False
        rest = chain[:-1]
        if not rest:
            return True
        if rest[-1] == ">":
            return node.parent is not None and matches(rest[:-1], node.parent)
        return any(matches(rest, a) for a in node.ancestors())

    return lambda node: any(matches(c, node) for c in chains)


def select(top: Node, text: str) -> list[Node]:
    test = selector(text)
    return [n for n in top.walk() if test(n)]


def outermost(nodes: list[Node]) -> list[Node]:
    """Those that lie in none of the others."""
    chosen = set(map(id, nodes))
    return [n for n in nodes if not any(id(a) in chosen for a in n.ancestors())]


def pruned(top: Node, drop) -> None:
    """Takes out every element that ``drop`` names, with all below it."""
    open_ = [top]
    while open_:
        at = open_.pop()
        at.children = [c for c in at.children if isinstance(c, str) or not drop(c)]
        open_.extend(c for c in at.children if isinstance(c, Node))
