"""A tolerant HTML tree, a small selector language over it, and the element relation.

The tree follows HTML5 where the extractors need it: void and raw-text elements,
folded case, decoded references, implied ``tbody`` and ``tr``, and elements that a
start tag closes (``p``, ``li``, ``td`` and their like).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Start tag: (open elements that it closes, elements that bound the search).
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}


class Node:
    """An element; ``children`` holds nodes and strings in order."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def descendants(self) -> Iterator[Node]:
        """Elements below, in document order."""
        todo = [iter(self.children)]
        while todo:
            for c in todo[-1]:
                if c.__class__ is Node:
                    yield c
                    if c.children:
                        todo.append(iter(c.children))
                        break
            else:
                todo.pop()

    def texts(self) -> list[str]:
        """Text nodes below, in document order."""
        own = self.children
        if not own or len(own) == 1 and own[0].__class__ is str:
            return [*own]
        out, todo = [], [*reversed(self.children)]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += reversed(x.children)
        return out

    def text(self, joiner: str = "") -> str:
        return joiner.join(self.texts())

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def following(self) -> list[Node | str]:
        """Siblings after this node."""
        if self.parent is None:
            return []
        own = self.parent.children
        return own[next(i for i, x in enumerate(own) if x is self) + 1 :]

    def select(self, selector: str) -> Iterator[Node]:
        """Descendants that match, in document order; ancestors named in the selector may stand outside."""
        steps = _parsed(selector)
        if (tags := _tags_alone(selector)) is not None:
            return (n for n in self.descendants() if n.tag in tags)
        return (n for n in self.descendants() if any(_matches(n, s, len(s) - 1) for s in steps))

    def first(self, selector: str) -> Node | None:
        return next(self.select(selector), None)


#: A tag of letters, digits and plain attributes, and the text after it.
_PLAIN_TAG = re.compile(r"""<(?:(/)(?=[a-zA-Z0-9]+>))?([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9-]*(?:=(?:"[^"&]*"|'[^'&]*'|[a-zA-Z0-9_.:;,#?%+-]+))?)*)>([^<]*)""")
_PLAIN_ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9-]*)(?:=(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f]+)))?""")
#: Elements whose text is read by other rules.
NOT_PLAIN = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


@lru_cache(4096)
def _plain_attributes(told: str) -> tuple[tuple[str, str], ...]:
    return tuple((m[1].lower(), m[2] or m[3] or m[4] or "") for m in reversed([*_PLAIN_ATTRIBUTE.finditer(told)]))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.open = [self.root]

    def _close(self, closed: set[str], bound: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in closed:
                del self.open[i:]
                return
            if self.open[i].tag in bound:
                return

    def _push(self, tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs, self.open[-1])
        self.open[-1].children.append(node)
        self.open.append(node)
        return node

    def read_plain(self, html: str) -> bool:
        """Read a page of plain tags and text alone, as the standard library's parser does in a third of its time; False where there is anything else."""
        at, n = html.find("<"), len(html)
        at = n if at < 0 else at
        if at:
            self.handle_data(unescape(html[:at]))
        tag_at, start, end, say = _PLAIN_TAG.match, self._start, self.handle_endtag, self.handle_data
        while at < n:
            if (m := tag_at(html, at)) is None:
                return False
            shut, name, told, text = m.groups()
            if shut:
                end(name.lower())
            elif (tag := name.lower()) in NOT_PLAIN:
                return False
            else:
                start(tag, dict(_plain_attributes(told)) if told else {})
            if text:
                say(unescape(text) if "&" in text else text)
            at = m.end()
        return True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, {k: v or "" for k, v in reversed(attrs)})

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "div", "li", "body"})
        if tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
            if tag in ("tbody", "thead", "tfoot"):
                while len(self.open) > 1 and self.open[-1].tag in ("tr", "td", "th"):
                    self.open.pop()
        if tag == "tr" and self.open[-1].tag == "table":
            self._push("tbody", {})
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            if self.open[-1].tag == "table":
                self._push("tbody", {})
            self._push("tr", {})
        self._push(tag, attrs)
        if tag in VOID:
            self.open.pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        bound = {"table"} if tag not in ("table", "body", "html") else set()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in bound:
                return

    def handle_data(self, data: str) -> None:
        own = self.open[-1].children
        if own and isinstance(own[-1], str):
            own[-1] += data
        else:
            own.append(data)


def parse(html: str | None, closed: bool = False) -> Node:
    """The tree of a page. References count without their semicolon where HTML5 lets them; ``closed`` decodes those alone that have it."""
    html = html or ""
    if closed:
        html = _REFERENCE.sub(_held, html)
    builder = _Builder()
    if not builder.read_plain(html):
        builder = _Builder()
        builder.feed(html)
        builder.close()
    if closed and _HELD in html:
        for node in (builder.root, *builder.root.descendants()):
            node.tag, node.attrs = _said(node.tag), {_said(k): _said(v) for k, v in node.attrs.items()}
            node.children = [_said(c) if isinstance(c, str) else c for c in node.children]
    return builder.root


#: Stands, with a digit, for an ampersand that begins no closed reference, and for itself.
_HELD = "\ufdd0"
_REFERENCE = re.compile(f"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);|([a-zA-Z][a-zA-Z0-9]*;))?|{_HELD}")
_HELD_FOR = re.compile(f"{_HELD}([01])")


def _held(m: re.Match) -> str:
    if m[0] == _HELD:
        return f"{_HELD}1"
    known = len(m[0]) > 1 and (m[1] is None or m[1] in html5)
    return m[0] if known else f"{_HELD}0{m[0][1:]}"


def _said(text: str) -> str:
    return _HELD_FOR.sub(lambda m: "&" if m[1] == "0" else _HELD, text)


_COMPOUND = re.compile(r"""([>\s,]*)([a-zA-Z0-9*]*)((?:[.#][\w-]+|\[[^\]]+\])*)""")
_PART = re.compile(r"""([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$]?=)\s*["']?([^"'\]]*)["']?)?\s*\]""")


@lru_cache(512)
def _parsed(selector: str) -> list[list[tuple[bool, str, tuple]]]:
    """Alternatives, each a list of (direct child of the one before, tag, tests)."""
    out: list[list[tuple[bool, str, tuple]]] = [[]]
    for m in _COMPOUND.finditer(selector.strip()):
        if not m[2] and not m[3]:
            continue
        if "," in m[1]:
            out.append([])
        tests = tuple(("class" if p[1] == "." else "id" if p[1] == "#" else p[3], "~=" if p[1] == "." else "=" if p[1] else p[4] or "", p[2] or p[5] or "") for p in _PART.finditer(m[3]))
        out[-1].append((">" in m[1], m[2].lower(), tests))
    return out


@lru_cache(512)
def _tags_alone(selector: str) -> frozenset[str] | None:
    """The tags of a selector that tells nothing else."""
    steps = _parsed(selector)
    plain = all(len(s) == 1 and not s[0][2] and s[0][1] not in ("", "*") for s in steps)
    return frozenset(s[0][1] for s in steps) if plain else None


def _passes(node: Node, tag: str, tests: tuple) -> bool:
    if tag not in ("", "*", node.tag):
        return False
    for name, kind, value in tests:
        have = node.attrs.get(name)
        if have is None:
            return False
        if not {"": True, "=": have == value, "~=": value in have.split(), "*=": value in have, "^=": have.startswith(value), "$=": have.endswith(value)}[kind]:
            return False
    return True


def _matches(node: Node, steps: list, k: int) -> bool:
    direct, tag, tests = steps[k]
    if not _passes(node, tag, tests):
        return False
    if k == 0:
        return True
    if direct:
        return node.parent is not None and _matches(node.parent, steps, k - 1)
    return any(_matches(a, steps, k - 1) for a in node.ancestors())


ELEMENTS = "doc_id string, pos int, parent_pos int, sib_idx int, depth int, tag string, attrs map<string,string>, own_text array<string>, all_text array<string>, ancestor_tags array<string>"
_ELEMENT_TYPES = [
    pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.string()),
]
#: Rows of elements that are handed on together.
ROWS = 4096
_ELEMENT_NAMES = [x.split(" ")[0] for x in ELEMENTS.replace("map<string,string>", "map").split(", ")]
ELEMENT_TYPES = dict(zip(_ELEMENT_NAMES, _ELEMENT_TYPES))


def element_columns(doc_id: str | None, html: str | None, columns: Sequence[str] = _ELEMENT_NAMES, closed: bool = False) -> list[list]:
    """A list for each of ``columns``, of its values for each element, positions in document order from 0.

    Only the wanted values are made: ``all_text`` and ``ancestor_tags`` grow with the depth of nesting.
    """
    root = parse(html, closed)
    out: list[list] = [[] for _ in columns]
    todo = [(root, -1, -1, ())]
    value = {
        "doc_id": lambda node, pos, parent, index, above: doc_id,
        "pos": lambda node, pos, parent, index, above: pos,
        "parent_pos": lambda node, pos, parent, index, above: parent,
        "sib_idx": lambda node, pos, parent, index, above: index,
        "depth": lambda node, pos, parent, index, above: len(above),
        "tag": lambda node, pos, parent, index, above: node.tag,
        "attrs": lambda node, pos, parent, index, above: list(node.attrs.items()),
        "own_text": lambda node, pos, parent, index, above: [c for c in node.children if isinstance(c, str)],
        "all_text": lambda node, pos, parent, index, above: node.texts(),
        "ancestor_tags": lambda node, pos, parent, index, above: [a.tag for a in node.ancestors() if a is not root],
    }
    wanted = [(value[c], o) for c, o in zip(columns, out)]
    deep = "depth" in columns
    pos = -1
    while todo:
        node, parent, index, above = todo.pop()
        if node is not root:
            for make, o in wanted:
                o.append(make(node, pos, parent, index, above))
        own = [c for c in node.children if isinstance(c, Node)]
        below = range(len(above) + 1) if deep and node is not root else ()
        todo += [(c, pos, k, below) for k, c in reversed([*enumerate(own)])]
        pos += 1
    return out


def element_rows(doc_id: str | None, html: str | None) -> list[tuple]:
    """One tuple of :data:`ELEMENTS` for each element."""
    return list(zip(*element_columns(doc_id, html)))


def elements(documents: DataFrame, id_col: str = "doc_id", html_col: str = "html", columns: Sequence[str] = _ELEMENT_NAMES, closed: bool = False) -> DataFrame:
    """The element relation of ``documents``, or the named columns of it: a narrow map, one parse for each row; ``closed`` as for :func:`parse`."""
    columns = list(columns)
    types = [_ELEMENT_TYPES[_ELEMENT_NAMES.index(c)] for c in columns]
    ddl = [x for x in ELEMENTS.replace("map<string,string>", "map<string;string>").split(", ") if x.split(" ")[0] in columns]
    ddl = ", ".join(sorted(ddl, key=lambda x: columns.index(x.split(" ")[0]))).replace(";", ",")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names=columns)

        held: list[list] = [[] for _ in columns]
        for b in batches:
            for key, html in zip(b.column(0).to_pylist(), b.column(1)):
                for whole, part in zip(held, element_columns(key, html.as_py(), columns, closed)):
                    whole += part
                if len(held[0]) > ROWS:
                    yield batch(held)
                    held = [[] for _ in columns]
        if held[0]:
            yield batch(held)

    return documents.select(documents[id_col].cast("string"), documents[html_col]).mapInArrow(run, ddl)
