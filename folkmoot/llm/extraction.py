"""Main-text extraction by wrapper induction.

Pages of a host are dealt by layout (their set of tags); each of the ``LAYOUTS`` most
frequent ones has a pivot page (least hash of its html), and every page of the host is
aligned with its layout's pivot, else with the first one, by simple tree matching of
their block elements. The pivot's nodes are slots, and what many pages say in a slot is
counted over all pages. A slot's text is template if it stands there in at least
``EVIDENCE`` pages that share nothing else, and in ``SHARE`` of the slot's pages or
more: a constant line, or one of a few that take turns. Within articles it must be a
constant line (``ARTICLE_EVIDENCE``, ``ARTICLE_SHARE``). To tell whether pages share
something else, each block carries the hash of the page's longest other block: copies
and near copies of a page have few such companions for their number, and are no
evidence. Texts that vary are content.

What is looked at is the page's articles (else its main element, else its body), without
what HTML itself marks as menus, headers, footers, sidebars, forms, scripts and hidden
parts, by tags and roles. Outside of articles and main elements a container whose class
or id is one of ``LABELS`` as a whole goes too, and reader comments go everywhere.

One pass parses and aligns; its blocks are written, and the few template texts join
back. Pivots and templates are broadcast only if they take at most
``BROADCAST_BYTES``, else they are joined by host. Hosts of fewer than ``EVIDENCE``
pages have no pivot.

Edge cases: null or empty html has the empty text; broken and cut markup is read
as far as it goes; a null url is a host of its own; repeated pages are each
reported; nothing is cut or capped; other columns are never read. Where two lists of
children have over ``PAIRS`` pairs of unlike subtrees, many pairs are weighed at a time: the
weights are the same.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LAYOUTS, EVIDENCE, SHARE, UNLIKE, PAIRS, BROADCAST_BYTES = 3, 3, 0.1, 0.5, 40_000, 32 << 20
#: Pairs of subtrees whose weights are held at a time, and numbers of the programs that make them.
TABLE, CELLS = 1 << 25, 1 << 20
#: The same within articles, where a line that some pages repeat is their text.
ARTICLE_EVIDENCE, ARTICLE_SHARE = 5, 0.8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre section select summary table tbody td tfoot th thead tr ul caption".split()
)
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption option optgroup legend".split())
DROPPED = frozenset("aside button datalist dialog footer form head iframe input label menu nav noembed noframes noscript object optgroup option script select style svg template textarea title canvas audio video map math applet".split())
#: Classes and ids of containers outside of articles that name what is no main text, and of reader comments.
LABELS = frozenset("ad ads advert adverts advertisement breadcrumbs cookie-notice cookies menu navbar navigation notice sidebar".split())
COMMENTS = frozenset("comment comments comment-list commentlist".split())
#: Elements that an end tag closes over the borders of table cells.
OVER_CELLS = frozenset("td th tr tbody thead tfoot table article main body html".split())
CONTAINERS = frozenset("article center div dl fieldset ol section table ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())

_MARK = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile(r"""[>"']""")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOLD_BY = re.compile("class|id|role|hidden|style", re.I)
_SPACE = re.compile(r"\s+")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
# A parent's open child that a start tag ends, and the elements beyond which it does not reach.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}


def _tags(html: str) -> Iterator[tuple[int | None, int, str | None, str]]:
    """``(start, end, name, attributes)`` of each tag, comment and declaration; names of end tags begin with a slash, comments have none.

    The last one is ``(None, end of the text, None, "")``. Tags that never end are text, but for one that the
    page's end cuts off. Linear: where a tag ends follows from the first quote or ``>`` after its
    name, and each of these is looked at once, however many tags come to it.
    """
    ends: dict[int, int] = {}  # a quote or > outside of quotes: where the tag ends, or -1
    special, last_end = -1, html.rfind(">")
    at, n = 0, len(html)

    def end_of(place: int) -> int:
        nonlocal special
        if special < place:
            m = _SPECIAL.search(html, place)
            special = m.start() if m else n
        seen, here, out = [], special, -1
        while here < n:
            if here in ends:
                out = ends[here]
                break
            seen.append(here)
            if html[here] == ">":
                out = here
                break
            shut = html.find(html[here], here + 1)
            m = _SPECIAL.search(html, shut + 1) if shut >= 0 else None
            here = m.start() if m else n
        ends.update(dict.fromkeys(seen, out))
        return out

    def raw_end(tag: str, place: int) -> int:
        m = _RAW_ENDS[tag].search(html, place)
        return m.start() if m else -1

    first = -1  # the first mark since the last tag
    while (m := _MARK.search(html, at)) is not None:
        start = m.start()
        if html.startswith("<!--", start):
            shut = _COMMENT_END.search(html, start + 4)
            at = shut.end() if shut else n
            yield start, at, None, ""
            first = -1
            continue
        name = _NAME.match(html, start + 1)
        end = end_of(name.end()) if name and last_end > start else -1
        if end >= 0:
            at = end + 1
            tag = name[0].lower()
            yield start, at, tag, html[name.end() : end]
            first = -1
            if tag in RAW:
                at = raw_end(tag, at)
                if at < 0:  # all the rest is inside
                    yield None, end + 1, None, ""
                    return
                yield end + 1, at, None, ""
        elif html[start + 1] in "!?/" and last_end > start:
            at = html.index(">", start) + 1
            yield start, at, None, ""
            first = -1
        else:
            first = start if first < 0 else first
            at = start + 2
    yield None, n if first < 0 else first, None, ""


class Page:
    """Block elements in document order, and the text blocks between their tags."""

    __slots__ = ("blocks", "children", "content", "dropped", "in_article", "shape", "sizes", "tags", "texts")

    def __init__(self, html: str):
        self.tags: list[str] = ["#"]
        self.children: list[list[int]] = [[]]
        self.dropped: list[bool] = [False]
        self.blocks: list[tuple[int, str]] = []
        roots = self._build(html)
        self.texts: dict[int, list[str]] = {}
        for node, text in self.blocks:
            self.texts.setdefault(node, []).append(text)
        self.shape, self.sizes = self._shapes()
        self.content = self._content(roots)

    def _build(self, html: str) -> dict[str, list[int]]:
        stack: list[tuple[str, int]] = [("#", 0)]  # open elements, with the innermost block element
        depths: defaultdict[str, list[int]] = defaultdict(lambda: [0])  # where elements of a tag are open, after a 0
        open_blocks: list[int] = [0]  # where block elements are open
        roots: dict[str, list[int]] = {"article": [], "main": [], "body": []}
        pieces: list[str] = []
        at, n = 0, len(html)

        def flush() -> None:
            if pieces:
                text = _SPACE.sub(" ", "".join(pieces)).strip()
                if text and not self.dropped[stack[-1][1]]:
                    self.blocks.append((stack[-1][1], text))
                pieces.clear()

        def say(text: str) -> None:
            if text and not self.dropped[stack[-1][1]]:
                pieces.append(unescape(text) if "&" in text else text)

        def close(depth: int) -> None:
            if open_blocks[-1] >= depth:
                flush()
            while open_blocks[-1] >= depth:
                open_blocks.pop()
            for tag, _ in stack[depth:]:
                depths[tag].pop()
            del stack[depth:]

        for start, at_end, tag, attributes in _tags(html):
            if start is None:  # the end of the page, and perhaps a tag that it cuts off
                say(html[at:at_end])
                break
            say(html[at:start])
            at = at_end
            if tag is None:
                continue
            if tag[0] == "/":
                tag = tag[1:]
                if tag == "br":
                    pieces.append(" ")
                depth = depths[tag][-1]
                if depth and (tag in OVER_CELLS or depth > max(depths["td"][-1], depths["th"][-1], depths["table"][-1])):
                    close(depth)
                continue
            if tag in ENDS_P and stack[open_blocks[-1]][0] == "p":
                close(open_blocks[-1])
            if tag in _CLOSES:
                ended, reach = _CLOSES[tag]
                least = max(depths[t][-1] for t in reach)
                while (depth := max(depths[t][-1] for t in ended)) > least:
                    close(depth)
                    if tag != "tr":
                        break
            if tag == "br":
                pieces.append(" ")
            if tag in VOID and tag != "hr":
                continue
            parent = stack[-1][1]
            inside = depths["article"][-1] > 0 or depths["main"][-1] > 0
            bad = tag in DROPPED or tag == "header" and not inside or bool(attributes and _TOLD_BY.search(attributes) and _boilerplate(tag, attributes, inside))
            if tag in BLOCK or bad:
                flush()
                node = len(self.tags)
                self.tags.append(tag)
                self.children.append([])
                self.children[parent].append(node)
                self.dropped.append(self.dropped[parent] or bad)
                kind = "main" if "main" in attributes and re.search(r"""role\s*=\s*["']?main\b""", attributes) else tag
                if kind in roots and not self.dropped[node]:
                    roots[kind].append(node)
            else:
                node = parent
            if tag == "hr":
                continue
            if attributes.endswith("/") and tag in ("svg", "path", "use", "math"):
                continue
            if tag in BLOCK:
                open_blocks.append(len(stack))
            depths[tag].append(len(stack))
            stack.append((tag, node))
        flush()
        return roots

    def _shapes(self) -> tuple[list[int], list[int]]:
        """For each node a number, equal for subtrees of equal tags, and the subtree's size."""
        out, sizes = [0] * len(self.tags), [1] * len(self.tags)
        for node in range(len(self.tags) - 1, -1, -1):
            out[node] = hash((self.tags[node], *(out[c] for c in self.children[node])))
            sizes[node] += sum(sizes[c] for c in self.children[node])
        return out, sizes

    def _content(self, roots: dict[str, list[int]]) -> frozenset[int]:
        """The nodes of all articles with text, or of the main elements, or of the body, or all."""
        for kind in ("article", "main", "body"):
            self.in_article = kind == "article"
            held, todo = set(), list(roots[kind])
            while todo:
                node = todo.pop()
                if node not in held:
                    held.add(node)
                    todo += self.children[node]
            if any(node in held for node in self.texts):
                return frozenset(held)
        return frozenset(range(len(self.tags)))


@lru_cache(4096)
def _boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id") and tag in CONTAINERS:
            if any(label in COMMENTS or (label in LABELS and not inside and tag != "article") for label in value.split()):
                return True
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" and tag not in ("html", "body"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def align(a: Page, b: Page) -> dict[int, int]:
    """Simple tree matching of the block elements: the node of ``a`` for each of ``b`` that has one.

    Equal subtrees at either end of two lists of children match as they are (no
    matching is larger); the dynamic program runs over what is left between, a row at
    a time, over the weights of pairs of unlike subtrees.
    """
    out: dict[int, int] = {}
    sizes: dict[tuple[int, int], int] = {}

    def between(x: int, y: int) -> tuple[list[tuple[int, int]], list[int], list[int]]:
        xs, ys = a.children[x], b.children[y]
        lo, n, m = 0, len(xs), len(ys)
        while lo < n and lo < m and a.shape[xs[lo]] == b.shape[ys[lo]]:
            lo += 1
        hi = 0
        while hi < n - lo and hi < m - lo and a.shape[xs[n - 1 - hi]] == b.shape[ys[m - 1 - hi]]:
            hi += 1
        return [*zip(xs[:lo], ys[:lo]), *zip(xs[n - hi :], ys[m - hi :])], xs[lo : n - hi], ys[lo : m - hi]

    def rows(xs: list[int], ys: list[int]) -> Iterator[np.ndarray]:
        """For each of ``xs`` its weights with all of ``ys``, from tables of the distinct shapes."""
        of_y = {b.shape[y]: y for y in ys}
        at_y = {h: k for k, h in enumerate(of_y)}
        cy, end = np.array([at_y[b.shape[y]] for y in ys]), 0
        while end < len(xs):
            of_x: dict[int, int] = {}
            first = end
            while end < len(xs) and (a.shape[xs[end]] in of_x or len(of_x) * len(of_y) < TABLE):
                of_x[a.shape[xs[end]]] = xs[end]
                end += 1
            if len(of_x) * len(of_y) > PAIRS:
                table = many([*of_x.values()], [*of_y.values()])
            else:
                table = np.array([[weight(x, y) for y in of_y.values()] for x in of_x.values()])
            at_x = {h: k for k, h in enumerate(of_x)}
            for x in xs[first:end]:
                yield table[at_x[a.shape[x]]][cy]

    def many(xs: list[int], ys: list[int]) -> np.ndarray:
        """The weights of subtrees ``xs`` by ``ys``: those of one tag and of like numbers of children together."""
        out = np.zeros((len(xs), len(ys)), np.int32)
        groups: tuple[defaultdict, defaultdict] = (defaultdict(list), defaultdict(list))
        for p, nodes, of in ((a, xs, groups[0]), (b, ys, groups[1])):
            for k, node in enumerate(nodes):
                of[p.tags[node], len(p.children[node]).bit_length()].append(k)
        for (tag, n), of_x in groups[0].items():
            for (other, m), of_y in groups[1].items():
                if tag != other:
                    continue
                if not n or not m:
                    out[np.ix_(of_x, of_y)] = 1
                    continue
                step = max(1, CELLS >> (m + 6))
                for i in range(0, len(of_x), 64):
                    for j in range(0, len(of_y), step):
                        us, vs = of_x[i : i + 64], of_y[j : j + step]
                        if len(us) * len(vs) < 1 << m:  # few pairs of long lists
                            out[np.ix_(us, vs)] = [[weight(xs[u], ys[v]) for v in vs] for u in us]
                        else:
                            out[np.ix_(us, vs)] = together([xs[u] for u in us], [ys[v] for v in vs])
        return out

    def together(xs: list[int], ys: list[int]) -> np.ndarray:
        """The same of one tag, all with children: one program, each of its numbers an array over all pairs."""
        of_x, of_y = ({p.shape[c]: c for node in nodes for c in p.children[node]} for p, nodes in ((a, xs), (b, ys)))
        small = min(max(a.sizes[x] for x in xs), max(b.sizes[y] for y in ys)) < 1 << 15
        kind = np.int16 if small else np.int32
        below = np.zeros((len(of_y) + 1, len(of_x) + 1), kind)  # the last ones stand for no child
        below[:-1, :-1] = np.minimum(many([*of_x.values()], [*of_y.values()]).T, np.iinfo(kind).max)
        told = []
        for p, nodes, of in ((a, xs, of_x), (b, ys, of_y)):
            at = {h: k for k, h in enumerate(of)}
            held = np.full((max(len(p.children[node]) for node in nodes), len(nodes)), len(of))
            for k, node in enumerate(nodes):
                held[: len(p.children[node]), k] = [at[p.shape[c]] for c in p.children[node]]
            told.append(held)
        row = np.zeros((len(told[1]) + 1, len(ys), len(xs)), kind)
        nxt = np.zeros_like(row)
        for cx in told[0]:
            own = np.ascontiguousarray(below[:, cx])
            for j, cy in enumerate(told[1]):
                np.take(own, cy, axis=0, out=nxt[j + 1], mode="clip")
                np.add(nxt[j + 1], row[j], out=nxt[j + 1])
                np.maximum(nxt[j + 1], row[j + 1], out=nxt[j + 1])
                np.maximum(nxt[j + 1], nxt[j], out=nxt[j + 1])
            row, nxt = nxt, row
        return row[-1].T.astype(np.int32) + 1

    def matched(xs: list[int], ys: list[int], steps: list | None = None) -> int:
        """The best matching's weight; ``steps`` gets the packed choices of each row."""
        row = np.zeros(len(ys) + 1, np.int64)
        for own in rows(xs, ys):
            nxt = np.zeros_like(row)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + own), out=nxt[1:])
            if steps is not None:
                steps.append((np.packbits(nxt[1:] == row[1:]), np.packbits(nxt[1:] == nxt[:-1])))
            row = nxt
        return int(row[-1])

    def weight(x: int, y: int) -> int:
        if a.tags[x] != b.tags[y]:
            return 0
        if not a.children[x] or not b.children[y]:
            return 1
        key = (a.shape[x], b.shape[y])
        if key not in sizes:
            same, xs, ys = between(x, y)
            sizes[key] = 1 + (matched(xs, ys) if xs and ys else 0) + sum(a.sizes[p] for p, _ in same)
        return sizes[key]

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * len(a.tags) + 1000))
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        out[y] = x
        same, xs, ys = between(x, y)
        todo += same
        if xs and ys:
            steps: list = []
            matched(xs, ys, steps)
            i, j = len(xs), len(ys)
            while i and j:
                up, left = steps[i - 1]
                if up[(j - 1) >> 3] >> (7 - (j - 1) % 8) & 1:
                    i -= 1
                elif left[(j - 1) >> 3] >> (7 - (j - 1) % 8) & 1:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((xs[i], ys[j]))
    return out


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 42)
    return h - (h >> 63 << 64)


def blocks(html: str | None, pivot: Page | None) -> list[tuple[str, int, int, int, bool]]:
    """The content blocks as (text, slot: the pivot's node or -1, hash of the text, hash of the longest other text, whether in an article)."""
    if not html:
        return []
    page = Page(html)
    found = [(text, node, _hash(text)) for node, text in page.blocks if node in page.content]
    matched = align(pivot, page) if pivot is not None and found else {}
    longest = sorted({(len(text), h) for text, _, h in found}, reverse=True)[:2]
    other = lambda h: next((x for _, x in longest if x != h), 0)
    return [(text, matched.get(node, -1), h, other(h), page.in_article) for text, node, h in found]


_FIELDS = {"text": pa.string(), "slot": pa.int64(), "h": pa.int64(), "other": pa.int64(), "article": pa.bool_()}
_BLOCK_TYPE = pa.list_(pa.struct(list(_FIELDS.items())))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pivot_of = lru_cache(64)(Page)
    for b in batches:
        found, digests = [], []
        for html, pivot, layout in zip(b.column(3), b.column(4), b.column(5).to_pylist()):
            got = blocks(html.as_py(), pivot_of(pivot.as_py()) if pivot.is_valid else None)
            found.append([dict(zip(_FIELDS, (t, x if x < 0 else x * LAYOUTS + layout, *more))) for t, x, *more in got])
            digests.append(_hash(" ".join(t for t, *_ in got)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, _BLOCK_TYPE), pa.array(digests, pa.int64())], names=["_id", "_url", "_host", "blocks", "digest"])


def pivots_of(rows: DataFrame) -> DataFrame:
    """``(_h, pivots)``: for each host of ``EVIDENCE`` pages or more the pivots of its most frequent layouts."""
    each = rows.where(F.length("_html") > 0).groupBy("_host", "_layout").agg(F.count("*").alias("n"), F.min_by("_html", F.xxhash64("_html")).alias("pivot"))
    of_host = Window.partitionBy("_host")
    ranked = each.withColumn("rank", F.row_number().over(of_host.orderBy(F.desc("n"), "_layout"))).withColumn("all", F.sum("n").over(of_host))
    kept = ranked.where((F.col("all") >= EVIDENCE) & (F.col("rank") <= LAYOUTS))
    return kept.groupBy(F.col("_host").alias("_h")).agg(F.array_sort(F.collect_list(F.struct((F.col("rank") - 1).alias("k"), F.col("_layout").alias("layout"), "pivot"))).alias("pivots"))


def template_of(parsed: DataFrame) -> DataFrame:
    """``(_t, template)``: the template texts of each host, as pairs of slot and hash."""
    said = parsed.select("_host", "digest", F.explode("blocks").alias("b")).where("b.slot >= 0").select("_host", "b.slot", "b.h", "b.other", "b.article", "digest").distinct()
    texts = said.groupBy("_host", "slot", "h", "other").agg(F.count("*").alias("pages"), F.bool_or("article").alias("article")).groupBy("_host", "slot", "h").agg(F.count("*").alias("unlike"), F.sum("pages").alias("pages"), F.bool_or("article").alias("article"))
    slots = texts.groupBy(F.col("_host").alias("_sh"), F.col("slot").alias("_ss")).agg(F.sum("unlike").alias("all"))
    often = texts.where((F.col("unlike") >= F.when(F.col("article"), ARTICLE_EVIDENCE).otherwise(EVIDENCE)) & (F.col("unlike") >= UNLIKE * F.col("pages")))
    template = often.join(slots, (F.col("_host") == F.col("_sh")) & (F.col("slot") == F.col("_ss"))).where(F.col("unlike") >= F.when(F.col("article"), ARTICLE_SHARE).otherwise(SHARE) * F.col("all"))
    return template.groupBy(F.col("_host").alias("_t")).agg(F.collect_list(F.struct("slot", "h")).alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of each row."""
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    layout = F.xxhash64(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(html_col, F.lit(""))), F.lit("<([a-z][a-z0-9]*)"), F.lit(1)))))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("_host"), F.col(html_col).alias("_html"), layout.alias("_layout"))
    pivots = written(pivots_of(rows), "pivots")
    size = pivots.agg(F.sum(F.aggregate("pivots", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["pivot"])))).first()[0] or 0
    own = F.coalesce(F.get(F.filter("pivots", lambda p: p["layout"] == F.col("_layout")), F.lit(0)), F.get("pivots", F.lit(0)))
    joined = rows.join(F.broadcast(pivots) if size <= BROADCAST_BYTES else pivots, F.col("_host") == F.col("_h"), "left").select("_id", "_url", "_host", "_html", own.alias("p")).select("_id", "_url", "_host", "_html", F.col("p.pivot").alias("_pivot"), F.coalesce("p.k", F.lit(0)).alias("_k"))
    kind = pages.schema[id_col].dataType.simpleString()
    parsed = written(joined.mapInArrow(_aligned, f"_id {kind}, _url string, _host string, blocks array<struct<text string, slot long, h long, other long, article boolean>>, digest long"), "blocks")
    template = written(template_of(parsed), "template")
    told = template.agg(F.sum(F.octet_length("_t") + 24 * F.size("template") + 32)).first()[0] or 0
    kept = F.filter("blocks", lambda x: ~F.coalesce(F.array_contains("template", F.struct(x["slot"].alias("slot"), x["h"].alias("h"))), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda x: x["text"]), " ")
    return parsed.join(F.broadcast(template) if told <= BROADCAST_BYTES else template, F.col("_host") == F.col("_t"), "left").select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
