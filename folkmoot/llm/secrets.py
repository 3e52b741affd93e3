"""Secret scans with a recursive decoding worklist.

Each text is a layer. Runs that decode as URL escapes, base64 (also wrapped over
lines) or hexadecimal give layers of bytes; these are read as text, without their
NULs (UTF-16 and UTF-32), and inflated where they start like gzip, zlib, bzip2 or
xz data, member after member. URL, Unicode and character escapes are also replaced in
place, which gives a layer of the whole text: what is only partly encoded shows there. The
worklist goes on until nothing new appears, deepest layers first, and holds one piece
of each layer that is open. A layer of the same content from the same place is not
opened again, so cycles end, of inflating layers too. Every layer carries a map from
its characters to the spans of the original text that they came from, and what is
found in it is reported there.

Edge cases: null is the empty text; a very long text is one row, scanned whole;
inflated data are read in pieces of some ``PIECE`` bytes, which end where no secret and
no encoded run can go on (all that comes from one compressed run has that run's span, so
no place is lost); only where there is no such place in ``LONGEST`` bytes, a single run longer
than that is cut, and its parts overlap by ``OVERLAP``;
bytes that are no UTF-8 are kept as they are, one character each; a cut or broken
compressed run counts up to where it breaks; repeated rows are each reported; other
columns are never read.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = re.compile("passw|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

PERCENT = re.compile(r"(?<![A-Za-z0-9_.~+/=:&?-])(?:[A-Za-z0-9_.~+/=:&?-]*+%[0-9A-Fa-f]{2})++[A-Za-z0-9_.~+/=:&?-]*+")
BYTE = re.compile("%([0-9A-Fa-f]{2})")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/]{16,}|[A-Za-z0-9_-]{16,})={0,2}(?![A-Za-z0-9+/_-])")
#: Lines of one width, a multiple of four, and a last one that may be shorter.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])([A-Za-z0-9+/]{16,})(?:\r?\n[ \t]*[A-Za-z0-9+/]+)+={0,2}(?![A-Za-z0-9+/=])")
HEXED = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){12,}(?![0-9A-Fa-f])")
PIECE, LONGEST, OVERLAP = 1 << 24, 1 << 26, 1 << 20
#: Bytes that stand in no secret and in no encoded run, and a single space between words, which part them; so do four NULs.
APART, BETWEEN = b"()<>|,[]!*^`$@", re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
ESCAPED = re.compile("(?:%[0-9A-Fa-f]{2})+")

Found = tuple[int, int, str]
NOWHERE = np.zeros(0, np.int64)


def base_spans(text: str) -> list[Found]:
    """``(start, end, kind)`` of one layer, leftmost and non-overlapping per kind."""
    out: list[Found] = []
    if ASSIGN_WORDS.search(text):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _opener(data: bytes):
    """The decompressor of what ``data`` starts like, if of anything, and whether the start leaves no doubt."""
    if data.startswith(b"\x1f\x8b\x08"):
        return zlib.decompressobj(31), True
    if data.startswith(b"BZh"):
        return bz2.BZ2Decompressor(), True
    if data.startswith(b"\xfd7zXZ\x00"):
        return lzma.LZMADecompressor(lzma.FORMAT_XZ), True
    if len(data) > 2 and data[0] & 15 == 8 and data[0] >> 4 < 8 and not data[1] & 32 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(), False
    return None, False


def _members(data: bytes) -> Iterator[bytes]:
    """What the members of ``data``, one after the other, inflate to, in parts of bounded size; what follows them as it is."""
    while data:
        unpack, sure = _opener(data)
        if unpack is None:
            yield data
            return
        rest = data
        try:
            while not unpack.eof:
                part = unpack.decompress(rest, PIECE)
                rest = getattr(unpack, "unconsumed_tail", b"")
                if not part and not rest:
                    return
                yield part
        except (zlib.error, lzma.LZMAError, OSError, ValueError, EOFError):
            return
        data = unpack.unused_data


def _inflated(data: bytes) -> Iterator[bytes]:
    """The inflated data in pieces that overlap; none if ``data`` are not compressed."""
    if _opener(data)[0] is None:
        return
    held, least = bytearray(), PIECE
    for part in _members(data):
        held += part
        if len(held) >= least:
            end = _parted(held)
            if end or len(held) > LONGEST:
                yield bytes(memoryview(held)[: end or len(held)])
                del held[: end or len(held) - OVERLAP]
            least = len(held) + PIECE
    if held:
        yield bytes(held)


def _parted(held: bytearray) -> int:
    """The last place in ``held`` that no token can reach over; 0 if there is none."""
    end = max(max(held.rfind(c) for c in APART) + 1, held.rfind(bytes(4)) + 4 if bytes(4) in held else 0)
    for size in (1 << 12, 1 << 18, len(held)):
        low = max(end, len(held) - size)
        last = None
        for last in BETWEEN.finditer(held, low):
            pass
        if last is not None:
            return last.end()
        if low == end:
            break
    return end


class _Layer:
    """A text or bytes with, for each character, where in the original it starts and ends.

    The places of what was inflated are one for all (arrays of stride 0).
    """

    __slots__ = ("content", "ends", "starts")

    def __init__(self, content: str | bytes, starts: np.ndarray, ends: np.ndarray):
        self.content, self.starts, self.ends = content, starts, ends

    def part(self, content: str | bytes, lows: np.ndarray, highs: np.ndarray) -> _Layer:
        """A layer whose characters came from ``[low, high)`` of this one."""
        if self.one_place() and len(content):
            return self.whole(content, 0, len(self.starts))
        return _Layer(content, self.starts[lows], self.ends[np.maximum(highs, lows + 1) - 1])

    def whole(self, content: str | bytes, lo: int, hi: int) -> _Layer:
        """A layer all of whose characters came from ``[lo, hi)``, held as one place."""
        n = len(content)
        return _Layer(content, np.broadcast_to(self.starts[lo], n), np.broadcast_to(self.ends[hi - 1], n))

    def one_place(self) -> bool:
        return self.starts.strides == (0,)

    def digest(self) -> bytes:
        text = isinstance(self.content, str)
        data = self.content.encode("utf-8", "surrogatepass") if text else self.content
        return hashlib.blake2b(data, digest_size=16, salt=b"t" if text else b"b").digest()

    def key(self) -> tuple[bytes, bytes]:
        """Equal for layers of equal content and places."""
        places = (self.starts[:1], self.ends[:1]) if self.one_place() else (self.starts, self.ends)
        return self.digest(), hashlib.blake2b(b"".join(p.tobytes() for p in places), digest_size=16).digest()


def _opened(layer: _Layer) -> Iterator[_Layer]:
    """The layers of bytes: what they inflate to, their text, and it without NULs."""
    data = layer.content
    if not data:
        return
    for piece in _inflated(data):
        yield layer.whole(piece, 0, len(data))
    if _opener(data)[1]:
        return
    text = data.decode("utf-8", "surrogateescape")
    if layer.one_place():
        yield layer.whole(text, 0, len(layer.starts))
        if 0 in data and (rest := data.replace(b"\0", b"")):
            yield layer.whole(rest, 0, len(layer.starts))
        return
    if len(text) == len(data):
        at = np.arange(len(data))
        yield layer.part(text, at, at + 1)
    else:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF) - 2 * ((code >= 0xDC80) & (code <= 0xDCFF))
        at = np.cumsum(sizes) - sizes
        yield layer.part(text, at, at + sizes)
    if 0 in data:
        at = np.nonzero(np.frombuffer(data, np.uint8))[0]
        yield layer.part(data.replace(b"\0", b""), at, at + 1)


def _percent(layer: _Layer) -> Iterator[_Layer]:
    if "%" not in layer.content:
        return
    for m in PERCENT.finditer(layer.content):
        coded = np.frombuffer(m[0].encode(), np.uint8)
        at = np.array([c.start() for c in BYTE.finditer(m[0])])
        head = np.ones(len(coded), bool)
        head[at + 1] = head[at + 2] = False
        value, size = coded.copy(), np.ones(len(coded), np.int64)
        value[at], size[at] = np.frombuffer(bytes.fromhex("".join(BYTE.findall(m[0]))), np.uint8), 3
        lows = m.start() + np.nonzero(head)[0]
        yield layer.part(value[head].tobytes(), lows, lows + size[head])


def _in_place(layer: _Layer, found: Iterator[tuple[int, str, list[int]]]) -> Iterator[_Layer]:
    """The layer with texts put in place of others: for each of ``found`` where it starts, its text, and where each of its characters ends."""
    pieces, sizes, at = [], [], 0
    for start, text, ends in found:
        pieces += [layer.content[at:start], text]
        sizes.append((start, ends))
        at = ends[-1]
    if not pieces:
        return
    pieces.append(layer.content[at:])
    content = "".join(pieces)
    if layer.one_place():
        yield layer.whole(content, 0, len(layer.starts))
        return
    # a character that stays is one wide; the others' borders are put between
    borders = np.ones(len(layer.content) + 1, bool)
    for start, ends in sizes:
        borders[start + 1 : ends[-1]] = False
        borders[ends[:-1]] = True
    places = np.nonzero(borders)[0]
    yield layer.part(content, places[:-1], places[1:])


def _escapes(layer: _Layer) -> Iterator[_Layer]:
    if "\\" not in layer.content and "&#" not in layer.content:
        return

    def found() -> Iterator[tuple[int, str, list[int]]]:
        for m in ESCAPE.finditer(layer.content):
            code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
            if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
                yield m.start(), chr(code), [m.end()]

    yield from _in_place(layer, found())


def _percent_in_place(layer: _Layer) -> Iterator[_Layer]:
    if "%" not in layer.content:
        return

    def found() -> Iterator[tuple[int, str, list[int]]]:
        for m in ESCAPED.finditer(layer.content):
            text, at, ends = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"), m.start(), []
            for c in text:
                at += 3 * len(c.encode("utf-8", "surrogateescape"))
                ends.append(at)
            yield m.start(), text, ends

    yield from _in_place(layer, found())


def _decoded(layer: _Layer, run: str, places: np.ndarray) -> _Layer | None:
    """The layer of a base64 run whose characters stand at ``places``."""
    run = run.rstrip("=")
    if len(run) % 4 == 1:
        return None
    try:
        data = base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    if not data:
        return None
    if layer.one_place():
        return layer.whole(data, 0, len(layer.starts))
    bits = np.arange(len(data)) * 8
    return layer.part(data, places[bits // 6], places[(bits + 7) // 6] + 1)


def _base64(layer: _Layer) -> Iterator[_Layer]:
    for m in WRAPPED.finditer(layer.content) if "\n" in layer.content else ():
        rows = [r.strip(" \t\r") for r in m[0].split("\n")]
        if len(m[1]) % 4 == 0 and all(len(r) == len(m[1]) for r in rows[:-1]) and len(rows[-1]) <= len(m[1]):
            at = m.start() + np.array([k for k, c in enumerate(m[0]) if c not in " \t\r\n"])
            if (found := _decoded(layer, "".join(rows), at)) is not None:
                yield found
    for m in BASE64.finditer(layer.content):
        if (found := _decoded(layer, m[0], NOWHERE if layer.one_place() else np.arange(m.start(), m.end()))) is not None:
            yield found


def _hexed(layer: _Layer) -> Iterator[_Layer]:
    for m in HEXED.finditer(layer.content):
        if m[0].isdigit():
            continue
        if layer.one_place():
            yield layer.whole(bytes.fromhex(m[0]), 0, len(layer.starts))
        else:
            k = m.start() + 2 * np.arange(len(m[0]) // 2)
            yield layer.part(bytes.fromhex(m[0]), k, k + 2)


_HINT = re.compile(r"[A-Za-z0-9+/_-]{16}|%[0-9A-Fa-f]{2}|\\[ux]|&#")


def _unwrapped(layer: _Layer) -> Iterator[_Layer]:
    if isinstance(layer.content, bytes):
        yield from _opened(layer)
    elif _HINT.search(layer.content):
        for unwrap in (_percent, _percent_in_place, _escapes, _base64, _hexed):
            yield from unwrap(layer)


def scan(text: str | None) -> tuple[list[Found], list[Found]]:
    """The base spans of a text, and the spans that hidden layers add, both in its code points."""
    text = text or ""
    base = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    if not _HINT.search(text):
        return base, []
    n = len(text)
    top = _Layer(text, np.arange(n), np.arange(n) + 1)
    seen, todo, added = {top.key()}, [_unwrapped(top)], set()
    spans_of: dict[bytes, list[Found]] = {}
    while todo:
        new = next(todo[-1], None)
        if new is None:
            todo.pop()
            continue
        key = new.key()
        if key in seen:
            continue
        seen.add(key)
        todo.append(_unwrapped(new))
        if isinstance(new.content, str):
            if key[0] not in spans_of:
                spans_of[key[0]] = base_spans(new.content)
            added |= {(int(new.starts[s]), int(new.ends[e - 1]), kind) for s, e, kind in spans_of[key[0]]}
    return base, sorted(added - set(base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _said(spans: list[Found]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and spans of each row; ``spans`` lists base and hidden ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for x in b.column(1):
                base, added = scan(x.as_py())
                kinds = [k for _, _, k in base]
                both = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if added else base
                for col, v in zip(out, (*map(kinds.count, KINDS), hashlib.sha256(_said(base).encode()).hexdigest(), _said(both))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), *(pa.array(c, pa.string()) for c in out[3:])], names=["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return found.withColumnRenamed("_id", id_col)
