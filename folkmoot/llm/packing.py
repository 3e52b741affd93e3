"""Best-fit packing by the configuration linear program of the length histogram.

Texts become token ids and an end token; longer ones are cut into full pieces
from the end, so only the first is shorter. The histogram (one count for each
length up to the capacity) is all that reaches the driver. There the
configuration program (fewest bins whose patterns cover each length's count) is
solved by multiplicative weights: a length's price falls exponentially with its
coverage, and the pattern to use next is priced by the unbounded-knapsack
dynamic program over those that still lack coverage. The prices also prove a lower
bound by weak duality; steps are made finer until the cover is within ``GAP`` of it.
The fractional solution is rounded down and the rest packed best-fit. Pieces find their place by their rank
among equal lengths; hot lengths are ranked in groups.

Ids are those of the tokenizer as loaded: its added tokens (``<|endoftext|>``) are
one id each where their content stands in a text.

Edge cases: null and empty texts are one piece, the end token alone; null ids and
repeated rows are packed like any other; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

import json
import math
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY, END_ID, RATE = 1024, 2, 4.0
#: The duality gap to reach, and the most rounds to try for it.
GAP, ROUNDS = 0.001, 4
#: Rows that are ranked together; a length has at most MOST_GROUPS groups.
GROUP, MOST_GROUPS = 500, 4096
#: Texts are encoded together, each distinct word once, as long as they take at most so many bytes to work on: for each text, byte and U+0020 of it.
TOGETHER, ROW, BYTE, WORD = 96 << 20, 64, 3, 24
#: Bytes of words that one call of the tokenizer gets, and ids that are put together at once.
CALL, IDS = 8 << 10, 1 << 20
#: White space as the split knows it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ONE, TWO, THREE = (np.array([int.from_bytes(c.encode()) for c in SPACES if len(c.encode()) == n]) for n in (1, 2, 3))
#: Of each byte, whether it is white space, and whether it may be the first or the second of a longer one.
BLANK, LEAD, NEXT = (np.isin(np.arange(256), x) for x in (ONE, [*(TWO >> 8), *(THREE >> 16)], [*(TWO & 255), *(THREE >> 8 & 255)]))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to their ids (the tokenizer as loaded, no special tokens added) as little-endian uint32 bytes.

    The byte-level split, which a file names with ``use_regex`` alone, never joins a
    non-space with white space after it. So texts are cut before each U+0020 that
    stands between two non-spaces: the parts encode alone, and each distinct one is
    encoded once for all texts given. Parts that begin so and end with a non-space also
    encode alone when they follow each other, so many are handed over in one string; as a token of
    a byte-level vocabulary has a character for each byte, its ids are told apart by
    their lengths. Texts that hold an added token, and all texts of other tokenizers,
    are encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.loaded = Tokenizer.from_file(tokenizer_file)
        told = json.loads(Path(tokenizer_file).read_text())
        split = told.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in told.get("added_tokens") or ()]
        self.whole = bool(told.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True))
        self.whole |= any(c in SPACES for t in self.added for c in t)  # parts that follow each other might make one
        vocabulary = self.loaded.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes[[*vocabulary.values()]] = [len(t) for t in vocabulary]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.loaded.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _alone(self, parts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Ids, and of each part where its own begin and end in them; here each is encoded by itself."""
        found = [self.ids(part.decode()) for part in parts.to_pylist()]
        ends = np.cumsum([len(ids) for ids in found], dtype=np.int64)
        return found, np.append(0, ends)[:-1], ends

    def _joined(self, parts: pa.Array, glue: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The same of parts that may follow each other with ``glue`` between them."""
        bounds, data = _flat(parts)
        out, firsts, stops, lo, held = [], np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), 0, 0
        while lo < len(parts):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CALL, "right")) - 1)
            ids = self.ids((glue.join(parts[lo:hi].to_pylist()) if glue else data[bounds[lo] : bounds[hi]].tobytes()).decode())
            glued = np.arange(hi - lo) * len(glue) - bounds[lo]
            edges = np.append(0, np.cumsum(self.bytes[ids]))
            first, end = (np.searchsorted(edges, b + glued) for b in (bounds[lo:hi], bounds[lo + 1 : hi + 1]))
            if end[-1] != len(ids) or not np.array_equal(edges[first], bounds[lo:hi] + glued) or not np.array_equal(edges[end], bounds[lo + 1 : hi + 1] + glued):
                found, first, end = self._alone(parts[lo:hi])
                ids = np.concatenate(found)
            out.append(ids)
            firsts[lo:hi], stops[lo:hi] = first + held, end + held
            held += len(ids)
            lo = hi
        return out, firsts, stops

    def many(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """The ids of each text (null: none); each distinct part of them all is encoded once."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "").cast(pa.large_string())
        bounds, data = _flat(texts)
        cuts, black = np.append(data == 32, True), _white(data)
        np.logical_not(black, out=black)
        cuts[1:-1] &= black[:-1]
        cuts[: len(data) - 1] &= black[1:]
        del black
        whole = np.full(len(texts), self.whole)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        for k in np.nonzero(whole)[0]:
            cuts[bounds[k] : bounds[k + 1]] = False
        cuts[bounds[:-1][np.diff(bounds) > 0]] = True
        at = np.flatnonzero(cuts)
        del cuts
        coded = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        codes, parts = coded.indices.to_numpy(), coded.dictionary
        own = np.searchsorted(at, bounds)  # the parts of text k are those from own[k] to own[k + 1]
        del at, texts, coded

        lows, data = _flat(parts)
        lows, highs, white = lows[:-1], lows[1:], _white(data)
        fit = ~white[highs - 1]
        fit[codes[np.repeat(whole, np.diff(own))]] = False
        spaced = fit & (data[lows] == 32) & ~white[np.minimum(lows + 1, highs - 1)]
        bare = fit & ~white[lows]
        ids, first, size, held = [np.zeros(0, "<u4")], np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), 0
        for chosen, found in ((spaced, lambda p: self._joined(p, b"")), (bare, lambda p: self._joined(p, b"\n")), (~(spaced | bare), self._alone)):
            some, low, high = found(parts.filter(pa.array(chosen)))
            ids += some
            first[chosen], size[chosen] = low + held, high - low
            held += sum(map(len, some))
        ids = np.concatenate(ids)

        total, sizes = size[codes], np.zeros(len(own), np.int64)  # ids before each text
        sizes[own > 0] = np.cumsum(total, out=total)[own[own > 0] - 1]
        del total
        lo = 0
        while lo < len(whole):
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + IDS, "right")) - 1)
            code = codes[own[lo] : own[hi]]
            n = size[code]
            near = ids[np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(sizes[hi] - sizes[lo])].tobytes()
            for k in range(lo, hi):
                yield near[4 * (sizes[k] - sizes[lo]) : 4 * (sizes[k + 1] - sizes[lo])]
            lo = hi

    def __call__(self, text: str) -> bytes:
        return next(self.many([text]))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bounds of large strings, and their bytes one after another."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return bounds - bounds[0], np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]


def _white(data: np.ndarray) -> np.ndarray:
    """Of each byte of UTF-8, whether it belongs to white space."""
    white = BLANK[data]
    begun = LEAD[data[:-1]]
    begun &= NEXT[data[1:]]
    at = np.flatnonzero(begun)
    two = data[at].astype(np.int64) << 8 | data[at + 1]
    three = two << 8 | data[np.minimum(at + 2, len(data) - 1)]
    for n, found in ((2, np.isin(two, TWO)), (3, np.isin(three, THREE))):
        for k in range(n):
            white[at[found] + k] = True
    return white


@lru_cache(1)
def _encoder(tokenizer_file: str) -> Encoder:
    """A worker keeps the tokenizer from task to task, and no words."""
    return Encoder(tokenizer_file)


def _in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The two columns of rows whose texts take some TOGETHER bytes, across batches."""
    held, size = [], 0
    for b in batches:
        length, spaces = (pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype(np.int64) for n in (pc.binary_length(b.column(1)), pc.count_substring(b.column(1), " ")))
        ends = np.cumsum(ROW + BYTE * length + WORD * spaces)
        lo = 0
        while lo < b.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(ends, before + TOGETHER - size)) + 1, b.num_rows)
            held.append(b.slice(lo, hi - lo))
            size += int(ends[hi - 1]) - before
            lo = hi
            if size >= TOGETHER:
                full, held, size = held, [], 0
                yield _columns(full)
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    own, texts = ([b.column(k) for b in batches] for k in (0, 1))
    texts = [t.cast(pa.large_string()) for t in texts]
    return (own[0], texts[0]) if len(batches) == 1 else (pa.concat_arrays(own), pa.concat_arrays(texts))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer_file: str | None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` for each piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_file or default_tokenizer())
        for own, texts in _in_turn(batches):
            at, rows = [], []
            for i, found in enumerate(encode.many(texts)):
                ids = found + end
                for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    at.append(i)
                    rows.append((k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([own.take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, piece int, start long, length long, ids_crc32 long")


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value for each room, and the item taken there (-1: none)."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        k = int(np.searchsorted(lengths, room, "right"))
        best[room], take[room] = best[room - 1], -2  # -2: leave one unit free
        if k:
            value = prices[:k] + best[room - lengths[:k]]
            j = int(value.argmax())
            if value[j] > best[room]:
                best[room], take[room] = value[j], j
    return best, take


def _pattern(seed: int, take: np.ndarray, lengths: np.ndarray, capacity: int) -> Counter:
    out, room = Counter([seed]), capacity - int(lengths[seed])
    while room > 0 and take[room] != -1:
        if take[room] == -2:
            room -= 1
        else:
            out[int(take[room])] += 1
            room -= int(lengths[take[room]])
    return out


def _covered(lengths: np.ndarray, need: np.ndarray, capacity: int, rounds: int, rate: float) -> tuple[Counter, float]:
    """A fractional cover in ``rounds`` equal steps, and the greatest lower bound that its prices prove."""
    covered, use, bound = np.zeros(len(lengths)), Counter(), 0.0
    for r in range(1, rounds + 1):
        target = r / rounds
        while (lacking := covered < target - 1e-9).any():
            prices = np.where(lacking, lengths / capacity * np.exp(rate * (target - covered)), 0.0)
            open_ = np.nonzero(lacking)[0]
            best, take = knapsack(lengths[open_], prices[open_], capacity)
            # weak duality: no pattern is worth more than the knapsack's best
            bound = max(bound, float(prices @ need) / float(best[-1]))
            for seed in range(len(open_) - 1, -1, -1):
                pattern = Counter({int(open_[k]): c for k, c in _pattern(seed, take, lengths[open_], capacity).items()})
                step = min((target - covered[k]) * need[k] / c for k, c in pattern.items())
                if step <= 1e-9:
                    continue
                for k, c in pattern.items():
                    covered[k] += step * c / need[k]
                use[tuple(sorted((int(lengths[k]), c) for k, c in pattern.items()))] += step
    return use, bound


def fractional(histogram: dict[int, int], capacity: int, gap: float = GAP, rounds: int = ROUNDS, rate: float = RATE) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Patterns (length -> copies) and how often to use each, covering the histogram; and a lower bound on the bins of any cover.

    Rounds are doubled until the cover is within ``gap`` of the bound, or there
    are ``rounds`` of them; the best cover found is given.
    """
    lengths = np.array(sorted(histogram))
    need = np.array([histogram[int(n)] for n in lengths], float)
    # the prices of plain room, and of halves, are worth one at most for any pattern
    bound = max(float(need @ lengths) / capacity, float(need[2 * lengths > capacity].sum() + need[2 * lengths == capacity].sum() / 2))
    best, tried = None, 1
    while best is None or (tried <= rounds and sum(best.values()) > (1 + gap) * bound):
        use, proved = _covered(lengths, need, capacity, tried, rate)
        bound = max(bound, proved)
        if best is None or sum(use.values()) < sum(best.values()):
            best = use
        tried *= 2
    return [(dict(p), x) for p, x in best.items()], bound


def best_fit(histogram: Counter, capacity: int) -> Counter:
    """Best-fit decreasing over counts: patterns and how many bins have each."""
    rooms: list[int] = []
    bins: dict[int, list[Counter]] = {}
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms.pop(at)
                held = bins[room].pop()
            else:
                room, held = capacity, Counter()
            held[n] += 1
            insort(rooms, room - n)
            bins.setdefault(room - n, []).append(held)
    return Counter(tuple(sorted(b.items())) for held in bins.values() for b in held)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, lo, hi, sequence, copies, offset)``.

    The pieces of a length whose rank is in [lo, hi) fill ``copies`` places from
    ``offset`` on in each of the sequences from ``sequence`` on.
    """
    left = Counter(histogram)
    chosen: Counter = Counter()
    chosen[((capacity, 1),)] = left.pop(capacity, 0)
    for pattern, x in sorted(fractional(left, capacity)[0] if left else [], key=lambda p: -p[1]):
        times = min(math.floor(x + 1e-6), *(left[n] // c for n, c in pattern.items()))
        if times > 0:
            chosen[tuple(sorted(pattern.items()))] += times
            left.subtract({n: c * times for n, c in pattern.items()})
    chosen += best_fit(+left, capacity)
    out, sequence, rank = [], 0, Counter()
    for pattern, times in sorted(chosen.items()):
        offset = 0
        for n, c in sorted(pattern, reverse=True):
            out.append((n, rank[n], rank[n] + c * times, sequence, c, offset))
            rank[n] += c * times
            offset += n * c
        sequence += times
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_file: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each piece of each row with its sequence and its place in it."""
    from .common import written

    spark = docs.sparkSession
    cutted = written(pieces(docs, id_col, text_col, tokenizer_file, capacity, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in cutted.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    groups = [(n, min(MOST_GROUPS, -(-c // GROUP))) for n, c in histogram.items()]
    places = spark.createDataFrame(plan(histogram, capacity) if histogram else [], "n long, lo long, hi long, first long, copies long, place long")
    sized = cutted.join(F.broadcast(spark.createDataFrame(groups, "l long, groups long")), F.col("length") == F.col("l"))
    grouped = sized.withColumn("g", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), F.col("groups")))
    before = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = grouped.groupBy("length", "g").agg(F.count("*").alias("c")).select(F.col("length").alias("sl"), F.col("g").alias("sg"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "g").orderBy("_id", "piece", "ids_crc32", "start")
    ranked = grouped.withColumn("r", F.row_number().over(own)).join(starts, (F.col("length") == F.col("sl")) & (F.col("g") == F.col("sg"))).withColumn("r", F.col("base") + F.col("r") - 1)
    return ranked.join(F.broadcast(places), (F.col("length") == F.col("n")) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi"))).select(
        F.col("_id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.floor((F.col("r") - F.col("lo")) / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.col("length") * F.pmod(F.col("r") - F.col("lo"), F.col("copies"))).cast("long").alias("offset"),
    )
