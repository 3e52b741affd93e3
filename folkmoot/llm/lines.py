"""Fuzzy line dedup: MinHash over character shingles, verified, one line kept per component.

Lines are the texts' parts between newlines. A line's MinHash signature over its
shingles of ``k`` characters is cut into bands; lines that share a band are
candidates. Pairs of an exact Jaccard similarity of ``threshold`` or more are
links; a distributed union-find makes components; of each the first line, by
document id and place, stays.

In a band of at most ``SMALL`` lines all pairs are compared; in a larger one each
line is compared with the least. A large band that this leaves in several
components is dealt as pairs of chunks of ``chunk`` lines, and each task compares
what its chunks hold in different components, merging as it goes. It emits an
edge for each line at most, so no pairs of a group are made, nor a link lost.

Banding recall is 1 - (1 - s ** ROWS) ** BANDS: 0.991 at 0.8, 0.999 at 0.85.
Bands and links know lines by a 64-bit hash; what is removed is told by a second
64-bit hash too, so lines that share the first are neither joined nor lost.

Edge cases: null texts stay null; blank lines are never duplicates and stay
where they are; lines shorter than a shingle are duplicates only if equal; of
rows equal in id and text each keeps the same lines; rows with a null id come
first; a row whose lines all go keeps the empty text; other columns pass through, but
those named as the counts, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, packed, written

K, THRESHOLD, ROWS, BANDS, SMALL, CHUNK = 8, 0.8, 5, 12, 2, 512
#: Parts of a class of lines.
SALTS = 8
#: Hashes of lines that may be broadcast to find their texts; more of them are joined by hash.
BROADCAST_ROWS = 1_000_000
#: Band keys are dealt to parts: one for so many bytes of input, so that each fits in memory, and as many at least.
PART_BYTES, LEAST_PARTS = 32 << 20, 1024
#: Pairs that a task gathers before it hands them on.
PAIRS = 1 << 20
#: Pairs of a part that are held at once.
HELD = 1 << 22
#: Smaller blocks are compared without asking which other bands their lines share.
ALONE = 24
#: Characters hashed at once; their signatures stay in the cache.
BLOCK = 1 << 16


def shingle_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """A mixed 32-bit hash for each window of ``k`` code points."""
    h, width = codes.astype(np.uint32), 1
    while width < k:  # k is a power of two
        h = h[:-width] * np.uint32(pow(0x9E3779B1, width, 1 << 32)) + h[width:]
        width *= 2
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def band_keys(lines: list[str], k: int = K, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """For each line (of at least ``k`` characters) the keys of its bands, as int64."""
    factors = np.random.default_rng(11).integers(0, 1 << 31, rows * bands, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    sizes = np.array([len(x) for x in lines])
    hashes = shingle_hashes(np.frombuffer("".join(lines).encode("utf-32-le", "replace"), np.uint32), k)
    starts = np.cumsum(sizes) - sizes
    cuts = np.column_stack([starts, starts + sizes - k + 1]).ravel()
    padded = np.append(hashes, np.uint32(0xFFFFFFFF))
    cuts = np.minimum(cuts, len(padded) - 1)
    out, turned = np.empty((len(lines), bands), np.uint64), np.empty_like(padded)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(lines), 0x9E3779B97F4A7C15 * (b + 1) % (1 << 64), np.uint64)
            for r in range(rows):
                np.multiply(padded, factors[b * rows + r], out=turned)
                turned[-1] = 0xFFFFFFFF
                low = np.minimum.reduceat(turned, cuts)[::2]
                key = (key ^ low) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            out[:, b] = key
    return out.view(np.int64)


def _banded(k: int, parts: int):
    """Texts -> ``(part, pairs)``: packed (band key, line) pairs whose keys belong to the part."""

    def keyed(lines: list[str], ids: list[int]) -> np.ndarray:
        keys = band_keys(lines, k)
        return np.column_stack([keys.ravel(), np.repeat(np.array(ids, np.int64), keys.shape[1])])

    def dealt(blocks: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate(blocks)
        part = (pairs[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        pairs, part = pairs[order], part[order]
        start = np.nonzero(np.append(True, part[1:] != part[:-1]))[0]
        data = [x.tobytes() for x in np.split(pairs, start[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[start]), pa.array(data, pa.binary())], names=["part", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a copy within the task adds nothing
        lines: list[str] = []
        ids: list[int] = []
        size, blocks, held = 0, [], 0
        for b in batches:
            for x in b.column(0):
                for line in (x.as_py() or "").split("\n"):
                    if len(line) < k or line.isspace():
                        continue
                    h = xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), 42)
                    if h in seen:
                        continue
                    seen.add(h)
                    lines.append(line)
                    ids.append(h - (h >> 63 << 64))
                    size += len(line)
                    if size >= BLOCK:
                        blocks.append(keyed(lines, ids))
                        held += len(blocks[-1])
                        lines, ids, size = [], [], 0
                        if held >= PAIRS:
                            yield dealt(blocks)
                            blocks, held = [], 0
        if lines:
            blocks.append(keyed(lines, ids))
        if blocks:
            yield dealt(blocks)

    return run


def _candidates(small: int, most: int = HELD):
    """Parts, sorted, -> rows (a, b, key): pairs, and for large bands each member with one of them and the key.

    Where over ``most`` pairs of a part are held, the large bands' members go out and
    only the one they are compared with is kept, so a hot band is never held whole.
    """

    def solve(pairs: np.ndarray, heads: dict[int, int], last: bool) -> tuple[list[pa.RecordBatch], np.ndarray]:
        key, line = pairs[:, 0], pairs[:, 1]
        order = np.lexsort((line, key))
        key, line = key[order], line[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])  # copies of a line in several tasks
        key, line = key[new], line[new]
        start = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        size = np.diff(np.append(start, len(key)))
        large = size > small
        if heads:
            large |= np.isin(key[start], np.fromiter(heads, np.int64, len(heads)))
        out = []
        for s, n in zip(start[large], size[large]):
            group, name = line[s : s + n], int(key[s])
            known = name in heads
            head = heads.setdefault(name, int(group[0]))
            group = group[group != head] if known else group
            out.append(pa.RecordBatch.from_arrays([pa.array(group), pa.array(np.full(len(group), head)), pa.array(np.full(len(group), name))], names=["a", "b", "key"]))
        if not last:
            return out, np.column_stack([key, line])[np.repeat(~large, size)]
        a, b = [], []
        for n in np.unique(size[(size > 1) & ~large]):
            group = line[start[(size == n) & ~large][:, None] + np.arange(n)]
            i, j = np.triu_indices(n, 1)
            a.append(group[:, j].ravel())
            b.append(group[:, i].ravel())
        pairs = np.unique(np.column_stack([np.concatenate(a), np.concatenate(b)]), axis=0) if a else np.zeros((0, 2), np.int64)
        return [*out, pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], names=["a", "b", "key"])], pairs[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, heads = None, [], 0, {}
        for b in batches:
            for part, data in zip(b.column(0).to_pylist(), b.column(1)):
                if part != now:
                    if held:
                        yield from solve(np.concatenate(held), heads, True)[0]
                    now, held, size, heads = part, [], 0, {}
                held.append(np.frombuffer(data.as_py(), np.int64).reshape(-1, 2))
                size += len(held[-1])
                if size > most:
                    out, rest = solve(np.concatenate(held), heads, False)
                    yield from out
                    held, size = [rest], min(len(rest), most // 2)
        if held:
            yield from solve(np.concatenate(held), heads, True)[0]

    return run


def _packed(line: str, k: int) -> np.ndarray | None:
    """The sorted set of the line's shingles as integers, if its characters fit."""
    if k != 8 or len(line) < k:
        return None
    try:
        data = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return np.unique(np.ndarray((len(data) - k + 1,), np.uint64, data, 0, (1,)))


def _shared(x: np.ndarray, y: np.ndarray) -> float:
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def jaccard(a: str, b: str, k: int = K) -> float:
    """Of the sets of ``k``-character shingles; a shorter line is its own only one."""
    x, y = _packed(a, k), _packed(b, k)
    if x is not None and y is not None:
        return _shared(x, y)
    p, q = ({s[i : i + k] for i in range(max(1, len(s) - k + 1))} for s in (a, b))
    return len(p & q) / len(p | q)


def _verify(threshold: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [jaccard(x.as_py(), y.as_py(), k) >= threshold for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def _numbered(texts: list[str], k: int) -> tuple[list[np.ndarray], int]:
    """Each text's set of shingles, as numbers below the count of all."""
    packed = [_packed(t, k) for t in texts]
    if all(x is not None for x in packed):
        known, flat = np.unique(np.concatenate(packed), return_inverse=True)
        return np.split(flat, np.cumsum([len(x) for x in packed])[:-1]), len(known)
    number: dict[str, int] = {}
    sets = [np.array(sorted({number.setdefault(t[i : i + k], len(number)) for i in range(max(1, len(t) - k + 1))})) for t in texts]
    return sets, len(number)


def merge_block(texts: list[str], labels: list[int], threshold: float, k: int, key: int | None = None) -> list[tuple[int, int]]:
    """Links that connect what the lines' exact similarities connect beyond their labels: one for each line at most.

    With ``key``, a band that all lines share, lines that share an earlier band too are left to that one's block.
    """
    sets, n = _numbered(texts, k)
    keys = band_keys(texts, k) if key is not None and len(texts) > ALONE else None
    own = int((keys[0] == key).argmax()) if keys is not None else 0
    sizes, group = np.array([len(x) for x in sets]), np.array(labels)
    mark, out = np.zeros(n, bool), []
    for i in range(len(texts)):
        others = np.nonzero(group != group[i])[0]
        if keys is not None:
            others = others[(keys[others] == keys[i]).argmax(axis=1) == own]
        # the smaller set is at most the intersection, the larger at least the union
        others = others[np.minimum(sizes[others], sizes[i]) >= threshold * np.maximum(sizes[others], sizes[i])]
        if not len(others):
            continue
        mark[sets[i]] = True
        starts = np.cumsum(sizes[others]) - sizes[others]
        shared = np.add.reduceat(mark[np.concatenate([sets[j] for j in others])], starts, dtype=np.int64)
        mark[sets[i]] = False
        for j in others[shared >= threshold * (sizes[others] + sizes[i] - shared)]:
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                out.append((i, int(j)))
    return out


def _merge(threshold: float, k: int):
    """Rows sorted by (key, i, j) -> links; a task's rows may span batches."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = merge_block([r[5] for r in rows], [r[4] for r in rows], threshold, k, rows[0][0]) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([rows[i][3] for i, _ in found], pa.int64()), pa.array([rows[j][3] for _, j in found], pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][:3] != row[:3]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return run


def _lines(docs: DataFrame, text_col: str, *keys: str) -> DataFrame:
    return (
        docs.select(*keys, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "_line"))
        .where(F.col("_line").rlike(r"(?U)\S"))
        .select(*keys, "pos", F.xxhash64("_line").alias("line"), check("_line").alias("check"), "_line")
    )


def check(line: str) -> Column:
    """A second hash, of another seed."""
    return F.xxhash64(F.lit(1), F.col(line))


def links(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, k: int = K, small: int = SMALL, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Verified links ``(u, v)`` between hashes of lines, and ``(line, t)``, the lines that were compared."""
    size = int(str(docs.select(text_col)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bands = docs.select(text_col).mapInArrow(_banded(k, max(LEAST_PARTS, size // PART_BYTES if size < 1 << 60 else 0)), "part long, pairs binary")
    found = written(bands.repartition("part").sortWithinPartitions("part").mapInArrow(_candidates(small), "a long, b long, key long"), "candidates")
    pairs = found.where("a <> b").select("a", "b").distinct()
    wanted = written(found.select(F.explode(F.array("a", "b")).alias("w")).distinct(), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = written(_lines(docs, text_col).select("line", "_line").join(wanted, F.col("line") == F.col("w"), "left_semi").groupBy("line").agg(F.min("_line").alias("t")), "texts")
    left = texts.select(F.col("line").alias("la"), F.col("t").alias("ta"))
    right = texts.select(F.col("line").alias("lb"), F.col("t").alias("tb"))
    both = pairs.join(left, F.col("a") == F.col("la")).join(right, F.col("b") == F.col("lb")).select("a", "b", "ta", "tb")
    near = written(both.mapInArrow(_verify(threshold, k), "a long, b long, ok boolean").where("ok").select(F.col("a").alias("u"), F.col("b").alias("v")), "verified")

    large = found.where("key is not null").select("key", F.col("a").alias("line")).distinct()
    if large.isEmpty():
        return near, texts
    roots = components(near, "bands").select(F.col("u").alias("n"), F.col("v").alias("root"))
    labelled = written(large.join(roots, F.col("line") == F.col("n"), "left").select("key", "line", F.coalesce("root", "line").alias("label")), "labelled")
    split = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select(F.col("key").alias("sk"), F.ceil(F.col("n") / chunk).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("line"), F.col("k")).cast("int")
    dealt = (
        labelled.join(split, F.col("key") == F.col("sk"))
        .select("key", "line", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        .join(texts.select(F.col("line").alias("tl"), "t"), F.col("line") == F.col("tl"))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "line", "label", "t")
    )
    merged = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_merge(threshold, k), "u long, v long")
    return near.unionByName(merged), texts


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, k: int = K) -> DataFrame:
    """``docs`` with the text of the lines that stay, and ``n_lines`` and ``n_removed`` (non-blank lines)."""
    found, texts = links(docs, text_col, threshold, k)
    roots = components(found, "line-components")
    checks = texts.select(F.col("line").alias("_n"), check("t").alias("_c"))
    of_root = checks.withColumnsRenamed({"_n": "_rn", "_c": "_rc"})
    roots = roots.join(checks, F.col("u") == F.col("_n")).join(of_root, F.col("v") == F.col("_rn")).select(F.col("u").alias("_u"), F.col("_c").alias("_uc"), F.struct(F.col("v").alias("line"), F.col("_rc").alias("check")).alias("_root"))
    keyed = packed(docs, id_col, text_col)
    lines = _lines(keyed, "_text", "_k", "_id").select("_k", "_id", "pos", "line", "check")
    own = F.struct("line", "check")
    salt = F.pmod(F.xxhash64("_k", "pos"), F.lit(SALTS)).cast("int")
    classed = written(lines.join(roots, (F.col("line") == F.col("_u")) & (F.col("check") == F.col("_uc")), "left").select(F.struct("_id", "_k", "pos").alias("place"), F.coalesce("_root", own).alias("class"), salt.alias("salt")), "classes")
    kept = classed.groupBy("class").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    # a hot class is dealt to several tasks
    kept = kept.select(F.col("class").alias("_c"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    removed = classed.join(kept, (F.col("class") == F.col("_c")) & (F.col("salt") == F.col("_s"))).where("place <> first").groupBy(F.col("place._k").alias("_r")).agg(F.collect_set("place.pos").alias("_gone"))
    parts = F.split("_text", "\n")
    full = F.size(F.filter(parts, lambda x: x.rlike(r"(?U)\S")))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(gone, i)), "\n"))
    return keyed.join(removed, F.col("_k") == F.col("_r"), "left").select(
        *((text if c == text_col else F.col("_row").getField(c)).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")),
        F.when(F.col("_text").isNull(), 0).otherwise(full).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
    )
