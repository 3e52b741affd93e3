"""SimHash near-duplicates: fingerprints linked through BK-trees.

Fingerprints are dealt to shards; in each a BK-tree (children keyed by the integer
Hamming distance to the parent) is grown and searched by all fingerprints of the
shard, and only edges within the radius of a query's distance are followed. All
trees of a task grow and are searched level by level together. Broadcasting the
trees would send the fingerprints of all documents through the driver, so the shards
travel by shuffle instead. A shard of over ``chunk`` fingerprints is dealt as pairs of
chunks, the tree of one being searched by the other; none is gathered whole. Two
ways of dealing:

* exact, for a small radius: of ``radius + agree`` blocks of bits, fingerprints that
  differ in at most ``radius`` bits agree on ``agree`` blocks, so the values of each
  choice of ``agree`` blocks are shards;
* sampled, for a wide radius: fixed random sets of bits, each value a shard; as many
  sets as give ``RECALL`` at the distance ``NEAR``, ``1 - (1 - (1 - d / bits) ** width) ** tables``
  at ``d`` differing bits.

``agree`` and the width grow with the number of fingerprints, so that the mean shard
stays within ``chunk``.

The filtering stage takes the components of the sampled way as candidates only:
within each, texts are compared by the exact Jaccard similarity of their word
shingles (as 64-bit hashes). Large components are dealt as pairs of blocks.

Edge cases: null, empty or blank text has fingerprint zero and links like any
other; texts of fewer words than a shingle are one shingle; null ids are
ignored for the component id (null if a component has no other); repeated rows
and equal texts are one node; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, packed, unpacked, written

#: The contract's fingerprint: 64 bits over four words.
WORDS, RADIUS = 4, 4
#: The filtering stage's: 256 bits over five words. A Jaccard similarity of 0.8 is an angle of 0.475, 39 bits of 256; 50 is two deviations more.
WIDE_BITS, WIDE_WORDS, WIDE_RADIUS = 256, 5, 50
CHUNK, SAMPLED, NEAR, RECALL = 1024, 12, 39, 0.997
#: Queries that are searched together.
ASKED = 4096
#: The similarity of the filtering stage's duplicates. Candidates that are compared together: texts, and bytes of their shingles.
SIMILAR, MEMBERS, BLOCK_BYTES = 0.8, 512, 16 << 20
#: Contents or shards that are broadcast at most, of 16 bytes each.
BROADCAST_ROWS = 200_000


def _digests(bits: int):
    if bits == 64:
        return lambda s: xxhash.xxh64_digest(s, 42)
    return lambda s: xxhash.xxh3_128_digest(s, 42) + xxhash.xxh3_128_digest(s, 43)


def fingerprint(text: str | None, words: int = WORDS, bits: int = 64) -> bytes:
    """SimHash of the text's word shingles, most significant bit first."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return bytes(bits // 8)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else iter([b" ".join(parts)])
    n, counts, digest = max(1, len(parts) - words + 1), np.zeros(bits, np.int64), _digests(bits)
    while block := b"".join(map(digest, islice(shingles, 1 << 14))):  # bounded memory for very long texts
        counts += np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, bits // 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = 64) -> DataFrame:
    """``(_id, _fp)`` for each row of ``docs``; ``_fp`` binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(x.as_py(), words, bits) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["_id", "_fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, _fp binary")


def _as_words(column, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, bits // 64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


class Forest:
    """BK-trees over rows of uint64, grown a level at a time; ``tree`` numbers each row's tree.

    The first row of a tree is its root; a node's children differ in their distance to
    it, and each heads the rows at that distance, in their order. So all nodes below a
    node are later rows.
    """

    def __init__(self, fp: np.ndarray, tree: np.ndarray):
        self.fp, self.keys = fp, 64 * fp.shape[1] + 1
        members = np.argsort(tree, kind="stable")
        group = tree[members]
        nodes, edges, first = [], [], np.ones(len(members), bool)
        first[1:] = group[1:] != group[:-1]
        self.names, self.roots = group[first], members[first]
        while not first.all():
            heads = members[first][np.cumsum(first) - 1][~first]
            members = members[~first]
            far = _distance(fp[members], fp[heads]).astype(np.int64)
            order = np.lexsort((far, heads))  # stable: rows stay in their order
            members, heads, far = members[order], heads[order], far[order]
            first = np.ones(len(members), bool)
            first[1:] = (heads[1:] != heads[:-1]) | (far[1:] != far[:-1])
            nodes.append(members[first])
            edges.append(heads[first] * self.keys + far[first])
        edge, node = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (edges, nodes))
        order = np.argsort(edge)
        #: By parent and distance: the edges, and the children they lead to.
        self.edge, self.node = edge[order], node[order]
        self.followed = self.skipped = 0

    def search(self, asked: np.ndarray, tree: np.ndarray, radius: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of the trees and positions in ``asked`` within ``radius`` of each other, each asked in its ``tree``.

        Where ``own`` is not negative it is the query's row here, and only earlier rows are looked for.
        """
        at = np.minimum(np.searchsorted(self.names, tree), max(len(self.names) - 1, 0))
        known = np.nonzero(self.names[at] == tree)[0] if len(self.names) else np.zeros(0, np.int64)
        for low in range(0, len(known), ASKED):
            q = known[low : low + ASKED]
            v = self.roots[at[q]]
            while len(q):
                keep = (own[q] < 0) | (v < own[q])
                q, v = q[keep], v[keep]
                far = _distance(asked[q], self.fp[v]).astype(np.int64)
                hit = far <= radius
                yield v[hit], q[hit]
                lo = np.searchsorted(self.edge, v * self.keys + np.maximum(far - radius, 0))
                hi = np.searchsorted(self.edge, v * self.keys + np.minimum(far + radius, self.keys - 1), "right")
                several = hi - lo
                every = np.searchsorted(self.edge, (v + 1) * self.keys) - np.searchsorted(self.edge, v * self.keys)
                self.followed += int(several.sum())
                self.skipped += int((every - several).sum())
                q, lo = np.repeat(q, several), np.repeat(lo - np.cumsum(several) + several, several)
                v = self.node[lo + np.arange(len(lo))]


def _labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the first member of its component in one shard."""
    label = np.arange(n)
    while True:
        before, low = label.copy(), np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _search(radius: int, bits: int):
    """Batches sorted by task -> star edges; a task may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            now = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b], rest.schema)])
            task = np.column_stack([now[n].to_numpy() for n in ("task", "i", "j")])
            change = np.nonzero((task[1:] != task[:-1]).any(axis=1))[0] + 1
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield _solve_table(now.slice(0, cut), task[:cut])
            rest = now.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield _solve_table(rest, np.column_stack([rest[n].to_numpy() for n in ("task", "i", "j")]))

    def _solve_table(t: pa.Table, task: np.ndarray) -> pa.RecordBatch:
        raw, side = t["_fp"].combine_chunks(), t["side"].to_numpy()
        fp, own = _as_words(raw, bits), task[:, 1] == task[:, 2]
        number = np.cumsum(np.append(0, (task[1:] != task[:-1]).any(axis=1)))
        grown, asked = np.nonzero(own | (side == 0))[0], np.nonzero(own | (side == 1))[0]
        forest = Forest(fp[grown], number[grown])
        row = np.where(own[asked], np.searchsorted(grown, asked), -1)
        pairs = [(grown[i], asked[j]) for i, j in forest.search(fp[asked], number[asked], radius, row)]
        label = _labels(len(fp), *(np.concatenate(x) for x in zip(*pairs))) if pairs else np.arange(len(fp))
        moved = np.nonzero(label != np.arange(len(fp)))[0]
        return pa.RecordBatch.from_arrays([raw.take(pa.array(moved)), raw.take(pa.array(label[moved]))], names=["u", "v"])

    return run


def takes(n: int, radius: int, bits: int, chunk: int) -> list[np.ndarray]:
    """The sets of bits whose values are the shards of ``n`` fingerprints."""
    need = math.log2(max(n, 1) / chunk) if n > chunk else 0.0
    if radius < 8:
        agree = next(k for k in range(1, 99) if bits * k // (radius + k) >= need)
        cuts = np.linspace(0, bits, radius + agree + 1).astype(int)
        blocks = [np.arange(a, b) for a, b in zip(cuts, cuts[1:])]
        return [np.concatenate(c) for c in combinations(blocks, agree)]
    width = max(SAMPLED, math.ceil(need))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - NEAR / bits) ** width))
    draw = np.random.default_rng(7)
    return [np.sort(draw.choice(bits, width, replace=False)) for _ in range(tables)]


def _deal(takes: list[np.ndarray], bits: int):
    """Each fingerprint with the number of each shard that it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0)
            on = np.unpackbits(_as_words(raw, bits).view(np.uint8), axis=1).astype(np.int64)
            for k, take in enumerate(takes):
                shard = on[:, take] @ (1 << np.arange(len(take))) * len(takes) + k
                yield pa.RecordBatch.from_arrays([raw, pa.array(shard)], names=["_fp", "shard"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, bits: int = 64, chunk: int = CHUNK) -> DataFrame:
    """Star edges ``(u, v)`` of distinct ``_fp`` that connect what links connect."""
    chosen = takes(distinct.count(), radius, bits, chunk)
    dealt = distinct.mapInArrow(_deal(chosen, bits), "_fp binary, shard long")
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1").select(F.col("shard").alias("s"), F.ceil(F.col("n") / chunk).cast("int").alias("k"))
    if len(chosen) << max(map(len, chosen)) <= BROADCAST_ROWS:  # there are no more shards
        sizes = F.broadcast(sizes)
    tasks = (
        dealt.join(sizes, F.col("shard") == F.col("s"))
        .withColumn("own", F.pmod(F.xxhash64("_fp"), F.col("k")).cast("int"))
        .select("_fp", "shard", "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        .select(F.col("shard").alias("task"), F.least("own", "other").cast("long").alias("i"), F.greatest("own", "other").cast("long").alias("j"), (F.col("own") > F.col("other")).cast("long").alias("side"), "_fp")
    )
    return tasks.repartition("task", "i", "j").sortWithinPartitions("task", "i", "j").mapInArrow(_search(radius, bits), "u binary, v binary").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, bits: int = 64, chunk: int = CHUNK) -> DataFrame:
    """``(id, fingerprint, component_id)`` for each row; component: least id reachable."""
    prints = written(fingerprints(docs, id_col, text_col, words, bits), "prints")
    least = written(prints.groupBy("_fp").agg(F.min("_id").alias("first")), "fingerprints")
    roots = components(links(least.select("_fp"), radius, bits, chunk))
    member = least.join(roots, F.col("_fp") == F.col("u"), "left").select("_fp", "first", F.coalesce("v", "_fp").alias("root"))
    top = member.groupBy("root").agg(F.min("first").alias("component_id"))
    label = member.join(top, "root").select(F.col("_fp").alias("_f"), "component_id")
    return prints.join(label, F.col("_fp") == F.col("_f")).select(F.col("_id").alias(id_col), F.lower(F.hex("_fp")).alias("fingerprint"), "component_id")


def _shingles(text: str | None, words: int) -> bytes:
    """The distinct 64-bit hashes of the word shingles, packed."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return b""
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else iter([b" ".join(parts)])
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), np.uint64)).tobytes()


def _named(words: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            prints = pa.array([fingerprint(t, words, bits) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), prints, pa.array(map(_content, texts), pa.binary())], names=["_id", "_fp", "_h"])

    return run


def _content(text: str | None) -> bytes:
    """Equal for texts of the same words."""
    return xxhash.xxh3_128_digest(b" ".join((text or "").encode("utf-8", "replace").lower().split()))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(map(_content, b.column(0).to_pylist()), pa.binary()), b.column(0)], names=["_h", "_text"])


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((_shingles(t, words) for t in b.column(1).to_pylist()), pa.binary())], names=["h", "shingles"])

    return run


def similar(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links that connect what Jaccard similarities of at least ``threshold`` connect."""
    sizes, group = np.array([len(x) for x in sets]), np.arange(len(sets))
    known, number = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum(sizes)[:-1]
    sets, mark, out = np.split(number, cuts), np.zeros(len(known), bool), []
    for i in range(len(sets)):
        others = np.nonzero((group != group[i]) & (sizes > 0))[0]
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


def _verified(threshold: float):
    """Rows sorted by (root, i, j) -> links; a block's rows may span batches."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = similar([np.frombuffer(r[4], np.uint64) for r in rows], threshold) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([rows[i][3] for i, _ in found], pa.binary()), pa.array([rows[j][3] for _, j in found], pa.binary())], names=["u", "v"])

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


def verified_links(docs: DataFrame, nodes: DataFrame, text_col: str, words: int, threshold: float, members: int = MEMBERS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links ``(u, v)`` of contents, within each ``root`` of ``nodes(_h, root)``, that connect what exact similarities connect."""
    several = nodes.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select(F.col("root").alias("r"))
    asked = written(nodes.join(several, F.col("root") == F.col("r"), "left_semi").select(F.col("_h").alias("w"), "root"), "asked")
    wanted = asked.select("w")
    texts = docs.select(F.col(text_col).alias("_text")).mapInArrow(_contents, "_h binary, _text string")
    texts = texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, F.col("_h") == F.col("w"), "left_semi").groupBy("_h").agg(F.min("_text").alias("t"))
    sets = written(texts.mapInArrow(_sets(words), "h binary, shingles binary"), "shingles")
    held = written(asked.join(sets, F.col("w") == F.col("h")).select("root", "h", "shingles"), "members")
    blocks = F.ceil(F.greatest(F.col("n") / members, F.col("size") / block_bytes)).cast("int")
    split = held.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("size")).select(F.col("root").alias("sr"), blocks.alias("k"))
    dealt = (
        held.join(split, F.col("root") == F.col("sr"))
        .withColumn("own", F.pmod(F.xxhash64("h"), F.col("k")).cast("int"))
        .select("root", "h", "shingles", "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "h", "shingles")
    )
    return dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(_verified(threshold), "u binary, v binary").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WIDE_WORDS, radius: int = WIDE_RADIUS, bits: int = WIDE_BITS, threshold: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least id.

    Fingerprints only give groups of candidates; what groups in the end are
    Jaccard similarities of at least ``threshold`` of the word shingles.
    Rows with a null id stay (they cannot be told apart); of rows that repeat an
    id one stays.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    prints = written(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(_named(words, bits), f"_id {kind}, _fp binary, _h binary"), "prints")
    least = written(prints.groupBy("_h", "_fp").agg(F.min("_id").alias("first")), "contents")
    near = components(links(written(least.select("_fp").distinct(), "fingerprints"), radius, bits))
    nodes = written(least.join(near, F.col("_fp") == F.col("u"), "left").select("_h", "first", F.coalesce("v", "_fp").alias("root")), "candidates")
    roots = components(verified_links(docs, nodes, text_col, words, threshold), "similar")
    member = nodes.select("_h", "first").join(roots, F.col("_h") == F.col("u"), "left").select("first", F.coalesce("v", "_h").alias("root"))
    kept = member.groupBy("root").agg(F.min("first").alias("_kept")).where("_kept is not null").select("_kept").distinct()
    rows = packed(docs, id_col, text_col)
    named = rows.where(F.col("_id").isNotNull()).dropDuplicates(["_id"]).join(kept, F.col("_id") == F.col("_kept"), "left_semi")
    return unpacked(named.unionByName(rows.where(F.col("_id").isNull())), docs.columns)
