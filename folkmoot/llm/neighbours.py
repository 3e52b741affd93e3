"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``m`` Gaussian projections cut into slots of width
``w``. A query looks into its own bucket and into perturbed ones, in order of
the estimated chance that a neighbour fell there: for each projection the squared
distance to the slot's lower or upper border is the cost of moving by one, and
sets of moves are drawn in order of their summed costs from a heap. Candidates
of all tables are ranked by exact distance in double precision.

Slots are ``WIDTH`` times the median distance of at most ``SAMPLE`` vectors (those of the least
id hashes, without copies) wide. The k-th distance above zero of ``ASKED`` of these among all rows
is measured, and its quantile ``HIGH`` taken. ``m`` is the greatest number, up to half the
binary logarithm of n, for which a simulation at that distance finds a neighbour with a chance of ``AIM``
or more. Every row is indexed. Buckets of over
``chunk`` rows are dealt as chunks, each of which meets all probes of the
bucket; within a bucket only each query's ``k`` best go on. A query for which the tables
hold fewer than ``k`` candidates, or whose ``k``-th lies beyond the distance up to which
that chance is ``AIM``, is answered by an exact scan of all rows, which takes as many
queries along as ``SENT`` bytes hold (or ``block``).

Edge cases: rows with a null id, a null, zero or empty vector, null or
non-finite components, or another length than the most frequent take no part;
of rows that repeat an id the one of the least vector counts; distances whose squares
overflow are scaled first, and places beyond the range of slots share the last one; ties go to the smaller id; fewer than ``k``
others give as many rows; an empty table gives none; other columns are never read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

NEAREST, TABLES, PROBES_A_PROJECTION, WIDTH, AIM = 10, 4, 8, 1.42, 0.96
SAMPLE, CHUNK, FLUSH = 1000, 4096, 200_000
#: Bytes of open queries that are broadcast together: one scan of all vectors answers them.
SENT = 64 << 20
ASKED, HIGH = 64, 0.95


def valid(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0), F.lit(False))


def probe_order(fraction: np.ndarray, most: int) -> list[np.ndarray]:
    """Slot offsets in the order of their estimated success, the own bucket first."""
    m = len(fraction)
    cost = np.concatenate([fraction**2, (1 - fraction) ** 2])
    order = np.argsort(cost, kind="stable")
    cost, moved, step = cost[order], order % m, np.where(order < m, -1, 1)
    out, heap = [np.zeros(m, np.int64)], [(cost[0], (0,))]
    while heap and len(out) < most:
        c, s = heapq.heappop(heap)
        last = s[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], (*s[:-1], last + 1)))
            heapq.heappush(heap, (c + cost[last + 1], (*s, last + 1)))
        at = moved[list(s)]
        if len(set(at.tolist())) == len(s):
            v = np.zeros(m, np.int64)
            v[at] = step[list(s)]
            out.append(v)
    return out


def chance(m: int, spread: float, probes: int, tables: int, trials: int = 200) -> float:
    """Simulated chance that one of the tables' probes meets a vector whose projections differ by ``spread`` slots."""
    rng, hits = np.random.default_rng(3), 0
    for _ in range(trials):
        place = rng.random(m)
        moved = np.floor(place + rng.normal(0, spread, m))
        hits += any((v == moved).all() for v in probe_order(place, probes))
    return 1 - (1 - hits / trials) ** tables


def fit(sample: np.ndarray, near: float, n: int, tables: int) -> tuple[int, float, float]:
    """Number of projections and width of the slots for ``n`` rows like the (distinct) sample, and the distance up to which neighbours are found with a chance of ``AIM``."""
    if len(sample) < 2:
        return 2, 1.0, 0.0
    with np.errstate(over="ignore", invalid="ignore"):
        squares = (sample**2).sum(axis=1)
        apart = squares[:, None] + squares[None] - 2 * sample @ sample.T
        gaps = np.sqrt(np.maximum(apart[np.triu_indices(len(sample), 1)], 0))
    gaps = gaps[np.isfinite(gaps)]
    width = (WIDTH * float(np.median(gaps)) if len(gaps) else 0.0) or 1.0
    found = lambda m, far: chance(m, far / width, PROBES_A_PROJECTION * m, tables) >= AIM
    m = max(2, round(math.log2(n + 1) / 2))
    while m > 2 and not found(m, near):
        m -= 1
    low, high = (near, 4 * near + width) if found(m, near) else (0.0, near)
    for _ in range(6):
        middle = (low + high) / 2
        low, high = (middle, high) if found(m, middle) else (low, middle)
    return m, width, low


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, along the last axis; scaled where the squares overflow."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = a - b
        out = np.sqrt((gap * gap).sum(axis=-1))
        over = ~np.isfinite(out)
        if over.any():
            most = np.abs(gap[over]).max(axis=-1)
            out[over] = most * np.sqrt(((gap[over] / most[:, None]) ** 2).sum(axis=-1))
    return np.where(np.isnan(out), np.inf, out)


def slots(places: np.ndarray) -> np.ndarray:
    return np.clip(np.nan_to_num(np.floor(places), nan=0.0), -(2.0**62), 2.0**62)


class Index:
    """The projections of all tables; fitted by width and dimension alone."""

    def __init__(self, dimension: int, m: int, width: float, tables: int = TABLES, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.m, self.tables = m, tables
        self.projections = rng.normal(size=(dimension, m * tables)) / width
        self.shift = rng.random(m * tables)
        self.factors = rng.integers(1, 1 << 62, m, dtype=np.int64) | 1

    def places(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return (x @ self.projections + self.shift).reshape(len(x), self.tables, self.m)

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """One number for the table (second last axis) and the slots (last axis)."""
        with np.errstate(over="ignore"):
            return (slots.astype(np.int64) * self.factors).sum(axis=-1) * self.tables + np.arange(self.tables)


def _vectors(column, kind: str) -> np.ndarray:
    """Packed vectors of float32 or float64, in double precision."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(float) if len(column) else np.zeros((0, 0))


def _hashed(index: Index, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                key = index.keys(slots(index.places(_vectors(b.column(1), kind))))
                at = pa.array(np.repeat(np.arange(len(b)), index.tables))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), b.column(0).take(at), b.column(1).take(at)], names=["bucket", "id", "v"])

    return run


def _probed(index: Index, most: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at = [], []
            for i, place in enumerate(index.places(_vectors(b.column(1), kind))) if len(b) else ():
                own = slots(place)
                within = np.clip(np.nan_to_num(place - own), 0.0, 1.0)
                for t in range(index.tables):
                    moves = np.array(probe_order(within[t], most)) + own[t]
                    with np.errstate(over="ignore"):
                        keys.append((moves.astype(np.int64) * index.factors).sum(axis=-1) * index.tables + t)
                    at.append(np.full(len(moves), i))
            if keys:
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), b.column(0).take(at), b.column(1).take(at)], names=["bucket", "id", "v"])

    return run


class _Best:
    """The k nearest so far of each query."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, {}, 0

    def add(self, queries: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        for lo in range(0, len(ids), 1024):
            part, part_ids = v[lo : lo + 1024], ids[lo : lo + 1024]
            for j in range(len(queries)):
                far = distance(part, q[j])
                other = part_ids != queries[j]
                self._merge(int(queries[j]), far[other], part_ids[other])

    def _merge(self, query: int, far: np.ndarray, ids: np.ndarray) -> None:
        if query in self.held:
            a, b = self.held[query]
            if len(a) == self.k:
                near = far <= a[-1]
                far, ids = far[near], ids[near]
                if not len(far):
                    return
            far, ids = np.concatenate([a, far]), np.concatenate([b, ids])
            _, first = np.unique(ids, return_index=True)
            far, ids = far[first], ids[first]
        else:
            self.size += self.k
        order = np.lexsort((ids, far))[: self.k]
        self.held[query] = far[order], ids[order]

    def flush(self) -> pa.RecordBatch:
        rows = [(np.full(len(i), q), i, f) for q, (f, i) in self.held.items()]
        self.held, self.size = {}, 0
        cols = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])


def _ranked(k: int, kind: str):
    """Rows sorted by bucket and chunk, probes first -> each query's best of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, now, queries, q, q_ids, q_vecs = _Best(k), None, None, None, [], []
        for b in batches:
            if not len(b):
                continue
            task = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()])
            ids, v = b.column(3).to_numpy(), _vectors(b.column(4), kind)
            cuts = np.nonzero((task[1:] != task[:-1]).any(axis=1))[0] + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(task)]):
                group = (int(task[lo, 0]), int(task[lo, 1]))
                if group != now:
                    now, queries, q_ids, q_vecs = group, None, [], []
                if task[lo, 2] == 0:
                    q_ids.append(ids[lo:hi])
                    q_vecs.append(v[lo:hi])
                elif q_ids:
                    if queries is None:
                        queries, q = np.concatenate(q_ids), np.concatenate(q_vecs)
                    best.add(queries, q, ids[lo:hi], v[lo:hi])
                if best.size > FLUSH:
                    yield best.flush()
        yield best.flush()

    return run


def _scan(sent, k: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (queries, q), best = sent.value, _Best(k)
        for b in batches:
            if len(b):
                best.add(queries, q, b.column(0).to_numpy(), _vectors(b.column(1), kind))
        yield best.flush()

    return run


def _kth(q: np.ndarray, k: int, kind: str):
    """Rows -> each query's ``k`` least distances above zero, equal ones (copies) once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0)] * len(q)
        for b in batches:
            v = _vectors(b.column(1), kind)
            for lo in range(0, len(b), 1024):
                for j in range(len(q)):
                    far = np.unique(np.concatenate([held[j], distance(v[lo : lo + 1024], q[j])]))
                    held[j] = far[far > 0][:k]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q)), [len(x) for x in held])), pa.array(np.concatenate(held) if held else np.zeros(0))], names=["q", "far"])

    return run


def neighbour_distance(rows: DataFrame, q: np.ndarray, k: int, kind: str = "f8") -> float:
    """A high quantile of the distances from the vectors ``q`` to their k-th neighbours among all rows."""
    own = Window.partitionBy("q").orderBy("far")
    least = rows.mapInArrow(_kth(q, k, kind), "q long, far double").distinct().withColumn("r", F.row_number().over(own)).where(F.col("r") <= k)
    far = [r["far"] for r in least.groupBy("q").agg(F.max("far").alias("far")).collect()]  # at most ASKED rows
    return float(np.quantile(far, HIGH)) if far else 0.0


def _top(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def as_bytes(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.array(x.as_py(), kind).tobytes() for x in b.column(1)], pa.binary())], names=["id", "v"])

    return run


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, tables: int = TABLES, chunk: int = CHUNK, block: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row for which ``is_query`` (over the column ``id``) holds."""
    spark = vectors.sparkSession
    # floats travel as they are; all is computed in double precision
    element = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    kind = {"float": "f4", "double": "f8"}[element]
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v")).where(F.col("id").isNotNull() & valid(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension = common["d"]
    rows = written(rows.where(F.size("v") == dimension).groupBy("id").agg(F.min("v").alias("v")).mapInArrow(as_bytes(kind), "id long, v binary"), "vectors")
    n = rows.count()
    # of large tables only twice as many rows, by a bound on the hash, are looked at
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
    few = rows.where(place < F.lit(max(1, (2 * SAMPLE << 31) // n))) if n > 4 * SAMPLE else rows
    sample = _vectors(few.orderBy(place, "id").limit(SAMPLE).select("v").toArrow()["v"], kind)  # at most SAMPLE rows
    sample = sample[np.sort(np.unique(sample, axis=0, return_index=True)[1])]
    m, width, sure = fit(sample, neighbour_distance(rows, sample[:ASKED], k, kind), n, tables)
    index = Index(dimension, m, width, tables)

    hashed = rows.mapInArrow(_hashed(index, kind), "bucket long, id long, v binary")
    large = hashed.groupBy("bucket").agg(F.count("*").alias("c")).where(F.col("c") > chunk).select(F.col("bucket").alias("lb"), F.ceil(F.col("c") / chunk).cast("long").alias("chunks"))
    chunks = F.coalesce("chunks", F.lit(1))
    held = hashed.join(large, F.col("bucket") == F.col("lb"), "left").select("bucket", F.pmod(F.xxhash64("id"), chunks).alias("chunk"), F.lit(1).cast("long").alias("side"), "id", "v")
    asked = rows.where(is_query)
    probed = asked.mapInArrow(_probed(index, PROBES_A_PROJECTION * index.m, kind), "bucket long, id long, v binary")
    probed = probed.join(large, F.col("bucket") == F.col("lb"), "left").select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), F.lit(0).cast("long").alias("side"), "id", "v")
    met = probed.unionByName(held).repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", "side")
    found = written(_top(met.mapInArrow(_ranked(k, kind), "query_id long, vec_id long, score double"), k), "neighbours")

    counts = found.groupBy("query_id").agg(F.count("*").alias("c"), F.max("score").alias("far")).where((F.col("c") >= min(k, n - 1)) & (F.col("far") <= sure)).select(F.col("query_id").alias("done"))
    open_ = written(asked.join(counts, F.col("id") == F.col("done"), "left_anti"), "open")
    left, after = open_.count(), None
    out = found.join(open_.select(F.col("id").alias("asked")), F.col("query_id") == F.col("asked"), "left_anti") if left else found
    block = block or max(1, SENT // (8 * dimension + 8))
    while left > 0:  # in order of the ids; some 100,000 queries of 100 dimensions take one scan
        part = open_.where(F.col("id") > after) if after is not None else open_
        some = part.orderBy("id").limit(block).toArrow()
        ids = some["id"].to_numpy()
        sent = spark.sparkContext.broadcast((ids, _vectors(some["v"], kind)))
        exact = rows.mapInArrow(_scan(sent, k, kind), "query_id long, vec_id long, score double")
        out = out.unionByName(exact.select("query_id", F.lit(0).alias("rank"), "vec_id", "score"))
        left, after = left - len(ids), int(ids[-1])
    return out if out is found else _top(out.select("query_id", "vec_id", "score"), k)
