"""Vector code compression: product quantisation in exact integers.

A component becomes ``floor(1024 * x)``, a vector is cut into ``PARTS`` equal parts, and each
part position has a codebook of ``ENTRIES`` entries, at first those parts of the vectors with
the smallest ids. A round sends the integer codebooks to the executors; Arrow batches take all
distances at once by ``|v|² - 2 v·c + |c|²`` (the products are exact int64 matrix products) and the
first least one; each task adds up the parts and counts of its entries, and a
grouped shuffle merges these sums. An entry becomes its parts' mean, floored; one without
parts stays. What reaches the driver is one row for each component of the codebooks.

int64 holds while no square can overflow; ``limbs`` of the greatest component tell. Beyond
that the same steps run in Python's integers, and sums are merged in ``LIMB``-bit pieces,
so results stay exact for any finite floats; an error that a long cannot hold is the
greatest long.

Edge cases: null vectors and those that hold null, NaN or infinite components are dropped;
shorter vectors count as if zeros followed, up to the longest one's width, rounded up to
whole parts (empty ones are all zeros); fewer vectors than entries give fewer entries; a
null id seeds last, repeated ids are each coded, and seed in the order of their components;
equal distances go to the lower index; an empty table gives no rows. Other columns are
never read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_or_light, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bits of the pieces in which sums are merged: 2**31 pieces' sum fits a long.
LIMB = 32
MOST = (1 << 63) - 1


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(_id, _v, _label)`` of the rows whose vector is whole and finite."""
    x = lambda c: c.cast("double")
    rows = df.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"), F.col(label_col).alias("_label"))
    return rows.where(F.coalesce(F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf"))), F.lit(False)))


def integers(values: np.ndarray, big: bool) -> np.ndarray:
    """``floor(1024 * x)``: int64, or Python's integers."""
    if not big:
        return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)
    # a double beyond 2**53 is whole already
    one = lambda x: int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)
    return np.array([one(float(x)) for x in values.ravel()], object).reshape(values.shape)


def padded(vectors: pa.Array, width: int, big: bool) -> np.ndarray:
    """The vectors as rows of integers, zeros after their ends."""
    n, sizes = len(vectors), pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((n, width), object if big else np.int64)
    if n and (sizes == width).all():
        return integers(flat.reshape(n, width), big)
    ends = np.cumsum(sizes)
    for i in range(n):
        out[i, : sizes[i]] = integers(flat[ends[i] - sizes[i] : ends[i]], big)
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each part, and its squared distance."""
    squares = (parts * parts).sum(axis=1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(axis=1)[None, :]
    at = squares.argmin(axis=1)
    return at, squares[np.arange(len(at)), at]


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], width: int, big: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the parts, their entries, the squared distances."""
    rows, size = padded(batch.column(1), width, big), width // PARTS
    for p, book in enumerate(books):
        parts = rows[:, p * size : (p + 1) * size]
        yield parts, *nearest(parts, book)


def _pieces(n: int, limbs: int) -> list[int]:
    """``n`` in ``limbs`` pieces of ``LIMB`` bits, the last one signed."""
    out = [n >> (LIMB * k) & ((1 << LIMB) - 1) for k in range(limbs - 1)]
    return [*out, n >> (LIMB * (limbs - 1))]


def _round(rows: DataFrame, books: list[np.ndarray], width: int, limbs: int, big: bool) -> list[np.ndarray]:
    """The codebooks after one round."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    size = width // PARTS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        total = [np.zeros((len(b), size), object) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in (b for b in batches if b.num_rows):
            for p, (parts, at, _) in enumerate(_assigned(batch, books, width, big)):
                used, starts, n = np.unique(np.sort(at), return_index=True, return_counts=True)
                if size:
                    total[p][used] += np.add.reduceat(parts[np.argsort(at, kind="stable")], starts)  # Python's integers: no sum of batches can overflow
                count[p][used] += n
        for p, n in enumerate(count):
            used = np.nonzero(n)[0]
            told = [_pieces(int(x), limbs) for e in used for x in total[p][e]]
            columns = [np.full(len(used) * size, p, np.int32), np.repeat(used, size).astype(np.int32), np.tile(np.arange(size, dtype=np.int32), len(used)), np.repeat(n[used], size)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(pa.array([x[k] for x in told], pa.int64()) for k in range(limbs))], names=["part", "entry", "pos", "n", *(f"s{k}" for k in range(limbs))])

    kind = "part int, entry int, pos int, n long, " + ", ".join(f"s{k} long" for k in range(limbs))
    # decimal sums: the pieces of any number of tasks
    merged = rows.select("_id", "_v").mapInArrow(sums, kind).groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), *(F.sum(F.col(f"s{k}").cast("decimal(20,0)")).alias(f"s{k}") for k in range(limbs)))
    out = [b.copy() for b in books]
    for r in merged.collect():  # at most one row for each component of the codebooks
        out[r["part"]][r["entry"], r["pos"]] = sum(int(r[f"s{k}"]) << (LIMB * k) for k in range(limbs)) // r["n"]
    sent.unpersist()
    return out


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def train(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[list[np.ndarray], int, bool]:
    """The final codebooks of :func:`usable` rows, the width, and whether int64 is too narrow."""
    told = rows.agg(F.max(F.size("_v")).alias("width"), F.max(F.array_max(F.transform("_v", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    width = -(-(told["width"] or 0) // PARTS) * PARTS
    most = int(told["most"] or 0) * SCALE + SCALE
    # all squares, products and their sums over the parts stay below 4 * width * most**2, a batch's sums below its rows * most
    big = 4 * max(width, 1) * most * most > MOST
    limbs = 1 if most.bit_length() <= LIMB else -(-(most.bit_length() + 40) // LIMB)  # a task's sums: up to 2**40 rows beyond LIMB
    first = rows.select("_id", "_v").orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).toArrow()  # bounded: the codebooks' size
    seeds = padded(first.column("_v").combine_chunks(), width, big) if first.num_rows else np.zeros((0, width), np.int64)
    books = [np.ascontiguousarray(x) for x in np.split(seeds, PARTS, axis=1)]
    for _ in range(rounds if len(seeds) else 0):
        books = _round(rows, books, width, limbs, big)
    return books, width, big


def encode(rows: DataFrame, books: list[np.ndarray], width: int, big: bool) -> DataFrame:
    """``(_id, _label, code, error)`` of each row."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            found = [(at, d) for _, at, d in _assigned(batch, sent.value, width, big)]
            errors = np.minimum(sum(d for _, d in found), MOST).astype(np.int64)
            codes = [bytes(x).hex() for x in np.stack([at for at, _ in found], axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["_id", "_label", "code", "error"])

    kind = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_label")}
    return rows.mapInArrow(run, f"_id {kind['_id']}, _label {kind['_label']}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of each usable row."""
    rows = usable(vectors, id_col, vector_col, label_col)
    books, width, big = train(rows)
    coded = written(encode(rows, books, width, big), "codes")
    whole = lambda c: F.least(c, F.lit(MOST).cast("decimal(38,0)")).cast("long")
    per_label = coded.groupBy("_label").agg(F.count("*").alias("n"), whole(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    joined = heavy_or_light(coded, "_label", written(per_label, "label_errors"), "n")
    return joined.select(F.col("_id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
