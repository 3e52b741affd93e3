"""What the operators share: written tables, text helpers, distributed union-find."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: dict[str, str] = {}
_watching: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder is made; on a
    cluster that would be a folder of one machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="folkmoot-")
    return _own_dir[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and reread it.

    Survives lost executors, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folkmoot_path = path
    for made in _watching:
        made.append(out)
    return out


@contextmanager
def watched() -> Iterator[list[DataFrame]]:
    """The tables that :func:`written` makes in the block, for the caller to :func:`discard` once nothing reads them."""
    made: list[DataFrame] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching[:] = [m for m in _watching if m is not made]


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    path = getattr(df, "_folkmoot_path", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; JVM fast path for texts that are ASCII throughout."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def _key(id_col: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.to_json(F.struct(id_col.cast("string").alias("a"), F.xxhash64(text).alias("b"), F.length(text).alias("c")))))


def row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _text, _k)``: ``_k`` is never null, and equal for rows equal in id and text."""
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), _key(F.col(id_col), F.col(text_col)).alias("_k"))


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """As :func:`row_key`, with the whole row as ``_row``, so that no column of it can clash."""
    return df.select(F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), _key(F.col(id_col), F.col(text_col)).alias("_k"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col("_row").getField(c).alias(c) for c in columns))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    hung = edges.join(least, F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Distributed union-find over ``edges(u, v)``: alternate large-star and small-star.

    Returns ``(u, v)``: each node that is not the least of its component, with
    that least node. Rounds are logarithmic in the component sizes; each one is
    written to the shared folder. No group is ever gathered: the steps are a
    min-aggregation and a join that may be split where a node is hot.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = _checksum(now)
    while before[0]:
        then = written(_small_star(_large_star(now)), name)
        discard(now)
        now, after = then, _checksum(then)
        if after == before:
            break
        before = after
    return now


#: A key is heavy that has one row in so many; so there are no more heavy keys than this.
HEAVY = 1000


def heavy_or_light(rows: DataFrame, key: str, told: DataFrame, n_col: str) -> DataFrame:
    """``rows`` with the other columns of ``told``, which has a row for each value of ``key`` (null among them) and its number of rows.

    The at most ``HEAVY`` values that hold a thousandth of all rows each go out by
    broadcast, so their rows are not moved; the others join by shuffle, where no
    partition can be hot. Rows whose key ``told`` lacks are left out.
    """
    total = told.agg(F.sum(n_col)).first()[0] or 0
    own = [F.col(key).alias("_key"), *(c for c in told.columns if c not in (key, n_col))]
    is_heavy = F.col(n_col) * HEAVY >= total
    heavy, light = told.where(is_heavy).select(*own), told.where(~is_heavy).select(*own)
    same = F.col(key).eqNullSafe(F.col("_key"))
    by_broadcast = rows.join(F.broadcast(heavy), same).drop("_key")
    by_shuffle = rows.join(F.broadcast(heavy.select("_key")), same, "left_anti").join(light, same).drop("_key")
    return by_broadcast.unionByName(by_shuffle)
