"""Tables kept by key: in hash buckets that change one at a time, and as a bucketed set of seen keys."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import _fs

BUCKET = "_bucket"


class KeyedTable:
    """Parquet rows, one for each key, in a folder for each hash bucket of the key's first column.

    A change reads and rewrites the buckets that its keys fall into, by dynamic partition
    overwrite; the others keep their files. Keys are equal where their columns are equal or
    both null. The same change again changes nothing, so a replayed batch does no harm; a
    change that breaks off is to be made again, as some buckets may have it already.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _stored(self) -> DataFrame:
        fs, place = _fs(self.spark, self.path)
        fs.mkdirs(place)
        return self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(self.path)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = self._stored()
        return (stored if buckets is None else stored.where(F.col(BUCKET).isin(*buckets))).drop(BUCKET)

    def files(self) -> dict[int, set[str]]:
        """The file names of each bucket."""
        fs, place = _fs(self.spark, self.path)
        folders = [s.getPath() for s in fs.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(f"{BUCKET}=")] if fs.exists(place) else []
        return {int(f.getName().partition("=")[2]): {s.getPath().getName() for s in fs.listStatus(f)} for f in folders}

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the rows' keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def upsert(self, rows: DataFrame, gone: Column | None = None) -> list[int]:
        """Rows take the place of those of their key; where ``gone`` holds there is none after. Returns the buckets rewritten.

        ``rows`` has one row for each key.
        """
        touched = self.touched(rows)
        if touched:
            held = self.read(touched)
            same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys]
            kept = held.join(rows.select(*(F.col(k).alias(f"_new_{k}") for k in self.keys)), same, "left_anti")
            self.replace(kept.unionByName((rows if gone is None else rows.where(~gone)).select(*held.columns)), touched)
        return touched

    def replace(self, rows: DataFrame, touched: Sequence[int]) -> None:
        """``rows`` become all that these buckets hold."""
        before = self.files()
        # one file for a bucket, or more where it is large
        placed = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        after = self.files()
        fs, _ = _fs(self.spark, self.path)
        for k in touched:
            if k in before and before[k] == after.get(k):  # no row came: the bucket is empty now
                fs.delete(_fs(self.spark, f"{self.path}/{BUCKET}={k}")[1], True)


class SeenKeys:
    """A growing set of keys as a bucketed table, so that looking for unseen keys moves the new rows alone.

    The catalog entry is made anew in each session from the path; ``buckets`` must be
    those that the files were written with. Null keys are never seen.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.name = "seen_" + hashlib.md5(f"{path} {key} {buckets} {schema}".encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, new: DataFrame) -> DataFrame:
        """The rows of ``new`` whose key is not in the set."""
        return new.join(self.table().select(self.key), self.key, "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Append; each bucket gets one file."""
        rows.select(*self.table().columns).repartition(self.buckets, self.key).write.insertInto(self.name)
