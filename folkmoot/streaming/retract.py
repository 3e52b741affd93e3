"""Per-key aggregates kept up to date where contributions come, change and vanish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.keyed import KeyedTable


class Aggregates:
    """What each source (a meeting) contributes to each key, and the aggregates of the keys over all sources.

    A least or greatest value cannot be taken back from itself, so contributions are kept. A
    batch changes those of its keys, and the aggregates of the same buckets are made
    anew from them; both tables have their buckets by the key, so nothing else is read or moved.
    A source that vanishes gives its place back; a key without sources has no row. A batch
    that is applied again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, source: str, contributions: str, results: str, aggregates: Sequence[Column], buckets: int = 64):
        self.key, self.source, self.aggregates = key, source, list(aggregates)
        self.contributions = KeyedTable(spark, f"{path}/contributions", contributions, [key, source], buckets)
        self.results = KeyedTable(spark, f"{path}/results", results, [key], buckets)

    def apply(self, batch: DataFrame, gone: str = "gone") -> list[int]:
        """``batch``: contributions with a boolean ``gone``, one row for each key and source. Returns the buckets rewritten."""
        touched = self.contributions.upsert(batch, F.coalesce(F.col(gone), F.lit(False)))
        if touched:
            self.results.replace(self.contributions.read(touched).groupBy(self.key).agg(*self.aggregates), touched)
        return touched

    def read(self) -> DataFrame:
        return self.results.read()
