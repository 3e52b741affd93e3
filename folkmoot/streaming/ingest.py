"""Incremental ingestion: new page files stream in, keyed tables are updated batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import first_of_each
from ..sources.keyed import KeyedTable

FILES = "path string, modificationTime timestamp, length long, content binary"


def new_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """A stream of the files that arrive below ``folder``."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("modificationTime").alias("arrived"), F.try_validate_utf8(F.col("content").cast("string")).alias("html"))


def upsert_stream(stream: DataFrame, table: str, key: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, order: str = "arrived", buckets: int = 64) -> StreamingQuery:
    """Keep ``table`` keyed by ``key``; of a batch's rows of one key the last holds. Replayed batches change nothing.

    A batch rewrites the hash buckets that its keys fall into, and no others.
    """

    def apply(batch: DataFrame, _: int) -> None:
        rows = transform(batch)
        once = first_of_each(rows.withColumn("_late", -F.col(order).cast("double")), [key], ["_late"]).drop("_late")
        schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
        KeyedTable(batch.sparkSession, table, schema, [key], buckets).upsert(once)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
