"""A narrow map over documents: one parse, one list of rows, errors kept beside."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: Rows are handed on once they come from so many characters, or are so many; a batch of documents may hold far more.
CHARS, ROWS = 1 << 20, 4096


class Skipped(Exception):
    """The document does not have what its kind must have; all its rows are dropped."""


def per_document(docs: DataFrame, columns: Sequence[str], extract: Callable[..., list[dict]], schema: str) -> DataFrame:
    """Rows that ``extract(*columns)`` makes of each document, with ``error`` set (and all else null) where it fails."""
    spark_schema = StructType.fromDDL(f"{schema}, error string")
    arrow = to_arrow_schema(spark_schema)

    return docs.select(*columns).mapInArrow(lambda batches: handed_on(batches, extract, arrow), spark_schema)


def handed_on(batches: Iterator[pa.RecordBatch], extract: Callable[..., list[dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of batches of documents, before they pass :data:`CHARS` or :data:`ROWS` by more than a document."""
    for b in batches:
        rows: list[dict] = []
        read = 0
        for own in zip(*b.columns):
            values = [v.as_py() for v in own]
            try:
                rows += extract(*values)
            except Skipped as e:
                rows.append({"error": f"{values[0]}: {e}"})
            read += sum(len(v) for v in values if isinstance(v, str))
            if read > CHARS or len(rows) > ROWS:
                yield from pa.Table.from_pylist(rows, schema=schema).to_batches()
                rows, read = [], 0
        if rows:
            yield from pa.Table.from_pylist(rows, schema=schema).to_batches()


def good(df: DataFrame) -> DataFrame:
    """The rows of documents that did not fail."""
    return df.where("error is null").drop("error")


def dead_letters(df: DataFrame) -> DataFrame:
    """The errors."""
    return df.where("error is not null").select("error")
