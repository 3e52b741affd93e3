"""Table functions for SQL: the element relation by ``LATERAL``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .dom import ELEMENT_TYPES, element_columns

_OF_ONE_PAGE = StructType([StructField(name, from_arrow_type(kind)) for name, kind in ELEMENT_TYPES.items() if name != "doc_id"])


class Elements:
    """``elements(html [, columns])``: a row for each element of a page, in document order.

    ``columns`` is a constant list of names, comma-separated, in the order wanted (all of them
    by default): the table has these columns only, and only their values are made. Null and empty
    pages have no elements. An unknown or repeated name is an error of the query, before it runs.
    """

    @staticmethod
    def analyze(html: AnalyzeArgument, columns: AnalyzeArgument | None = None) -> AnalyzeResult:
        if html.isTable or not isinstance(html.dataType, StringType):
            raise ValueError("elements: the first argument is a page's html, a string")
        if columns is None:
            return AnalyzeResult(_OF_ONE_PAGE)
        if not columns.isConstantExpression or not isinstance(columns.value, str):
            raise ValueError("elements: the columns are a constant string of names")
        names = [c.strip() for c in columns.value.split(",")]
        unknown = [c for c in names if c not in _OF_ONE_PAGE.names]
        if unknown or len(set(names)) < len(names):
            raise ValueError(f"elements: no or not one column of each of these names: {', '.join(unknown or names)}; there are {', '.join(_OF_ONE_PAGE.names)}")
        return AnalyzeResult(StructType([_OF_ONE_PAGE[c] for c in names]))

    def __init__(self, analyzed: AnalyzeResult | None = None):
        self.columns = (analyzed.schema if analyzed else _OF_ONE_PAGE).names

    def eval(self, html: str | None, columns: str | None = None) -> Iterator[tuple]:
        if html:
            found = element_columns(None, html, self.columns)
            for k, c in enumerate(self.columns):
                if c == "attrs":
                    found[k] = [dict(pairs) for pairs in found[k]]
            yield from zip(*found)


def register(spark: SparkSession) -> None:
    """Make ``elements`` known to the session's SQL; rows come back by Arrow."""
    spark.udtf.register("elements", udtf(Elements, useArrow=True))
