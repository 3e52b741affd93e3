"""The implicit joins and aggregations, as relational operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_years(df: DataFrame, first: int = 2018, last: int = 2024) -> DataFrame:
    """Each row once for each year."""
    return df.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))


def latest_before(left: DataFrame, right: DataFrame, keys: Sequence[str], left_pos: str, right_pos: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the values of the last right row of its key before it; rows without one go.

    One shuffle by key: both sides are stacked, and the last right row is carried
    forward, so no pairs are made.
    """
    held = F.struct(*values)
    none = F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType)
    a = left.select(*keys, F.col(left_pos).alias("_at"), F.lit(0).alias("_side"), F.struct(*left.columns).alias("_row"), none.alias("_held"))
    row_type = a.schema["_row"].dataType
    b = right.select(*keys, F.col(right_pos).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(row_type).alias("_row"), held.alias("_held"))
    so_far = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = a.unionByName(b).withColumn("_last", F.last("_held", ignorenulls=True).over(so_far))
    return carried.where("_side = 0 and _last is not null").select("_row.*", *(F.col("_last").getField(v).alias(v) for v in values))


def looked_up(value: Column, table: dict[str, str]) -> Column:
    """The table's entry, or the value itself."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, value), value)


def unseen(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not known."""
    return new.join(known.select(key), key, "left_anti")


def latest_by_key(df: DataFrame, key: str, date: str, out: str = "latest") -> DataFrame:
    """Greatest date string for each non-empty key."""
    return df.where(F.col(key) != "").groupBy(key).agg(F.max(date).alias(out))


def ordered_join(value: str, order: str, joiner: str) -> Column:
    """Aggregate: values in order, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), joiner)


def ordered_distinct(value: str, order: str, joiner: str) -> Column:
    """Aggregate: values in the order of their first appearance, joined."""
    return F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])), joiner)


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key, the first in order."""
    own = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new``, and the rows of ``old`` that it does not replace."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def numeric_descending(column: str) -> list[Column]:
    """Order by the number of a text, greatest first, then by the text."""
    return [F.coalesce(F.col(column).try_cast("long"), F.lit(0)).desc(), F.col(column).desc()]


def least_meeting(df: DataFrame, key: str, meeting: str) -> DataFrame:
    """The last meeting in descending order for each key: the least one (A10)."""
    return df.groupBy(key).agg(F.min_by(meeting, F.struct(F.coalesce(F.col(meeting).try_cast("long"), F.lit(0)), meeting)).alias(meeting))
