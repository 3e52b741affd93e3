"""Sequential machines as windows: carry forward, agenda groups, halves, ids, runs, first and last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def carry_forward(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, start: str | None = None) -> DataFrame:
    """Last non-null ``value`` so far, ``start`` before the first."""
    seen = F.last(value, ignorenulls=True).over(_by(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.coalesce(seen, F.lit(start)))


def agenda_groups(df: DataFrame, keys: Sequence[str], order: str, number: str, out: str = "grp") -> DataFrame:
    """Group number of each row, from 1.

    A group starts where a number differs from the number before it; rows without
    one join the group, rows before the first number are dropped.
    """
    before = F.last(number, ignorenulls=True).over(_by(keys, order).rowsBetween(Window.unboundedPreceding, -1))
    starts = F.col(number).isNotNull() & (before.isNull() | (before != F.col(number)))
    running = _by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_starts", starts.cast("int")).withColumn(out, F.sum("_starts").over(running)).where(F.col(out) > 0).drop("_starts")


def paired_halves(df: DataFrame, keys: Sequence[str], order: str, value: str, first: str = "nl", second: str = "fr") -> DataFrame:
    """The k-th of a group's first half beside the k-th of its second (W03, J07); an odd last one goes."""
    group = Window.partitionBy(*keys)
    placed = df.withColumn("_k", F.row_number().over(group.orderBy(order)) - 1).withColumn("_half", F.floor(F.count("*").over(group) / 2))
    sides = placed.where(F.col("_k") < 2 * F.col("_half"))
    at = F.pmod(F.col("_k"), F.col("_half")).cast("int")
    return sides.groupBy(*keys, at.alias("pair")).agg(F.min(F.when(F.col("_k") < F.col("_half"), F.col(value))).alias(first), F.min(F.when(F.col("_k") >= F.col("_half"), F.col(value))).alias(second))


def dense_ids(df: DataFrame, keys: Sequence[str], order: str, out: str) -> DataFrame:
    """0-based ids that restart for each key."""
    return df.withColumn(out, F.row_number().over(_by(keys, order)) - 1)


def merged_runs(df: DataFrame, keys: Sequence[str], order: str, style: str, text: str) -> DataFrame:
    """Neighbours of equal style as one row, their texts joined."""
    changed = F.coalesce((F.lag(style).over(_by(keys, order)) != F.col(style)).cast("int"), F.lit(1))
    runs = df.withColumn("_new", changed).withColumn("run", F.sum("_new").over(_by(keys, order).rowsBetween(Window.unboundedPreceding, 0)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")
    return runs.groupBy(*keys, "run").agg(F.first(style).alias(style), joined.alias(text))


def last_match(value: Column, order: Column) -> Column:
    """Aggregate: the value at the greatest place among non-nulls."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def first_match(value: Column, order: Column) -> Column:
    """Aggregate: the value at the least place among non-nulls."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def section(df: DataFrame, keys: Sequence[str], order: str, opens: Column, closes: Column | None = None) -> DataFrame:
    """Rows of a section (F01): from the first opening row on, up to the first closing row after it.

    Without ``closes`` the section never ends (F02).
    """
    running = _by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_open", F.max(opens.cast("int")).over(running))
    if closes is not None:
        marked = marked.withColumn("_shut", F.max((closes & (F.col("_open") == 1) & ~opens).cast("int")).over(running))
        marked = marked.where("_shut = 0").drop("_shut")
    return marked.where("_open = 1").drop("_open")
