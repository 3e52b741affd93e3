"""Filter interaction audit: what each of five filters removes, in every order, by part.

A row becomes a mask of the filters that it fails; a part's rows with equal masks are one
cell, so at most 32 cells a part go on, whatever the rows. Each cell is unpivoted against the
order steps (120 orders of 5 steps), one row for each filter that it meets in turn. A running
bit-or over the steps before tells whether an earlier filter has removed the cell;
conditional sums over a part's cells give the counts of a step, and a window over a
filter's rows in all orders gives its Shapley total.

The duplicate filter is relational: the least id of each text (by SHA-256) is found by
aggregation, and rows join on text *and* id, so that a text with many copies is no hot key.

Edge cases: a null text is empty, and equal to an empty one; a null ``source`` is the part
named by the empty string, as is an empty one; null ids are no smaller and no larger than any, so
they neither make duplicates nor are ones, and have no label; rows that repeat an id are
counted each, and are no duplicates of one another; of several labels of an id any with the value
counts; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FILTERS = "ABCDE"
WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 50, 65, 5
CAPITALS, SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[#$%&*|]"


def text_mask(text: Column) -> Column:
    """The bits of the filters that look at a text alone: A is 1, B 2, C 4, D 8."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(words: Column) -> Column:
        few = F.size(words) < WORDS
        repeated = 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * F.size(words).cast("long")
        length = F.char_length(text).cast("long")
        loud = 100 * (length - F.char_length(F.translate(text, CAPITALS, ""))) > CAPITALS_PERCENT * length
        return sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate((few, repeated, loud, text.rlike(SIGNS)))), F.lit(0))

    return F.transform(F.array(words), of)[0]  # the words are split once


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``(_id, part, mask)`` of each row."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(part_col, F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("m"))
    rows = written(rows, "masks")
    firsts = rows.groupBy(F.col("digest").alias("_d")).agg(F.min("_id").alias("_first"))
    joined = rows.join(firsts, (F.col("digest") == F.col("_d")) & (F.col("_id") == F.col("_first")), "left")
    return joined.select("_id", "part", (F.col("m") + F.when(F.col("_id").isNotNull() & F.col("_first").isNull(), 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(part, mask, n, good, toxic)``: the rows of each part by mask."""
    of = labels.groupBy(F.col(id_col).alias("_l")).agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    joined = masked.join(of, F.col("_id") == F.col("_l"), "left")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def order_steps() -> Column:
    """An array of ``(filter_order, step, filter, bit)``: 120 orders of 5 steps."""
    steps = (("".join(order), k, f, 1 << FILTERS.index(f)) for order in permutations(FILTERS) for k, f in enumerate(order, 1))
    kind = "array<struct<filter_order string, step int, filter string, bit int>>"
    return F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "filter", "bit"), s)) for s in steps])), kind)


def interactions(found: DataFrame) -> DataFrame:
    """The metrics of cells ``(part, mask, n, good, toxic)``, by part, order and step."""
    long = found.select("*", F.inline(order_steps())).repartition("part", "filter_order")  # at most 32 * 600 rows a part
    before = Window.partitionBy("part", "filter_order", "mask").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    met = long.withColumn("fails", fails).withColumn("gone", F.coalesce(F.bit_or(F.when(F.col("fails"), F.col("bit")).otherwise(0)).over(before), F.lit(0)) != 0)
    here = F.col("fails") & ~F.col("gone")
    total = lambda column, where: F.sum(F.when(where, F.col(column)).otherwise(0))
    steps = met.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~F.col("fails") & ~F.col("gone")).alias("kept"),
        total("n", here).alias("removed"),
        total("n", F.col("fails") & F.col("gone")).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return steps.withColumn("shapley", shapley).drop("filter")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``, zeros included."""
    return interactions(cells(masks(docs, id_col, text_col, part_col), labels, id_col))
