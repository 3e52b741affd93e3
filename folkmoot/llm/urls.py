"""URL filters by a sort-merge range join of canonical keys, in SQL functions only.

A host is written with its labels reversed (``www.example.com`` is ``com.example.www.``), so a
rule's host and all its subdomains are one interval of keys, and so is a path with all that
begin with it. Intervals of prefixes are nested or apart. :func:`within` sorts the starts and
ends of rules and the keys to judge into one sequence and sweeps it: the running sum of
starts and ends is the height of the stack of active rules, and a rule lies on the
stack at the height it began with until it ends. So the rule at height h for a key is
the last one that began at height h before it: one window for each height, no pairs.

The sequence is dealt by range, by Spark's own sampling, and equal keys are dealt further by a
hash, so no key is hot. What a range needs of the ranges before it is the height
at its border and the rules that are open there: sums and last starts of each range, a row
or so for each range and height, which are carried over by windows over the ranges.

Two sweeps: the first one finds for each url the rule hosts that it is at or below; each of
them makes a key of that host and the url's path, and the second one takes the top of the stack
of path rules. The longest rule found wins. Each different url is judged once; verdicts
join back to the rows, by broadcast for the few heavy urls.

Edge cases: a null url, or one without ``://``, has an empty host and path; hosts are compared
as written but for A-Z (a port, user name or trailing dot is part of the host); a rule with an
empty host fits the empty host only, one with an empty path fits every path of its hosts; of equal rules
that disagree block wins; of rules of one length the one with the longer host; rules with a null
host or path fit nothing; repeated rows and null ids are each judged; an empty table gives no
rows, no rules give the default. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, heavy_or_light, written

#: The verdict on urls that no rule fits: a list of rules says what it says, and lets the rest be.
DEFAULT = "allow"
#: After any UTF-8 text: no byte of one is 0xFF.
LAST = b"\xff"
START, POINT, END = 1, 0, -1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first ``://`` and the next of ``/ ? #``, A-Z lower-cased, and from there up to the next of ``? #``."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot: a label holds none, so prefixes are the parent domains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _order() -> tuple[Column, ...]:
    """The order of the sweep: at one key starts come before points; an end shares its key with nothing else."""
    return F.col("key"), F.desc("step"), F.col("salt")


def _dealt(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Starts, ends and points in the order of the sweep, with ``range``: where they were dealt.

    Written, as its ranges must be the same for all that reads it.
    """
    none, nothing = F.lit(None).cast(rules.schema["rule"].dataType), F.lit(None).cast(points.schema["point"].dataType)
    key = F.col("key").cast("binary")
    events = (
        points.select(key.alias("key"), F.lit(POINT).alias("step"), "point", none.alias("rule"), F.xxhash64("point").alias("salt"))
        .union(rules.select(key.alias("key"), F.lit(START), nothing, "rule", F.lit(0).cast("long")))
        .union(rules.select(F.concat(key, F.lit(LAST)), F.lit(END), nothing, none, F.lit(0).cast("long")))
    )
    ranges = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(events.repartitionByRange(ranges, *_order()).withColumn("range", F.spark_partition_id()), "sweep")


def _heights(events: DataFrame, borders: DataFrame) -> DataFrame:
    """``events`` with the height of the stack after each."""
    running = Window.partitionBy("range").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = events.join(F.broadcast(borders), F.col("range") == F.col("_range"))
    return joined.withColumn("height", F.col("border") + F.sum("step").over(running)).drop("_range", "border")


def _borders(marks: DataFrame) -> DataFrame:
    """``(_range, border)``: the height at the start of each range, one row a range."""
    ranges = marks.sparkSession.range(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select(F.col("id").cast("int").alias("_range"))
    sums = marks.groupBy("range").agg(F.sum("step").alias("step"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    border = F.coalesce(F.sum("step").over(before), F.lit(0))
    return written(ranges.join(F.broadcast(sums), F.col("range") == F.col("_range"), "left").select("_range", border.alias("border")), "borders")


def _carried(marks: DataFrame, borders: DataFrame) -> DataFrame:
    """``(range, height, rule)``: the rules that are open where a range starts."""
    starts = _heights(marks, borders).where(F.col("step") == START)
    lasts = starts.groupBy("range", "height").agg(F.max_by("rule", "key").alias("rule"))
    asked = borders.where("border > 0").select(F.col("_range").alias("range"), F.explode(F.sequence(F.lit(1).cast("long"), "border")).alias("height"), F.lit(None).cast(marks.schema["rule"].dataType).alias("rule"))
    # at most a row for each range and height, and as many asked for
    both = lasts.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    before = Window.partitionBy("height").orderBy("range", F.desc("asks")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("rule", F.last("rule", ignorenulls=True).over(before)).where("asks").drop("asks")


def within(points: DataFrame, rules: DataFrame, top: bool) -> DataFrame:
    """``(point, rule)`` for the rules whose key is a prefix of a point's key: all of them, or the longest (``top``).

    ``points`` has ``(key, point)``, ``rules`` ``(key, rule)``, no two of them with one key, no
    rule null. Only points with a rule are returned.
    """
    dealt = _dealt(points, rules)
    marks = dealt.where(F.col("step") != POINT)
    borders = _borders(marks)
    placed = _heights(dealt, borders).where((F.col("step") != END) & (F.col("height") > 0))
    level = F.col("height") if top else F.explode(F.when(F.col("step") == POINT, F.sequence(F.lit(1).cast("long"), "height")).otherwise(F.array("height")))
    levels = placed.select("range", "key", "step", "salt", "point", "rule", level.alias("level"))
    open_ = _carried(marks, borders).select("range", F.lit(b"").alias("key"), F.lit(START + 1).alias("step"), F.lit(0).cast("long").alias("salt"), F.lit(None).cast(points.schema["point"].dataType).alias("point"), "rule", F.col("height").alias("level"))
    on_stack = Window.partitionBy("range", "level").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return levels.unionByName(open_).withColumn("rule", F.last("rule", ignorenulls=True).over(on_stack)).where(F.col("step") == POINT).select("point", "rule")


def usable(rules: DataFrame) -> DataFrame:
    """``(host, path, verdict)``: rules that can fit anything, once each; block wins."""
    host, path = ascii_lower(F.col("host")), F.col("path")
    fit = rules.select(host.alias("host"), path.alias("path"), "verdict").where(~host.rlike("[/?#]") & path.rlike(r"^(/[^?#]*)?$"))
    return fit.groupBy("host", "path").agg(F.when(F.bool_or(F.col("verdict") == "block"), "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of each row; ``rules`` has ``(host, path, verdict)``."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_u", F.unhex(F.md5(F.concat(F.char_length("host").cast("string"), F.lit(":"), "host", "path"))))
    urls = written(rows.groupBy("_u").agg(F.count("*").alias("n"), F.first("host").alias("host"), F.first("path").alias("path")), "urls")
    fit = written(usable(rules), "rules")
    of_hosts = within(urls.select(host_key(F.col("host")).alias("key"), F.struct("_u", "path").alias("point")), fit.select("host").distinct().select(host_key(F.col("host")).alias("key"), F.col("host").alias("rule")), top=False)
    asked = of_hosts.select(F.concat(host_key(F.col("rule")), "point.path").alias("key"), F.col("point._u").alias("point"))
    found = within(asked, fit.select(F.concat(host_key(F.col("host")), "path").alias("key"), F.struct("host", "path", "verdict").alias("rule")), top=True)
    size = F.struct(F.char_length("rule.host") + F.char_length("rule.path"), F.char_length("rule.host"))
    best = found.groupBy(F.col("point").alias("_b")).agg(F.max_by("rule", size).alias("best"))
    verdicts = urls.join(best, F.col("_u") == F.col("_b"), "left").select("_u", "n", F.concat("best.host", "best.path").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return heavy_or_light(rows, "_u", written(verdicts, "verdicts"), "n").select(F.col("_id").alias(id_col), "host", "path", "rule", "verdict")
