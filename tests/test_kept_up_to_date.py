"""Keyed tables in buckets, seen sets, retraction, the meeting stream, the grace state, long chains and the table function."""

import datetime

import pytest
from pyspark.sql import functions as F

from folkmoot.operators import table_functions
from folkmoot.operators.dom import element_rows
from folkmoot.plans import pdf, summaries
from folkmoot.sources import meetings
from folkmoot.sources.keyed import KeyedTable, SeenKeys
from folkmoot.streaming import grace, retract


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_change_rewrites_its_buckets_only(spark, tmp_path):
    kept = KeyedTable(spark, f"file://{tmp_path}/t", "k long, v string", ["k"], buckets=32)
    assert kept.read().count() == 0 and kept.upsert(spark.createDataFrame([], "k long, v string")) == []
    kept.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = kept.files()
    assert len(before) == 32
    new = spark.createDataFrame([(7, "new"), (1500, "new"), (None, "none")], "k long, v string")
    touched = kept.upsert(new)
    after = kept.files()
    assert 1 <= len(touched) <= 3 and {b for b in after if after[b] != before.get(b)} == set(touched)
    want = {(k, "new" if k in (7, 1500) else "old") for k in [*range(1000), 1500]} | {(None, "none")}
    assert {tuple(r) for r in kept.read().collect()} == want
    kept.upsert(new)  # again
    assert {tuple(r) for r in kept.read().collect()} == want and kept.read().count() == 1002
    kept.upsert(spark.createDataFrame([(None, "other")], "k long, v string"))
    assert [r.v for r in kept.read().where("k is null").collect()] == ["other"]


def test_rows_that_go_and_buckets_that_empty(spark, tmp_path):
    kept = KeyedTable(spark, f"file://{tmp_path}/t", "k long, v string", ["k"], buckets=8)
    kept.upsert(spark.range(20).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    kept.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v")), gone=F.col("k") != 3)
    assert [tuple(r) for r in kept.read().collect()] == [(3, "v")] and len(kept.files()) == 1


def test_the_seen_set_is_not_moved(spark, tmp_path):
    schema = "input_hash string, original string, summary string, model string, meeting_id string, created_at string"
    seen = SeenKeys(spark, f"file://{tmp_path}/seen", schema, "input_hash", buckets=6)
    rows = spark.range(300).select(F.concat(F.lit("a;"), F.col("id").cast("string")).alias("topics"), F.col("id").cast("string").alias("meeting_id"))
    for part in (rows.where("id % 3 = 0"), rows.where("id % 3 = 1")):
        seen.add(part.select(F.sha2("topics", 256).alias("input_hash"), F.col("topics").alias("original"), F.lit("s").alias("summary"), F.lit("m").alias("model"), "meeting_id", F.lit("t").alias("created_at")))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = summaries.pending(rows, seen.table(), "topics", "topics")
        assert {r.original for r in wanted.collect()} == {f"a;{i}" for i in range(300) if i % 3 == 2}
        join, _, below = plan_of(wanted).rpartition("FileScan parquet")
        cache_side = join[join.rindex("Exchange") :]
        assert "Bucketed: true" in below and "Range" in cache_side  # the last exchange is above the new rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    again = SeenKeys(spark.newSession(), f"file://{tmp_path}/seen", schema, "input_hash", buckets=6)  # from its files
    assert again.table().count() == 200


def test_retraction_equals_recomputation(spark, tmp_path):
    made = (F.min("meeting").alias("least"), F.max("date").alias("latest"))
    kept = retract.Aggregates(spark, f"file://{tmp_path}/a", "key", "meeting", "key string, meeting long, date string", "key string, least long, latest string", made, buckets=8)
    held = {}
    batches = [
        [("a", 1, "d1", False), ("a", 2, "d3", False), ("b", 5, "d1", False), (None, 9, "d9", None)],
        [("a", 1, "d1", True), ("b", 4, "d2", False), ("c", 7, "d0", True)],  # the least place is given back
        [("a", 2, "d0", False), ("b", 5, "d1", True), ("b", 4, "d2", True)],  # a changed one, and a key without meetings
    ]
    for batch in batches:
        frame = spark.createDataFrame(batch, "key string, meeting long, date string, gone boolean")
        for _ in range(2):  # a replayed batch
            kept.apply(frame)
        for k, m, d, gone in batch:
            held.pop((k, m), None)
            if not gone:
                held[k, m] = d
        want = {k: (min(m for x, m in held if x == k), max(d for (x, _), d in held.items() if x == k)) for k, _ in held}
        assert {r["key"]: (r.least, r.latest) for r in kept.read().collect()} == want


def test_a_killed_batch_gives_each_meeting_once(spark, tmp_path):
    last = [7]
    broken = tmp_path / "broken"
    broken.touch()
    page = lambda i: None if i == 4 else f"<p>{i}</p>"

    def fetch(i):
        if i == 3:
            raise OSError("gone")
        return page(i)

    def run():
        stream = meetings.meetings(spark, meetings.one_by_one(fetch), lambda i: i <= last[0], start=0, span=2, most=5)

        def fails(html):
            if broken.exists() and html == "<p>6</p>":
                raise RuntimeError("killed")
            return html

        out = stream.withColumn("html", F.udf(fails)("html")).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").start()
        try:
            out.processAllAvailable()
        finally:
            out.stop()
        return sorted((r.meeting_id, r.html) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    with pytest.raises(Exception, match="killed"):
        run()
    committed = sorted(r.meeting_id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert committed == [1, 2, 3, 4, 5]  # the first batch
    broken.unlink()
    want = lambda n: [(i, None if i == 3 else page(i)) for i in range(1, n + 1)]
    assert run() == want(7)
    last[0] = 12
    assert run() == want(12)


def test_a_dossier_asks_when_its_week_ends(spark, tmp_path):
    day = lambda n: (datetime.datetime.now(datetime.timezone.utc).date() + datetime.timedelta(days=n)).isoformat()
    folder = tmp_path / "in"
    folder.mkdir()

    def run(name, rows):
        (folder / f"{name}.csv").write_text("\n".join(",".join(x or "" for x in r) for r in rows))
        stream = spark.readStream.schema("dossier_id string, fetched string, meeting string").csv(str(folder))
        out = grace.refetches(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").trigger(once=True).start()
        out.awaitTermination()
        return sorted(r.dossier_id for r in spark.read.schema(grace.REQUESTS).parquet(f"{tmp_path}/out").collect())

    first = [("never", None, day(-30)), ("before", day(-40), day(-30)), ("ended", day(-28), day(-30)), ("open", day(-1), day(-2)), ("after", day(-3), day(-30)), ("today", day(0), day(-1)), ("no dates", "x", "y")]
    assert run("a", first) == ["before", "ended", "never", "no dates"]
    # refetched too early and too late, a new meeting, a refetch within the week
    more = [("open", day(-2), day(-2)), ("ended", day(-1), None), ("after", None, day(-2)), ("before", day(-30), None)]
    assert run("b", more) == ["after", "before", "before", "ended", "never", "no dates"]


def test_the_stream_rule_is_the_batch_rule():
    assert grace.within_week("2024-06-01", "2024-06-07") and not grace.within_week("2024-06-01", "2024-06-08")
    assert not grace.within_week(None, "2024-06-08") and not grace.within_week("x", "2024-06-08")


def test_long_chains_and_cycles(spark):
    links = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(1000)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("self", "self"), ("two", "end"), ("two", "zzz"), (None, "a"), ("a", None)]
    frame = spark.createDataFrame(links, "source string, target string")
    out = {r.source: (r.final, r.cyclic) for r in pdf.chased(frame).collect()}
    assert out == {f"c{i:04d}": ("c1000", False) for i in range(1000)} | {k: (k, True) for k in ("x", "y", "z", "w", "self")} | {"two": ("end", False)}
    onward = dict(x for x in links if x != ("two", "zzz"))
    for hops in (0, 1, 2, 3, 6, 1000):
        want = {}
        for start in out:
            at = start
            for _ in range(hops):
                at = onward.get(at) or at
            want[start] = at
        assert {r.source: r.final for r in pdf.chased(frame, hops).collect()} == want
    assert pdf.chased(frame.limit(0)).count() == 0


def test_elements_by_lateral(spark):
    table_functions.register(spark)
    html = "<div class=x><p>a<b>c</b></p><p>d</p></div>"
    rows = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    got = spark.sql("SELECT id, e.* FROM {rows} AS r, LATERAL elements(html) AS e", rows=rows)
    assert got.columns == ["id", "pos", "parent_pos", "sib_idx", "depth", "tag", "attrs", "own_text", "all_text", "ancestor_tags"]
    want = [(1, *r[1:]) for r in element_rows("d", html)]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == [(*r[:6], dict(r[6]), *r[7:]) for r in want]
    assert spark.sql("SELECT * FROM elements('<p>x', 'tag , own_text')").collect() == [("p", ["x"])]
    for wrong in ("elements('<p>', 'tag, no')", "elements('<p>', 'tag,tag')", "elements(1)", "elements('<p>', string(rand()))"):
        with pytest.raises(Exception, match="elements:"):
            spark.sql(f"SELECT * FROM {wrong}").collect()
