"""Sources, sinks, summaries, streaming and plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folkmoot.plans import pdf, summaries
from folkmoot.sources import completion, files, sinks
from folkmoot.streaming import ingest

CACHE = "input_hash string, original string, summary string, model string, meeting_id string, created_at string"


def test_rate_limiter_and_retries():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    limiter = completion.RateLimiter(1.0, lambda: now[0], sleep)
    replies = iter([(429, "", 3.0), (500, "", None), (200, "ok", None)])
    assert completion.complete(lambda p, t: next(replies), "p", "t", limiter) == "ok"
    assert slept == [3.5, 2.0 * 2]
    assert completion.complete(lambda p, t: (401, "", None), "p", "t", limiter) is None
    assert completion.complete(lambda p, t: (503, "", None), "p", "t", limiter) is None


def test_meeting_probe():
    exists = lambda ids: lambda i: i in ids
    assert files.last_meeting(3, exists({4, 5})) == 5
    assert files.last_meeting(3, exists({4, 6}), misses=2) == 4
    assert files.last_meeting(3, exists({4, 6}), misses=2, fixed=True) == 6


def test_files(spark, tmp_path):
    (tmp_path / "56_12_2024-06-09.html").write_bytes(b"<p>caf\xe9</p>")
    (tmp_path / "x.txt").write_text("no")
    got = files.pages(spark, str(tmp_path), legacy=True).collect()
    assert [(r.stem, r.html) for r in got] == [("56_12_2024-06-09", "<p>café</p>")]
    assert [(r.session_id, r.dossier_id, r.last_updated) for r in files.dossier_pages(spark, str(tmp_path)).collect()] == [("56", "12", "2024-06-09")]
    (tmp_path / "ids.tsv").write_text("12\t2024-06-01\n\n13\n12\t2024-06-08")
    ids = files.dossier_ids(spark, str(tmp_path / "ids.tsv"))
    assert {(r.dossier_id, r.date) for r in ids.collect()} == {("12", "2024-06-08"), ("13", "")}
    cached = files.dossier_pages(spark, str(tmp_path))
    assert {r.dossier_id for r in files.stale(cached, ids, "2024-06-20").collect()} == {"12", "13"}
    out = str(tmp_path / "out.tsv")
    sinks.write_dossier_ids(ids, out)
    assert open(out).read() == "12\t2024-06-08\n13\t"
    sinks.write_watermark(spark, 41, str(tmp_path / "mark"))
    assert files.watermark(spark, str(tmp_path / "mark")) == 41
    assert files.directories({"DATA_DIR": "d"}) == ("d", "scrapers/cache")


def test_the_last_line_of_the_last_file_holds(spark, tmp_path):
    lines = [f"{i % 50}\t2024-{i % 12 + 1:02d}-{i % 28 + 1:02d} {i}" for i in range(4000)]
    (tmp_path / "a.tsv").write_text("\n".join(lines[:3000]))
    (tmp_path / "b.tsv").write_text("\n".join(lines[3000:3020]))
    (tmp_path / "B.tsv").write_text("\n".join(lines[3020:]))
    want = {}
    for name in ("B.tsv", "a.tsv", "b.tsv"):
        want |= dict(x.split("\t") for x in (tmp_path / name).read_text().split("\n"))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # a file in many splits
    try:
        ids = files.dossier_ids(spark, str(tmp_path))
        assert {r.dossier_id: r.date for r in ids.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_dossier_rows(spark):
    df = spark.createDataFrame([("1", " u ", None), ("2", " ", ""), ("3", None, "r")], "id string, latest_adopted_text_url string, latest_report_url string")
    assert {tuple(r) for r in files.dossier_rows(df).collect()} == {("1", "u", None), ("3", None, "r")}
    assert files.dossier_rows(df.drop("latest_report_url"), only="3").count() == 0


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert sinks.write_table(df, path) and not sinks.write_table(df.limit(0), path, skip_empty=True)
    sinks.rewrite_table(spark.read.parquet(path).withColumn("v", F.lit("b")), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "b")]
    named = spark.createDataFrame([("x/a.md", "één"), ("x/b.md", "twee")], "name string, content string")
    folder = f"file://{tmp_path}/md"
    assert {r.written for r in sinks.write_absent_files(named, folder).collect()} == {True}
    assert {r.written for r in sinks.write_absent_files(named, folder).collect()} == {False}
    assert {(r.dossier_id, r.name, r.content) for r in files.markdown_files(spark, str(tmp_path / "md")).collect()} == {("x", "a.md", "één"), ("x", "b.md", "twee")}


def test_fetching(spark):
    with pytest.raises(ValueError):
        files.Client("bot@example.com", lambda url: b"")
    client = files.Client("folk tests", lambda url: url.encode(), 0.0, 0.0)
    assert {(r.url, bytes(r.body)) for r in files.fetched(spark, client, ["a", "b"]).collect()} == {("a", b"a"), ("b", b"b")}


def test_summaries(spark):
    rows = spark.createDataFrame([("9", "a;b"), ("10", "a;b"), ("2", "a;b"), ("x", "c;d"), ("3", "single"), ("4", "old;one")], "meeting_id string, topics string")
    known = rows.where("topics = 'old;one'").select(F.sha2("topics", 256), "topics", F.lit("kept"), F.lit("m"), F.lit("77"), F.lit("then")).toDF(*[c.split(" ")[0] for c in CACHE.split(", ")])
    gone = spark.createDataFrame([("h", "gone", "s", "m", "5", "then")], CACHE)
    calls = lambda p, t: (400, "", None) if t == "c;d" else (200, f"**{t}**", None)
    out = {r.original: r for r in summaries.summarise(rows, known.union(gone), "topics", "topics", calls, "m", 1e6, "now").collect()}
    assert set(out) == {"a;b", "old;one", "gone"}
    assert (out["a;b"].summary, out["a;b"].meeting_id) == ("a;b", "2") and (out["old;one"].summary, out["old;one"].meeting_id) == ("kept", "4") and out["gone"].meeting_id == "5"
    assert {r.original for r in summaries.pending(rows, gone, "topics", "discussion").collect()} == {"a;b", "c;d", "single", "old;one"}


def test_anti_join_is_below_the_calls(spark):
    rows = spark.createDataFrame([("9", "a;b")], "meeting_id string, topics string")
    cache = spark.createDataFrame([], CACHE)
    wanted = summaries.completed(summaries.pending(rows, cache, "topics", "topics"), "original", "reply", lambda p, t: (200, t, None), "p", 1e6)
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("LeftAnti")


def test_dossier_summaries(spark):
    long = "tekst " * 100
    rows = [("1", "adopted_text.md", long), ("1", "report.md", "verslag " * 90), ("2", "adopted_text.md", " "), ("3", "adopted_text.md", "kort"), ("3", "report.md", "r")]
    inputs = spark.createDataFrame(rows, "dossier_id string, name string, content string")
    got = lambda *a: {(r.dossier_id, r.content[:5]) for r in summaries.dossier_inputs(inputs, *a).collect()}
    assert got("content") == {("1", "tekst"), ("3", "kort")} and got("arguments") == {("1", "tekst")} and got("arguments", True) == {("1", "versl")}
    cache = spark.createDataFrame([], "summary_hash string, arguments string, model string, dossier_id string, source string, created_at string")
    out = summaries.summarise_dossiers(inputs, cache, "arguments", lambda p, t: (200, "no json", None), "m", 1e6, "now").collect()
    assert len(out) == 1 and out[0].arguments.startswith('{"title":"","description"')


def test_streaming_upsert(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()

    def run():
        stream = ingest.new_pages(spark, str(folder)).withColumn("stem", F.regexp_extract("path", r"([^/]+)_\d+\.html$", 1))
        q = ingest.upsert_stream(stream, out, "stem", str(tmp_path / "check"))
        q.awaitTermination(120)
        return {(r.stem, r.html) for r in spark.read.parquet(out).collect()}

    (folder / "a_1.html").write_text("one")
    assert run() == {("a", "one")}
    (folder / "a_2.html").write_text("two")
    (folder / "b_1.html").write_text("three")
    assert run() == {("a", "two"), ("b", "three")}


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_read_only_what_they_need(spark):
    plan = entry.queries()["a01_latest_date"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "ts" in schema and "user_id" in schema and "props" not in schema and "value" not in schema


def test_replies_are_kept_as_they_come(spark, tmp_path):
    rows = spark.createDataFrame([(f"a;{i}", str(i)) for i in range(23)], "topics string, meeting_id string")
    cache = spark.createDataFrame([], CACHE)
    journal = f"file://{tmp_path}/journal"

    def breaks(prompt, text):
        if text.endswith("7"):
            raise RuntimeError("the service is gone")
        return 200, "said " + text, None

    wanted = summaries.pending(rows, cache, "topics", "topics")
    with pytest.raises(Exception, match="the service is gone"):
        summaries.completed(wanted.orderBy("original"), "original", "reply", breaks, "p", 1e6, journal).collect()
    kept = spark.read.parquet(journal).count()
    assert 0 < kept <= 23
    seen = spark.sparkContext.accumulator(0)

    def counts(prompt, text):
        seen.add(1)
        return 200, "said " + text, None

    out = summaries.completed(wanted, "original", "reply", counts, "p", 1e6, journal, callers=2).collect()
    assert {r.original: r.reply for r in out} == {f"a;{i}": f"said a;{i}" for i in range(23)}
    assert seen.value == 23 - kept
    assert len(summaries.summarise(rows, cache, "topics", "topics", breaks, "m", 1e6, "now", journal=journal).collect()) == 23


def test_a_table_changes_places_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.rewrite_table(spark.range(3), path)
    sinks.rewrite_table(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 5 and [x.name for x in tmp_path.iterdir()] == ["t"]


def test_read_through(spark, tmp_path):
    folder = f"file://{tmp_path}/cache"
    asked = spark.sparkContext.accumulator(0)

    def fetch(url):
        asked.add(1)
        return f"<p>{url}</p>".encode()

    client = files.Client("folk tests", fetch, 0.0, 0.0)
    urls = {"a.html": "u/a", "b.html": "u/b"}
    for refetch, calls in ((frozenset(), 2), (frozenset(), 2), (frozenset({"b.html"}), 3)):
        out = {(r.stem, r.html) for r in files.read_through(spark, folder, urls, client, refetch).collect()}
        assert out == {("a", "<p>u/a</p>"), ("b", "<p>u/b</p>")} and asked.value == calls
    wanted = spark.createDataFrame([("a.html", "u/a"), ("b.html", "u/b"), ("c.html", "u/c"), ("d.html", "lost")], "name string, url string")

    def loses(url):
        if url == "lost":
            raise OSError(url)
        return fetch(url)

    again = spark.createDataFrame([("a.html",)], "name string")
    out = {r.stem for r in files.read_through(spark, folder, wanted, files.Client("folk tests", loses, 0.0, 0.0), again, callers=2).collect()}
    assert out == {"a", "b", "c"} and asked.value == 5  # c is new, a is asked again


def test_pages_are_skipped_by_the_callers_rule(spark):
    line = lambda t: [{"spans": [{"text": t, "flags": 0, "size": 9.0}]}]
    rows = [("d", i, 600.0, 800.0, 0, 0, [10.0, 400.0, 200.0, 410.0], line(f"page {i}")) for i in range(4)]
    blocks = spark.createDataFrame(rows, pdf.BLOCKS)
    skip = F.contains("t", F.lit("page 2")) | (F.col("page_idx") == 0)
    assert pdf.markdown(blocks, pdf.REPORT, skip).first().markdown == "page 1\n\npage 3\n"
    assert {r.page_idx for r in pdf.block_reasons(blocks, pdf.REPORT, skip).where("reason = 'skipped_page'").collect()} == {0, 2}
    assert "page 2" in pdf.markdown(blocks, pdf.REPORT).first().markdown
