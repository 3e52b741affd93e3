"""What keeps tasks many, small and bounded as the tables grow."""

import random

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from folkmoot.operators.dom import _Builder
from folkmoot.plans import documents, dossiers, meetings
from folkmoot.queries import QUERIES, _meeting_html
from folkmoot.sources import files
from folkmoot.streaming import grace

SMALL = "/root/testdata/sf0.001"


def _tree(node):
    return node.tag, node.attrs, [c if isinstance(c, str) else _tree(c) for c in node.children]


def test_rows_are_handed_on_while_a_batch_is_read():
    html = "<table><tbody><tr><td>Subdocumenten<td><table>" + "<tr><td><a>001</a><td><font>ADVIES</font><tr><td>Datum ronddeling<td>9/6/2024<tr><td>" * 1000 + "</table></table>"
    batch = pa.RecordBatch.from_pydict({"html": [html] * 60})
    schema = pa.schema([("n", pa.int64()), ("error", pa.string())])
    sizes = [b.num_rows for b in documents.handed_on(iter([batch]), lambda h: [{"n": len(dossiers.dossier_row("56", "1", "x", h, "b")[0]["subdocuments"])}], schema)]
    assert sum(sizes) == 60 and max(sizes) <= documents.CHARS // len(html) + 1 < 60
    many = pa.RecordBatch.from_pydict({"html": ["x"] * 100})
    out = [b.num_rows for b in documents.handed_on(iter([many]), lambda h: [{"n": k} for k in range(200)], schema)]
    assert sum(out) == 20_000 and max(out) <= documents.ROWS + 200


def test_plain_pages_read_as_by_the_standard_parser():
    pieces = ["<table>", "<tr>", "<td>", "</td>", "</TR>", "</table>", "<p>", "</p>", "<DIV class=x>", "</Div>", "<a href='x'>", '<a href="y>z" id=q ID=r>', "<li>", "<ul>", "<br>", "text", " a & b ", "&amp;x", "&amp", "&lt y", "&#38;", "\n", "<b >", "<i\tx=1\n>", "<tbody>", "<th>", "<dt>", "<h1>"]
    odd = ["< b", "</b >", "<a b='&amp;'>", "<a b = 'c'>", "<br/>", "<!-- x -->", "<script>", "</script>", "</>", "<", "<a x=1/>", "<title>", "<a-b>", "<a x='<'>", "<a x=a'b>"]
    draw, plain = random.Random(3), 0
    for k in range(4000):
        html = "".join(draw.choice(pieces if k % 2 else pieces + odd) for _ in range(draw.randint(0, 14)))
        quick, slow = _Builder(), _Builder()
        if quick.read_plain(html):
            slow.feed(html)
            slow.close()
            assert _tree(quick.root) == _tree(slow.root), html
            plain += 1
    assert plain > 1000
    assert not any(_Builder().read_plain(html) for html in odd if html not in ("<a x='<'>",))


def test_small_rows_are_dealt_before_pages_are_made_of_them(spark):
    for name in ("p14_dossiers", "p15_w07_subdocuments", "p16_plenary_meetings", "p17_p18_commission_meetings", "p05_remunerations"):
        assert QUERIES[name](spark, SMALL).rdd.getNumPartitions() >= 16, name


def test_tables_that_nobody_asks_for_are_not_made(spark):
    docs = spark.range(3).withColumn("html", _meeting_html(F.col("id"))).selectExpr("'56' AS session_id", "string(id) AS meeting_id", "html")
    whole, some = meetings.plenary_tables(meetings.plenary(docs)), meetings.plenary_tables(meetings.plenary(docs, only=("propositions", "votes")))
    assert set(whole) == {"meetings", "questions", "propositions", "notices", "votes", "dossier_dates"} and set(some) == set(whole) - {"questions", "notices"}
    for name in some:
        assert sorted(map(tuple, some[name].collect())) == sorted(map(tuple, whole[name].collect())) != []
    assert set(meetings.plenary_tables(meetings.plenary(docs, only=()))) == {"meetings"}


def test_the_store_is_asked_by_bucket_not_by_dossier():
    calls = {"get": 0, "update": 0, "timers": []}

    class Value:
        held = None

        def get(self):
            calls["get"] += 1
            return self.held

        def update(self, value):
            calls["update"] += 1
            self.held = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def listTimers(self):
            return iter(calls["timers"])

        def deleteTimer(self, at):
            calls["timers"].remove(at)

        def registerTimer(self, at):
            calls["timers"].append(at)

    class Clock:
        now = 0

        def getCurrentProcessingTimeInMs(self):
            return self.now

    day = 86_400_000
    rows = pd.DataFrame({"dossier_id": [f"d{k}" for k in range(3000)], "fetched": [None, "1970-03-02", "1970-03-09"] * 1000, "meeting": ["1970-03-01", "1970-03-01", "1970-03-05"] * 1000})
    state, clock = grace.Grace("2000-01-01"), Clock()
    state.init(Handle())
    asked = pd.concat([*state.handleInputRows((0,), iter([rows[:1000], rows[1000:]]), clock)])
    assert set(asked["dossier_id"]) == {f"d{k}" for k in range(0, 3000, 3)}
    assert (calls["get"], calls["update"], calls["timers"]) == (1, 1, [66 * day])
    again = pd.DataFrame({"dossier_id": ["d1"], "fetched": ["1970-03-20"], "meeting": [None]})  # fetched since: does not ask
    assert [*state.handleInputRows((0,), iter([again]), clock)] == []
    for now, residue in ((66 * day, 1), (70 * day, 2)):
        clock.now = now
        asked = pd.concat([*state.handleExpiredTimer((0,), clock, None)])
        assert set(asked["dossier_id"]) == {f"d{k}" for k in range(residue, 3000, 3)} - {"d1"}
    assert calls["timers"] == [] and calls["get"] == calls["update"] == 4


def test_a_cache_is_listed_and_read_by_tasks(spark, tmp_path):
    told = {"56_1_2024-06-09.html": b"top", "a/56_2_x_y.html": b"\xff", "a/b/56_3_z.html": "é".encode(), "a/56_4.html": b"no date", "a/_56_5_x.html": b"hidden", "_c/56_6_x.html": b"hidden", "a/56_7_x.txt": b"other", "a/56_8_x.html": b""}
    for name, content in told.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    for path in (str(tmp_path), f"file://{tmp_path}"):
        found = files.dossier_pages(spark, path)
        assert sorted((r.dossier_id, r.last_updated, r.html) for r in found.collect()) == [("1", "2024-06-09", "top"), ("2", "x_y", None), ("3", "z", "é"), ("8", "x", "")]
        assert found.inputFiles() == [] and found.rdd.getNumPartitions() >= 16  # the driver holds no listing
    same = lambda found: sorted((tuple(r) for r in found.where("html <> '' OR html IS NULL").select("stem", "html").collect()), key=str)
    assert same(files.pages(spark, str(tmp_path))) == same(files.listed_pages(spark, str(tmp_path)))  # Spark's reader leaves out empty files
