"""Queries beside their SQL where the smallest tables show no difference."""

from pyspark.sql import functions as F

from folkmoot.operators.dom import parse
from folkmoot.plans import pdf
from folkmoot.queries import QUERIES


def test_fractions_of_a_page_are_decimals(spark):
    ends = [(0, 280.0, 360.0), (1, 56.0, 736.0)]  # where header and footer meet the rest: neither holds what ends or begins there
    rows = [(page, y0, y1, want) for page, top, bottom in ends for y0, y1, want in ((top - 20, top, "kept"), (top - 20, top - 0.5, "header"), (bottom, bottom + 20, "kept"), (bottom + 0.5, bottom + 20, "footer"))]
    blocks = spark.createDataFrame(rows, "page int, y0 double, y1 double, want string")
    box = F.array(F.lit(0.0), F.col("y0"), F.lit(100.0), F.col("y1"))
    assert [r.reason for r in blocks.select("want", pdf.reason(box, F.col("page"), F.lit(600.0), F.lit(800.0), pdf.REPORT).alias("reason")).where("reason <> want").collect()] == []


def test_references_that_are_cut_off_stay_in_sections(spark, tmp_path):
    html = "<script>a&&b</script><h1 title='&amp'>A&amp;B &amp</h1><p>x &lt; &lt y &#38; &#38 z &notit; &unknown; ﷐1 &</p>"
    spark.createDataFrame([(1, html)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    row = QUERIES["flagship_page_sections"](spark, str(tmp_path)).first()
    assert (row.heading, row.text) == ("A&B &amp", "x < &lt y & &#38 z &notit; &unknown; ﷐1 &")
    root = parse(html, closed=True)
    assert root.first("script").text() == "a&&b" and root.first("h1").attrs == {"title": "&amp"}
    assert parse(html).first("h1").text() == "A&B &"  # as HTML5 has it
