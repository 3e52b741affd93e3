"""Extractors on invented pages, and the machines in parity and fixed modes."""

from pyspark.sql import functions as F

from folkmoot.operators import relational as R
from folkmoot.operators import windows as W
from folkmoot.operators.dom import element_rows, parse
from folkmoot.plans import dossiers, meetings, pages, pdf
from folkmoot.plans.documents import dead_letters


def test_tree_and_selectors():
    root = parse("<TABLE><tr><td>a<td aria-colindex=3 class='q z'><b>x</b>&amp;<tr><td>c</table><p>one<p>two<script>var t='</p>';</script><ul><li>x<li>y</ul>")
    assert [n.tag for n in root.descendants()] == ["table", "tbody", "tr", "td", "td", "b", "tr", "td", "p", "p", "script", "ul", "li", "li"]
    assert [n.text() for n in root.select("tbody td[aria-colindex='3'], li")] == ["x&", "x", "y"]
    assert [n.text() for n in root.select("tr > td > b")] == ["x"] and root.first("td.z").text("|") == "x|&" and root.first("p.z") is None
    row = root.first("tr")
    assert [n.tag for n in row.select("table tr b")] == ["b"]
    rows = element_rows("d", "<div><p>a<b>c</b></p><p>d</p></div>")
    assert [(r[1], r[2], r[3], r[4], r[5], r[7]) for r in rows] == [(0, -1, 0, 0, "div", []), (1, 0, 0, 1, "p", ["a"]), (2, 1, 0, 2, "b", ["c"]), (3, 0, 1, 1, "p", ["d"])]


def test_sessions_and_commissions():
    html = "<div><a href='showpage.cfm?legis=55&x'>Zitting (2019 - 2024)</a><a href='showpage.cfm?legis=56&x'>(2024)</a></div>"
    assert pages.session_rows(html) == [{"session_id": "55", "start_date": "2019", "end_date": "2024"}]
    page = parse("<p><b>Ondervoorzitter</b><a>A</a></p><p><b>Voorzitter</b><a>B</a></p>")
    assert pages.role_members(page)["chairs"] == "A, B" and pages.role_members(page)["subchairs"] == "A"
    assert pages.role_members(page, fixed=True)["chairs"] == "B"


def test_member_details(spark):
    told = lambda html, fixed=False: pages.member_details(spark.createDataFrame([("56", "x", html)], "session_id string, name string, html string"), fixed).first()
    born = told("<p>weg</p><p>Geboren te Poperinge op 1/2/1970</p>")
    assert born.place_of_birth == "P" and born.date_of_birth == "1970-02-01"
    assert told("<p>Geboren te Aalst. Meer|x</p>").place_of_birth == "Aalst" and told("<p>Geboren te Gent\nx</p>").place_of_birth == "Gent"
    assert told("<p>Geboren te A Geboren te B op 1/2/1970").place_of_birth == "A"
    assert told("<p>x|geboren op|Geboren op 31/02/1970").date_of_birth == "" and told("<p>Geboren|x op 1/2/1970").date_of_birth == ""
    assert told("<p>x sedert 9 juni 2024 | x").start == "2024-06-09" == told("<p>niets").start == told("<p>sedert").start
    assert told("<p>sinds 1/3/2023").start == "2023-03-01" and told("<p>sinds 1/3/2023 sedert 5 mei 2020 | 31/02/2020").start == "2020-05-05"
    assert told("<div>sinds 7 mei 2021</div>").start == "2021-05-07"
    where = lambda said, fixed=False: told(f"<p>Volksvertegenwoordiger {said}</p>", fixed).constituency
    assert where("voor de kieskring Oost-Vlaanderen sedert 2024") == "Oost-Vlaanderen" and where("voor de kieskring Gent st. x") == "Gent st"
    assert where("voor de kieskring Liège") == "Li" and where("voor de kieskring Liège", fixed=True) == "Liège"
    assert where("voor het arrondissement waals brabant tot x") == "Waals-Brabant" and where("voor de kieskring ") == where("kieskring") == ""
    page = told("<a href='cvview54.cfm?key=01234'>a</a><a href='cvview54.cfm?key=O9999'>b</a><p><i>Taal</i> Frans <p>Volksvertegenwoordiger kieskring Fractie: GROEP (x)")
    assert (page.member_id, page.language, page.told_fraction) == ("01234", "fr", "groep")
    assert told("<p>Volksvertegenwoordiger kieskring, Geen lid van een erkende fractie").told_fraction == "independent"
    empty = told(None)
    assert (empty.member_id, empty.date_of_birth, empty.place_of_birth, empty.language, empty.constituency, empty.told_fraction, empty.start) == ("", "", "", "", "", "", "2024-06-09")


SUBS = """<table><tr><td><a href='/a.pdf'>003</a><td><font>VERSLAG</font><tr><td>Datum ronddeling<td>1/2/2024<tr><td>Auteur(s)<td><a>An, De</a><tr><td>&nbsp;
<tr><td><a>004</a><td>geen soort<tr><td>Datum ronddeling<td>2/2/2024</table>"""


def test_subdocuments():
    cell = parse(f"<div>{SUBS}</div>")
    got = dossiers.subdocuments(cell, "https://b")
    assert [(s["id"], s["date"], s["type"], s["authors"], s["file_url"]) for s in got] == [("3", "2024-02-01", "Verslag", "An De", "https://b/a.pdf"), ("4", "2024-02-02", "Verslag", "", None)]
    assert dossiers.subdocuments(cell, "https://b", fixed=True)[1]["type"] == "Onbekend"


def test_dossier_without_a_table_fails_alone(spark):
    docs = spark.createDataFrame([("1", "56", "d", "<p>none"), ("2", "56", "d", "<table><tr><td>Status<td>VERWORPEN</table>")], "dossier_id string, session_id string, last_updated string, html string")
    rows = dossiers.parsed(docs, "https://b")
    assert [(r.id, r.status) for r in dossiers.dossiers(rows).collect()] == [("2", "Verworpen")]
    assert [r.error for r in dead_letters(rows).collect()] == ["1: no table"]


def test_latest_documents(spark):
    subs = [("12", "AangenomenTekst", "u1"), ("9", "ArtikelenAangenomenInPlenum", "u2"), ("10", "ArtikelenAangenomenInPlenum", "u3"), ("11", "Verslag", "r1"), ("13", "Verslag", None)]
    df = spark.createDataFrame([([(i, "", t, "", u) for i, t, u in subs],)], f"subdocuments array<{dossiers.SUBDOCUMENT}>")
    col = F.col("subdocuments")
    assert tuple(df.select(dossiers.latest_adopted_text(col), dossiers.latest_adopted_text(col, fixed=True), dossiers.latest_report(col)).first()) == ("u2", "u3", "r1")


def test_agenda_pairs(spark):
    titles = [(1, "a"), (None, "A"), (2, "b1"), (2, "b2"), (2, "B1"), (2, "B2")]
    assert meetings.title_pairs([(None, "lost"), *titles]) == [("a", "A"), ("b1", "B1"), ("b2", "B2")]
    assert meetings.title_pairs([(1, "x"), (None, "y"), (None, "Z")]) == [("x", "y")]
    df = spark.createDataFrame([(1, i, n, t) for i, (n, t) in enumerate([(None, "lost"), *titles])], "m int, pos int, n int, t string")
    got = W.paired_halves(W.agenda_groups(df, ["m"], "pos", "n"), ["m", "grp"], "pos", "t").orderBy("grp", "pair").collect()
    assert [(r.nl, r.fr) for r in got] == [("a", "A"), ("b1", "B1"), ("b2", "B2")]


OPEN = "<h1>Vragen</h1><h2><span lang=NL>Vraag van A aan B (C) over D</span><span lang=FR>Question de A à B (C) sur E</span></h2><p>01.01 A: x</p>"


def test_last_question_needs_an_end():
    assert meetings.plenary_question_blocks(parse(OPEN)) == [] and len(meetings.plenary_question_blocks(parse(OPEN), fixed=True)) == 1
    assert len(meetings.plenary_question_blocks(parse(OPEN + "<h1>Iets anders</h1>"))) == 1


def test_commission_start_is_the_last_match():
    page = parse("<p>De behandeling van de vragen vangt aan om 10.13 uur.</p><p>De behandeling van de vragen eindigt om 12:40 uur.</p>")
    assert meetings.commission_time(page, meetings.COMMISSION_OPENS) == "12h40"


def test_vote_numbers_by_substring():
    names = lambda n, who: f"<div><p><span>Vote nominatif - Naamstemming: {n}</span></p><table><tr><td>Ja<td>1</table><p><span>{who}</span></p><table><tr><td>N<td>0</table><table><tr><td>O<td>0</table></div>"
    page = parse("<h1>Naamstemmingen</h1><table><tr><td>(Stemming/vote 1)<tr><td>Ja<td>1</table>" + names(10, "Tien Van") + names(1, "Een Van"))
    assert meetings.vote_rows(page)[0]["members_yes"] == "Van Tien" and meetings.vote_rows(page, fixed=True)[0]["members_yes"] == "Van Een"


def test_vote_titles_carry_forward():
    table = "<table><tr><td>(Stemming/vote 2)<tr><td>Ja<td>1</table>"
    page = parse("<h1>Naamstemming</h1><h2><span lang=NL>Titel van (12/3)</span></h2><h2><span lang=NL>- sub (12/4)</span></h2>" + table + "<p class=NL><span>Amendement van X</span><span>(297/10)</span></p><p><span>(Stemming/vote 2)</span></p>")
    got = meetings.vote_rows(page)
    assert [(v["title_nl"], v["dossier_id"]) for v in got] == [("Titel van", ""), ("Amendement van X", "297")]


def test_block_layout(spark):
    boxes = [[50.0, 40.0, 250.0, 50.0], [320.0, 100.0, 580.0, 120.0], [50.0, 740.0, 250.0, 760.0], [50.0, 100.0, 250.0, 120.0]]
    df = spark.createDataFrame([(b,) for b in boxes], "b array<double>")
    got = [r[0] for r in df.select(pdf.reason(F.col("b"), F.lit(1), F.lit(600.0), F.lit(800.0), pdf.REPORT)).collect()]
    assert got == ["header", "right_column", "footer", "kept"]


def test_skipped_pages_and_previews(spark):
    line = lambda *texts: [([(t, 0, 9.0) for t in texts],)]
    rows = [("d", 1, 600.0, 800.0, 0, 0, [50.0, 400.0, 250.0, 420.0], line("Vaste leden", "titulaires")), ("d", 2, 600.0, 800.0, 0, 0, [50.0, 400.0, 250.0, 420.0], line("Vaste leden titulaires")), ("d", 2, 600.0, 800.0, 1, 1, [0.0] * 4, [])]
    blocks = spark.createDataFrame(rows, pdf.BLOCKS)
    assert {(r.page_idx, r.reason) for r in pdf.block_reasons(blocks).collect()} == {(1, "skipped_page"), (2, "kept")}
    assert pdf.markdown(blocks).first().markdown == "Vaste leden titulaires\n"


def test_strip_patterns(spark):
    text = "kop\n\n*Brussel, 3 mei 2024*\n** *\n*De griffier van de Kamer*\nDames en heren,\nslot  \n\n"
    assert spark.createDataFrame([(text,)], "x string").select(pdf.strip_patterns(F.col("x"))).first()[0] == "kop\n\nslot\n"


def test_latest_before_breaks_no_order(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (2, 5, "c")], "k int, at int, x string")
    right = spark.createDataFrame([(1, 2, 20), (1, 4, 40), (1, 6, 60)], "k int, at int, v int")
    assert [tuple(r) for r in R.latest_before(left, right, ["k"], "at", "at", ["v"]).collect()] == [(1, 5, "a", 40)]
