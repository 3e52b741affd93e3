"""Scalar functions and grammars: the fixtures' hand-derived values, in parity and fixed modes."""

import json

import pytest
from pyspark.sql import functions as F

from folkmoot.functions import grammar as G
from folkmoot.functions import text as T


def values(spark, rows, fn, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(fn(*map(F.col, df.columns))).collect()]


def test_clean_text(spark):
    assert values(spark, ["a\xadb\n c\xa0", None, "", " \t x "], T.clean_text) == ["ab  c", None, "", "x"]
    assert [G.clean(x) for x in ("a\xadb\n c\xa0", "")] == ["ab  c", ""]


def test_money(spark):
    rows = ["Niet bezoldigd", "5000 - 10000 €", "1.234,50", "abc", "12.50 €", "Afgerond op 1200 €", "1 - x", "1d", ""]
    got = [tuple(r) for r in values(spark, rows, T.money_range)]
    assert got == [("0", "0"), ("5000", "10000"), ("1.2345", "1.2345"), ("", ""), ("12.5", "12.5"), ("1200", "1200"), ("", ""), ("", ""), ("", "")]
    assert tuple(values(spark, ["1.234,50"], lambda x: T.money_range(x, fixed=True))[0]) == ("1234.5", "1234.5")


def test_names(spark):
    assert values(spark, ["Van Den Berg Anna", "Anna", ""], T.first_name_first) == ["Anna Van Den Berg", "Anna", ""]
    assert [tuple(r) for r in values(spark, ["Anna Van Den Berg", "Anna"], T.split_name)] == [("Anna", "Van Den Berg"), ("Anna", "")]
    assert values(spark, ["Peeters Jan,De Smet An", ""], T.voter_names) == ["Jan Peeters, An De Smet", ""]
    assert G.turn_names("Peeters Jan,De Smet An") == "Jan Peeters, An De Smet" and G.turn_names("") == ""
    assert values(spark, [" De Smet, An", "Federale Regering", "gouvernment"], T.author) == ["De Smet An", "government", "government"]


def test_dates(spark):
    assert values(spark, ["9/6/2024", "31/02/2024", "onbekend"], T.slash_date) == ["2024-06-09", "31/02/2024", "onbekend"]
    assert values(spark, ["9 juni 2024", "31 juni 2024", "juni 2024", "9 Juin 2024"], T.dutch_date) == ["2024-06-09", "", "", ""]
    assert G.iso_date("Donderdag 9 juni 2024 x") == "2024-06-09" and G.iso_date("9 foo 2024") is None


def test_freshness(spark):
    rows = [("2026-01-10", "2020-01-01"), ("2026-01-05", "2026-01-01"), ("2026-01-09", "2025-12-01"), ("2026-01-05", ""), ("2025-12-01", "2026-01-05")]
    got = values(spark, rows, lambda f, m: T.needs_refetch(f, m, F.lit("2026-01-10")), "f string, m string")
    assert got == [False, True, False, False, True]


def test_strings(spark):
    assert values(spark, ["**a** _b_"], T.strip_markdown) == ["a b"]
    assert values(spark, ["Élan Grüß-X?"], T.slugify) == ["elan-gruess-x"]
    garbled = values(spark, ["x" * 97 + "жжж", "x" * 98 + "жж", ""], lambda x: T.garbled_share(x) > 0.02)
    assert garbled == [True, False, False]
    assert values(spark, ["a(12/3)", "a ( 1 / 2 - 3 ) ", "a (12) b"], T.vote_title) == [True, True, False]
    assert values(spark, ["verslag (verwijzend)", "Aanvullend verslag", "x"], T.document_type) == ["VerslagVerwijzend", "AanvullendVerslag", "Onbekend"]
    for text, dutch, french in (("(van) x", True, False), ("l'avis", False, True), ("élan", False, True), ("élan van", True, False)):
        assert values(spark, [text], T.likely_dutch) == [dutch] == [G.is_dutch(text)]
        assert values(spark, [text], T.likely_french) == [french] == [G.is_french(text)]


def test_question_grammars():
    got = G.plenary_questions("Vraag van Jan Peeters aan An De Smet (Justitie) over Titel A (56001442P)\n- Steven Coengrachts aan An De Smet (X) over B")
    assert got == {"questioners": ["Jan Peeters", "Steven Coenegrachts"], "respondents": ["An De Smet"], "topics": ["Titel A", "B"], "ids": ["Q56001442P", ""]}
    got = G.commission_questions("- de heer Jan Peeters aan An De Smet (J) over \"A\" (nr. 6003263c)\nVraag van Bo over ”B” (56002763C)")
    assert got["questioners"] == ["Jan Peeters", "Bo"] and got["respondents"] == ["An De Smet", "Onbekend"] and got["topics"] == ["A", "B"] and got["ids"] == ["Q6003263c", "Q56002763C"]


def test_propositions_and_votes():
    assert G.proposition("Wetsvoorstel Z (12/1-3) rest") == ("Wetsvoorstel Z", "12", "3")
    assert G.proposition("Zonder nummer (x)") == ("Zonder nummer", "", "")
    assert G.vote_title("Voorstel X (297/10)") == ("Voorstel X", "297", "10", "")
    assert G.vote_title("Motie Y (nr. 12)") == ("Motie Y", "", "", "12")
    assert G.vote_title("Titel\n- sub (297/10)") == ("Titel\n- sub", "", "", "")


def test_speaker_turns():
    text = "02.01 Jan Peeters (G): Hallo.NEWPARAGRAPH02.02 Minister An De Smet: Dag.NEWPARAGRAPHEinde. Het incident is gesloten.NEWPARAGRAPH"
    assert G.speaker_turns(text) == [("Jan Peeters", "Hallo."), ("An De Smet", "Dag.\nEinde.")]
    inner = "weg 01.01 NEWPARAGRAPH01.01 A: x.NEWPARAGRAPHy.NEWPARAGRAPHDe  voorzitter: z"
    assert G.speaker_turns(inner) == [("A", "x.NEWPARAGRAPHy.NEWPARAGRAPH"), ("Voorzitter", "z")]
    assert G.speaker_turns(inner, fixed=True)[0] == ("A", "x.\ny.")
    assert G.turns_json("") == "[]" and json.loads(G.turns_json(text))[1]["text"] == "Dag.\nEinde."


def test_chairs_and_redirects():
    assert G.chair_names("voorgezeten door mevrouw An Claes en de heer Bo Smit. Rest") == "An Claes, Bo Smit"
    text = "De tekst aangenomen door de plenaire vergadering\nis dezelfde als de tekst aangenomen in tweede lezing door de commissie (DOC 56 1518/004)."
    assert G.redirect_url(text, "https://b") == "https://b/56/1518/56K1518004.pdf" and G.redirect_url("x", "https://b") is None


EMPTY = '{"title":"","description":"","arguments_pro":[],"arguments_contra":[],"arguments_neutral":[],"debate_summary":""}'
LISTS = ("arguments_pro", "arguments_contra", "arguments_neutral")


def arguments(text):
    """The same by the standard library, for a reply without a fence."""
    try:
        found = json.loads(text, object_pairs_hook=lambda pairs: dict(pairs) if len(dict(pairs)) == len(pairs) else None, parse_constant=lambda c: 1 / 0)
        told = {k: found[k] for k in ("title", "description")} | {k: [{f: a[f] for f in ("parties", "argument")} for a in found[k]] for k in LISTS} | {"debate_summary": found["debate_summary"]}
        strings = [told["title"], told["description"], told["debate_summary"], *(v for k in LISTS for a in told[k] for v in a.values())]
        ok = all(isinstance(x, str) for x in strings) and all(isinstance(found[k], list) for k in LISTS)
    except (ValueError, KeyError, TypeError, ZeroDivisionError, AttributeError):
        ok = False
    return json.dumps(told, ensure_ascii=False, separators=(",", ":")) if ok else EMPTY


def test_arguments(spark):
    whole = json.loads(EMPTY)
    good = [
        whole,
        {**whole, "title": "\u00e9 \"q\" \\\\u000B \\ / \x7f", "more": {"a": [1.5, None]}, "arguments_pro": [{"parties": "A", "argument": "x", "n": 1}, {"argument": "\n\t", "parties": ""}]},
        {**whole, "description": "".join(map(chr, range(32))), "debate_summary": "\U0001f600"},
    ]
    bad = [{**whole, k: v} for k in whole for v in (1, None, {}, True, 1.5, [1], [None], [{"parties": "a"}], [{"parties": 1, "argument": "b"}])] + [{k: v for k, v in whole.items() if k != gone} for gone in whole]
    texts = [json.dumps(x) for x in good + bad] + [json.dumps(x, indent=1, ensure_ascii=False) for x in good]
    full = EMPTY.replace('""', '"a"', 1)
    texts += ["", "geen json", "[]", "null", "1", full, full + " x", full + "{}", full.replace('"', "'"), full[:-1] + ',"title":"b"}', full[:-1] + ",}", full[:-1] + ',"n":NaN}', full[:-1] + ',"n":01}', "/* c */" + full, full[:-1], "\ufeff" + full]
    fenced = {"```json\n" + EMPTY.replace('""', '"a"', 1) + "\n```": EMPTY.replace('""', '"a"', 1), "```\n{\n```\n}\n```": EMPTY, "``` ": EMPTY, "```\n" + EMPTY.replace('""', '"b"', 1): EMPTY.replace('""', '"b"', 1), "  ```\n" + EMPTY.replace('""', '"c"', 1) + "\n ``` \nthat was it": EMPTY.replace('""', '"c"', 1)}
    rows = spark.createDataFrame([(t,) for t in [*texts, *fenced, None]], "t string").select("t", T.arguments_json(F.col("t")).alias("a"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for r in rows.collect():
        assert r.a == (EMPTY if r.t is None else fenced.get(r.t) or arguments(r.t)), r.t


def test_legacy_text(spark):
    def decoded(data):
        for mark, name in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
            if data.startswith(mark):
                return data[len(mark) :].decode(name, "replace")
        return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data)

    wide = "a\u00e9\u20ac\U0001f600\ud7ff\ue000"
    given = [bytes([b]) for b in range(256)] + [bytes(range(256)), b"", b"\xef\xbb", b"\xff", b"caf\xe9 \x80"]
    given += [b"\xef\xbb\xbf" + wide.encode(), b"\xef\xbb\xbf", b"\xef\xbb\xbfa\xffb\xe2\x82", b"\xff\xfe" + wide.encode("utf-16-le"), b"\xfe\xff" + wide.encode("utf-16-be")]
    given += [b"\xff\xfe", b"\xff\xfea", b"\xfe\xff" + b"\xd8\x00\x00a", b"\xff\xfe" + b"a\x00\x00\xdc" + b"b\x00\x00\xd8", b"\xfe\xff\xd8\x3d\xd8\x3d\xde\x00\xde\x00"]
    rows = spark.createDataFrame([(bytearray(b),) for b in given] + [(None,)], "b binary").select("b", T.legacy_text(F.col("b")).alias("t"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    for r in rows.collect():
        assert r.t == (None if r.b is None else decoded(bytes(r.b))), bytes(r.b)


def test_trim_is_linear_and_knows_all_white_space(spark):
    import time

    rows = [("\t  a b \u0085　",), ("x" + " " * 1_000_000 + "y",), (" " * 1_000_000,), (None,)]
    began = time.monotonic()
    out = [r.t for r in spark.createDataFrame(rows, "s string").select(T.utrim(F.col("s")).alias("t")).collect()]
    assert out == ["a b", rows[1][0], "", None] and time.monotonic() - began < 10
