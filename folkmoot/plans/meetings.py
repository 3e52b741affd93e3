"""Plenary and commission meetings: header, questions, propositions, notices and votes.

One parse of a page gives all tables, nested; a page whose header is incomplete
gives none. Tables are then exploded without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grammar as G
from ..functions import text as T
from ..operators.dom import Node, parse
from .documents import Skipped, good, per_document

# Fixed values.
TIMES_OF_DAY = {"namiddag": "afternoon", "voormiddag": "morning", "avond": "evening"}
PLENARY_OPENS = ("wordt geopend", "wordt hervat")
PLENARY_CLOSES = ("de vergadering wordt gesloten", "de vergadering wordt geschorst")
COMMISSION_OPENS = (
    "De behandeling van de",
    "De openbare commissievergadering wordt geopend",
    "De vergadering wordt geopend",
    "De gedachtewisseling vangt aan",
)
COMMISSION_CLOSES = (
    "De openbare commissievergadering wordt gesloten",
    "De gedachtewisseling met de ministers eindigt",
    "De behandeling van de vragen eindigt",
    "De gedachtewisseling eindigt",
    "De vergadering wordt gesloten",
    "De behandeling van de interpellatie eindigt",
    "De behandeling van de interpellaties eindigt",
    "De behandeling van de vragen en interpellaties eindigt om",
)
QUESTION_HEADS = ("mondelinge vragen", "vragen", "questions orales", "question orales", "questions")
PROPOSITION_HEADS, PROPOSITION_HEADS_FR = ("voorstel", "wetsvoorstel"), ("proposition",)
NOTICE_HEADS, NOTICE_HEADS_FR = ("mededeling", "mededelingen"), ("communication", "communications")
VOTE_HEADS = ("naamstemmingen", "naamstemming")
INCIDENT_CLOSED = ("Het incident is gesloten", "L'incident est clos")
VOTE_MARK = "Stemming/vote"
VOTE_LABELS = {"Ja": "yes", "Nee": "no", "Onthoudingen": "abstain"}
APPENDIX = ("Vote nominatif - Naamstemming: ", "Naamstemming - Vote nominatif: ")


def _head(node: Node) -> str:
    return node.text(" ").replace("\n", " ").strip().lower()


def _span_text(span: Node, quote: str = "'") -> str:
    return G.clean(span.text(" ")).replace('"', quote)


def _has(text: str, words: tuple[str, ...]) -> bool:
    return any(w in text for w in words)


def _last_span(node: Node, languages: tuple[str, ...]) -> Node | None:
    spans = [s for s in node.select("span") if s.attrs.get("lang") in languages]
    return spans[-1] if spans else None


# Header: M08, M09, P16-P18, W11, W12.


def meeting_date(page: Node) -> str:
    table = page.first("table")
    found = G.iso_date(" ".join(t for s in table.select("span") for t in s.texts())) if table is not None else None
    if found is None:
        raise Skipped("no date")
    return found


def time_of_day(page: Node) -> str:
    for span in page.select("span"):
        if (name := TIMES_OF_DAY.get(span.text(" ").strip().lower())) is not None:
            return name
    raise Skipped("no time of day")


def _times(texts: Iterator[str], holds: Callable[[str], bool], pattern: re.Pattern) -> list[str]:
    return [f"{m[1]}h{m[2]}" for t in texts if holds(t) and (m := pattern.search(t))]


def plenary_time(page: Node, phrases: tuple[str, ...]) -> str:
    """The last time of the first phrase that has one."""
    texts = [G.squash(s.text(" ")) for s in page.select("span")]
    for phrase in phrases:
        if found := _times(iter(texts), lambda t: phrase in t.lower(), G.PLENARY_TIME):  # noqa: B023
            return found[-1]
    raise Skipped(f"no time: {phrases[0]}")


def commission_time(page: Node, phrases: tuple[str, ...]) -> str:
    """The last time beside any phrase."""
    found = _times((n.text(" ").replace("\n", " ") for n in page.select("span, p")), lambda t: _has(t, phrases), G.COMMISSION_TIME)
    if not found:
        raise Skipped(f"no time: {phrases[0]}")
    return found[-1]


def chair(page: Node) -> str:
    for n in page.select("span, p"):
        if names := G.chair_names(n.text(" ").replace("\n", " ")):
            return names
    raise Skipped("no chair")


def commission(page: Node) -> str:
    span = s.first("span") if (s := page.first("table")) is not None else None
    if span is None:
        raise Skipped("no commission")
    low = G.squash(span.text(" ")).lower()
    return next((name for keyword, name in T.COMMISSIONS if keyword in low), "onbekend")


# Questions: P26, F03, F04, W05, W06.


def plenary_titles(h2: Node) -> tuple[str | None, str | None]:
    """The last Dutch and the last French span, rerouted where their words tell otherwise."""
    nl = fr = None
    if (span := _last_span(h2, ("NL", "NL-BE"))) is not None:
        text = _span_text(span, "")
        nl, fr = (None, text) if "questions jointes" in text.lower() else (text, None)
    if (span := _last_span(h2, ("FR", "FR-BE"))) is not None:
        text = _span_text(span, "")
        if _has(text.lower(), (" aan ", "samengevoegde vragen")):
            nl = text
        else:
            fr = text
    return nl, fr


def commission_titles(h2: Node) -> tuple[str | None, str | None]:
    nl = fr = None
    if (span := _last_span(h2, ("NL", "NL-BE"))) is not None:
        text = _span_text(span)
        nl, fr = (None, text) if _has(text.lower(), ("questions jointes", "question de")) else (text, None)
    if (span := _last_span(h2, ("FR",))) is not None:
        text = _span_text(span)
        if _has(text.lower(), ("samengevoegde vragen", "toegevoegde vragen", "vraag van")):
            nl = text
        else:
            fr = text
    return nl, fr


class _Questions:
    """The open question's titles and paragraphs, and the finished ones."""

    def __init__(self) -> None:
        self.done: list[tuple[str, str, str]] = []
        self.clear()

    def clear(self) -> None:
        self.nl, self.fr, self.said = "", "", ""

    def finish(self, both: bool = False) -> None:
        """Keep the open question if it has a title (``both``: in both languages)."""
        if (self.nl and self.fr) if both else (self.nl or self.fr):
            self.done.append((self.nl, self.fr, self.said))

    def open(self, nl: str | None, fr: str | None) -> None:
        """A new question; an open one with titles in both languages is finished first."""
        if self.nl and self.fr:
            self.finish()
            self.clear()
        self.nl, self.fr = nl if nl is not None else self.nl, fr if fr is not None else self.fr

    def add(self, nl: str | None, fr: str | None) -> None:
        self.nl += "" if nl is None else "\n" + nl
        self.fr += "" if fr is None else "\n" + fr

    def say(self, text: str) -> None:
        self.said += G.clean(text) + G.PARAGRAPH


def _kind(nl: str | None, fr: str | None, more: str | None = None) -> str:
    n, f = nl or "", fr or ""
    if n.startswith(("Samengevoegde", "Vraag van")) or "jointes" in f or f.startswith("Question de") or (more and more in n):
        return "start"
    return "sub" if n.startswith("-") or f.startswith("-") else "other"


def plenary_question_blocks(page: Node, fixed: bool = False) -> list[tuple[str, str, str]]:
    """W05. A question that the document leaves open is lost; ``fixed`` keeps it."""
    q, inside = _Questions(), False
    for node in page.select("h1, h2, p"):
        if node.tag == "h1":
            if _has(_head(node), QUESTION_HEADS):
                inside = True
            elif inside:
                q.finish()
                return q.done
        elif inside and node.tag == "h2":
            nl, fr = plenary_titles(node)
            kind = _kind(nl, fr)
            if kind == "other":
                q.finish()
                return q.done
            (q.open if kind == "start" else q.add)(nl, fr)
        elif inside:
            text = node.text(" ").strip()
            if _has(text, INCIDENT_CLOSED):
                q.finish()
                q.clear()
            elif text and (q.nl or q.fr):
                q.say(text)
    if fixed:
        q.finish()
    return q.done


def commission_question_blocks(page: Node) -> list[tuple[str, str, str]]:
    """No section; hearings end the open question and are skipped."""
    q = _Questions()
    for node in page.select("h2, p"):
        if node.tag == "p":
            if text := node.text(" ").strip():
                q.say(text)
            continue
        nl, fr = commission_titles(node)
        if "hoorzitting" in (nl or "").lower() or "audition" in (fr or "").lower():
            q.finish(both=True)
            q.clear()
            continue
        kind = _kind(nl, fr, "toegevoegde vragen")
        if kind != "other":
            (q.open if kind == "start" else q.add)(nl, fr)
    q.finish(both=True)
    return q.done


def question_rows(blocks: list[tuple[str, str, str]], read: Callable[[str], dict[str, list[str]]], fixed: bool = False) -> list[dict]:
    out = []
    for number, (nl, fr, said) in enumerate(blocks):
        dutch, french = read(nl), read(fr)
        out.append(
            {
                "question_id": str(number),
                "questioners": ",".join(dutch["questioners"]),
                "respondents": ",".join(dutch["respondents"]),
                "topics_nl": ";".join(dutch["topics"]),
                "topics_fr": ";".join(french["topics"]),
                "discussion": G.turns_json(said, fixed),
                "ids": ",".join(dutch["ids"]),
            }
        )
    return out


# Propositions and notices: F01, W02, W03, J07, M21, M22.


def agenda_titles(page: Node, heads: tuple[str, ...], heads_fr: tuple[str, ...]) -> list[tuple[int | None, str]]:
    """(number, title) of the section's h2; a title without text is skipped."""
    out, inside = [], False
    for node in page.select("h1, h2"):
        if node.tag == "h1":
            text = _head(node)
            if _has(text, heads):
                inside = True
            elif inside and not _has(text, heads_fr):
                break
        elif inside:
            said = [x for s in node.select("span") if (x := _span_text(s).strip())]
            numbers = [x for x in said if x.isascii() and x.isdigit()]
            titles = [x for x in said if not (x.isascii() and x.isdigit())]
            if titles:
                out.append((int(numbers[0]) if numbers else None, titles[-1].lstrip("-").strip()))
    return out


def title_pairs(titles: list[tuple[int | None, str]]) -> list[tuple[str, str]]:
    """Dutch and French titles of each agenda group: its first half beside its second."""
    groups: list[list[str]] = []
    current = None
    for number, text in titles:
        if number is not None and number != current:
            current = number
            groups.append([text])
        elif groups:
            groups[-1].append(text)
    return [pair for g in groups for pair in zip(g[: len(g) // 2], g[len(g) // 2 :])]


def proposition_rows(page: Node) -> list[dict]:
    out = []
    for number, (nl, fr) in enumerate(title_pairs(agenda_titles(page, PROPOSITION_HEADS, PROPOSITION_HEADS_FR))):
        topic, dossier, document = G.proposition(nl)
        out.append({"proposition_id": str(number), "title_nl": topic, "title_fr": G.proposition(fr)[0], "dossier_id": dossier, "document_id": document})
    return out


def notice_rows(page: Node) -> list[dict]:
    pairs = title_pairs(agenda_titles(page, NOTICE_HEADS, NOTICE_HEADS_FR))
    return [{"notice_id": str(i), "title_nl": nl, "title_fr": fr} for i, (nl, fr) in enumerate(pairs)]


# Votes: F02, F07-F09, F19, W09, J02, J03, P24, P25, P30.


def vote_counts(table: Node) -> tuple[str, dict[str, int]]:
    """The number and the counts; no counts without the vote's mark in the first row."""
    rows = [*table.select("tr")]
    head = rows[0].text(" ").strip() if rows else ""
    counts = dict.fromkeys(VOTE_LABELS.values(), 0)
    if VOTE_MARK not in head:
        return "", counts
    for row in rows[1:]:
        cells = [c.text(" ").strip() for c in row.select("td")]
        if len(cells) >= 2 and cells[0] in VOTE_LABELS and re.fullmatch(r"\+?[0-9]+", cells[1]):
            counts[VOTE_LABELS[cells[0]]] = int(cells[1])
    return head.replace("(", "").replace(")", "").replace(VOTE_MARK, "").strip(), counts


def _names_after(table: Node) -> str:
    """Names in the paragraphs up to the next table."""
    found = []
    for x in table.following():
        if not isinstance(x, Node):
            continue
        if x.tag == "table":
            break
        first = x.children[0] if x.tag == "p" and x.children else None
        if isinstance(first, Node) and first.tag == "span":
            raw = first.text(" ").strip()
            if raw[:1].isalpha() and not _has(raw, ("Vote nominatif", "Naamstemming")):
                found.append(raw.rstrip(",").strip())
    return ", ".join(found).replace(", ", ",").replace(",\n", ",").replace("\n", " ")


def voter_names(spans: list[tuple[Node, str]], number: str, fixed: bool = False) -> list[str]:
    """Yes, no and abstain from the appendix of a vote.

    The heading is found by its text, so 1 also meets 10; ``fixed`` wants the whole number.
    """
    out = ["", "", ""]
    for span, text in spans:
        at = next((text.find(h) + len(h) for h in APPENDIX if h + number in text), None)
        if at is None or (fixed and not re.match(rf"{re.escape(number)}(?![0-9])", text[at:])):
            continue
        parent = span.parent
        nodes = [parent, *parent.following()] if parent is not None else []
        for i, table in enumerate([n for n in nodes if isinstance(n, Node) and n.tag == "table"][:3]):
            cells = [*table.select("td")]
            count = cells[1].text(" ").strip() if len(cells) > 1 else ""
            out[i] = _names_after(table) if count.isdecimal() and int(count) else ""
        break
    return out


class _Titles:
    """The last title and its raw text in each language, with grouped lines."""

    def __init__(self) -> None:
        self.title, self.raw, self.grouped = {"nl": "", "fr": ""}, {"nl": "", "fr": ""}, False

    def heading(self, language: str, text: str) -> None:
        self.raw[language] = text
        if text and not text.startswith("-"):
            self.title[language], self.grouped = text, True
        elif text and self.grouped:
            self.title[language] += "\n" + text
        else:
            self.grouped = self.grouped and not self.title[language]
            self.title[language] = ""

    def from_h2(self, h2: Node) -> None:
        if (span := _last_span(h2, ("NL", "NL-BE"))) is not None and (text := _span_text(span)):
            self.heading("fr" if G.is_french(text) and not G.is_dutch(text) else "nl", text)
        if (span := _last_span(h2, ("FR",))) is not None:
            self.heading("fr", _span_text(span))

    def from_paragraph(self, p: Node) -> None:
        kind = p.attrs.get("class", "")
        own = "nl" if "NL" in kind else "fr" if "FR" in kind else None
        found, reference = {"nl": "", "fr": ""}, ""
        for span in p.select("span"):
            raw, tagged = _span_text(span), span.attrs.get("lang")
            french = G.is_french(raw) and not G.is_dutch(raw)
            if raw.startswith("("):
                reference = raw
                continue
            if tagged == "FR":
                language = "fr"
            elif tagged in ("NL", "NL-BE"):
                language = "fr" if "FR" in kind or french else "nl"
            else:
                language = own or ("fr" if french or found["nl"] else "nl")
            found[language] += raw
        found = {k: f"{v} {reference}" if v and reference else v for k, v in found.items()}
        if own and found[own].strip():
            self.title[own] = found[own].strip()
        elif "FR" in kind and found["fr"].strip():
            self.title["fr"] = found["fr"].strip()
        else:
            self.title |= {k: v.strip() for k, v in found.items() if v.strip()}


def vote_rows(page: Node, fixed: bool = False) -> list[dict]:
    titles, known, out, inside = _Titles(), {}, [], False
    spans = [(s, G.squash(s.text(" "))) for s in page.select("span")]

    def push(number: str) -> None:
        counts, names = known[number]
        topic, dossier, document, motion = G.vote_title(titles.title["nl"])
        out.append(
            {
                "vote_id": str(len(out)),
                "title_nl": topic or titles.raw["nl"],
                "title_fr": G.vote_title(titles.title["fr"])[0] or titles.raw["fr"],
                **{k: str(v) for k, v in counts.items()},
                **dict(zip(("members_yes", "members_no", "members_abstain"), map(G.turn_names, names))),
                "dossier_id": dossier,
                "document_id": document,
                "motion_id": motion,
            }
        )

    for node in page.select("h1, h2, table, p"):
        if node.tag == "h1" and _has(_head(node), VOTE_HEADS):
            inside = True
        if not inside:
            continue
        if node.tag == "p":
            own = [*node.select("span")]
            text = _span_text(own[-1]) if own else ""
            again = G.VOTE_REFERENCE.search(text)
            if again and again[1] in known and all(a.tag != "table" for a in node.ancestors()):
                push(again[1])
            if own and G.VOTE_PARAGRAPH.search(text):
                titles.from_paragraph(node)
        elif node.tag == "h2":
            titles.from_h2(node)
        elif node.tag == "table":
            number, counts = vote_counts(node)
            if any(counts.values()):
                known[number] = counts, voter_names(spans, number, fixed)
                push(number)
    return out


# Tables.

_strings = lambda names: ",".join(f"{n}:string" for n in names.split())
QUESTION = _strings("question_id questioners respondents topics_nl topics_fr discussion ids")
VOTE = _strings("vote_id title_nl title_fr yes no abstain members_yes members_no members_abstain dossier_id document_id motion_id")
PROPOSITION = _strings("proposition_id title_nl title_fr dossier_id document_id")
NOTICE = _strings("notice_id title_nl title_fr")
PLENARY_HEAD = "session_id string, meeting_id string, date string, time_of_day string, start_time string, end_time string"
COMMISSION = f"session_id string, commission_id string, date string, time_of_day string, start_time string, end_time string, commission string, chair string, questions array<struct<{QUESTION}>>"


#: The nested tables of a plenary page, and what makes them.
CHILDREN: dict[str, tuple[str, Callable[[Node, bool], list[dict]]]] = {
    "questions": (QUESTION, lambda page, fixed: question_rows(plenary_question_blocks(page, fixed), G.plenary_questions, fixed)),
    "propositions": (PROPOSITION, lambda page, fixed: proposition_rows(page)),
    "notices": (NOTICE, lambda page, fixed: notice_rows(page)),
    "votes": (VOTE, vote_rows),
}


def plenary_row(session_id: str, meeting_id: str, html: str, fixed: bool = False, only: Sequence[str] = tuple(CHILDREN)) -> list[dict]:
    page = parse(html)
    head = {"date": meeting_date(page), "time_of_day": time_of_day(page), "start_time": plenary_time(page, PLENARY_OPENS), "end_time": plenary_time(page, PLENARY_CLOSES)}
    body = {name: CHILDREN[name][1](page, fixed) for name in only}
    return [{"session_id": str(session_id), "meeting_id": str(meeting_id), **head, **body}]


def commission_row(session_id: str, meeting_id: str, html: str, fixed: bool = False) -> list[dict]:
    page = parse(html)
    head = {"date": meeting_date(page), "time_of_day": time_of_day(page), "start_time": commission_time(page, COMMISSION_OPENS), "end_time": commission_time(page, COMMISSION_CLOSES), "commission": commission(page), "chair": chair(page)}
    return [{"session_id": str(session_id), "commission_id": str(meeting_id), **head, "questions": question_rows(commission_question_blocks(page), G.commission_questions, fixed)}]


def plenary(docs: DataFrame, fixed: bool = False, only: Sequence[str] = tuple(CHILDREN)) -> DataFrame:
    """``docs``: (session_id, meeting_id, html). One row each, the tables nested (``only`` those named), or its error."""
    nested = "".join(f", {name} array<struct<{CHILDREN[name][0]}>>" for name in only)
    return per_document(docs, ["session_id", "meeting_id", "html"], lambda s, m, html: plenary_row(s, m, html, fixed, only), f"{PLENARY_HEAD}{nested}")


def commission_meetings(docs: DataFrame, fixed: bool = False) -> DataFrame:
    return per_document(docs, ["session_id", "meeting_id", "html"], lambda s, m, html: commission_row(s, m, html, fixed), COMMISSION)


def plenary_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The five tables of :func:`plenary` rows, and the last meeting date of each dossier (A01); of rows with some nested tables only, those that these give."""
    ok = good(rows)
    child = lambda name: ok.select("session_id", "meeting_id", "date", F.inline(name))
    out = {"meetings": ok.select("session_id", "meeting_id", "date", "time_of_day", "start_time", "end_time")}
    if "questions" in rows.columns:
        out["questions"] = child("questions").drop("date").withColumnRenamed("ids", "internal_ids")
    out |= {name: child(name).drop("date") for name in ("propositions", "notices") if name in rows.columns}
    if "votes" in rows.columns:
        out["votes"] = child("votes")
    if "propositions" in rows.columns and "votes" in rows.columns:
        # one pass over the pages for both
        ids = lambda name: F.transform(name, lambda x: x["dossier_id"])
        seen = ok.select("date", F.explode(F.array_distinct(F.concat(ids("propositions"), ids("votes")))).alias("dossier_id"))
        out["dossier_dates"] = seen.where("dossier_id <> ''").groupBy("dossier_id").agg(F.max("date").alias("date"))
    return out


def commission_tables(rows: DataFrame) -> dict[str, DataFrame]:
    ok = good(rows)
    return {
        "meetings": ok.drop("questions"),
        "questions": ok.select("session_id", F.col("commission_id").alias("meeting_id"), F.inline("questions")).withColumnRenamed("ids", "dossier_ids"),
    }
