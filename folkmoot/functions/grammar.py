"""Text grammars that need match offsets or many groups, as plain functions and Arrow UDFs."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .text import ACCENTED, DUTCH, FRENCH, MONTHS

# Fixed values.
PLENARY_QUESTION = re.compile(r"(?:(?:Vraag van|Question de)\s)?([^\n]+?)\s+(?:aan|à)\s+([^\n]+?)\s*\([^)]*\)\s*(?:over|sur)\s*(.+?)(?:\s*\((\d{8}[A-Z])\))?\s*$", re.M)
COMMISSION_QUESTION = re.compile(r"""(?:(?:Vraag van|Question de)\s)?([^\n]+?)(?:\s+(?:aan|à|au)\s+([^\n]+?))?(?:\s*\(.*?\))?\s*(?:over|sur)\s*["'“”](.+?)["'“”]\s*\(?(?:n[°ro]\.?\s*)?(\d{6,8}[A-Za-z])\)?""")
SPEAKER = re.compile(r"(?:^|NEWPARAGRAPH)[\n\r\s ]*(\d{2}\.\d{2})[\n\r\s ]+([^:]+):|(?:Le  président|De  voorzitter)\s*:", re.M)
TITLES = re.compile(r"^(Minister|De heer|Mevrouw|Le ministre|La ministre|Monsieur|Madame|Eerste minister|Staatssecretaris)\s+")
PROPOSITION = re.compile(r"^(.+?)\s*\((\d+)/(\d+(?:-\d+)?)\)")
VOTE_OF_DOSSIER = re.compile(r"(.*)\((\d+)/(\d+(?:-\d+)?)\)\s*\Z")
VOTE_OF_MOTION = re.compile(r"(.*)\s+\((?:nr\.|n°)\s*(\d+)\)\s*\Z")
VOTE_PARAGRAPH = re.compile(r"\(\s*\d{1,5}(?:\s*/\s*\d{1,5}(?:\s*-\s*\d{1,5})?)?\s*\)\s*\Z")
VOTE_REFERENCE = re.compile(r"\(Stemming/vote (\d+)\)")
DATE_IN_WORDS = re.compile(r"(\d{1,2})\s+([a-zA-Z]+)\s+(\d{4})")
PLENARY_TIME = re.compile(r"(\d{1,2})\.(\d{2})\s*uur")
COMMISSION_TIME = re.compile(r"(\d{1,2})[.:](\d{2})\s*uur\b")
CHAIRED_BY = re.compile(r"voorgezeten\s+door\s+([^.]+?)\s*(?:\.|\Z)", re.I)
CHAIR_TITLES = re.compile(r"\b(?:de\s+)?(?:mevrouw|heer|mevrouwen|heren)\b", re.I)
CLOSINGS = ("Het incident is gesloten.", "L'incident est clos.")
PARAGRAPH = "NEWPARAGRAPH"
MISSPELT = {"Steven Coengrachts": "Steven Coenegrachts", "Ridouhane Chahid": "Ridouane Chahid"}
REDIRECT = re.compile(
    r"(?:tekst aangenomen door de plenaire vergadering\s+is dezelfde als de tekst aangenomen(?:\s+in tweede lezing)?\s+door de commissie"
    r"|texte adopt[eé] (?:en s[eé]ance pl[eé]ni[eè]re|par la s[eé]ance pl[eé]ni[eè]re)\s+est identique au texte adopt[eé] par la commission)"
    r"\s*\(?DOC\s+(\d+)\s+(\d+)/(\d{3,4})\)?",
    re.I | re.S,
)


def clean(text: str) -> str:
    """M01 on a string."""
    return text.translate({10: " ", 0xA0: " ", 0xAD: None}).strip()


def squash(text: str) -> str:
    return " ".join(text.split())


def turn_name(name: str) -> str:
    """M10 on a string."""
    *rest, last = name.split() or [""]
    return " ".join([last, *rest])


def turn_names(names: str) -> str:
    """M12 on a string."""
    return ", ".join(turn_name(n) for n in names.split(","))


def is_dutch(text: str) -> bool:
    """F06 on a string."""
    bare = (re.sub(r"^[\W\d_]+|[\W\d_]+$", "", w) for w in text.lower().split())
    return any(w in DUTCH for w in bare)


def is_french(text: str) -> bool:
    """F05 on a string."""
    low = text.lower()
    return any(p in low for p in FRENCH) or (any(c in ACCENTED for c in low) and not is_dutch(text))


def iso_date(text: str) -> str | None:
    """First ``d month yyyy`` of a text as ISO date (M08); the day is padded, not validated."""
    m = DATE_IN_WORDS.search(text)
    if not m or m[2].lower() not in MONTHS:
        return None
    return f"{m[3]}-{MONTHS.index(m[2].lower()) + 1:02d}-{int(m[1]):02d}"


def _collected(rows: list[tuple[str, str, str, str]]) -> dict[str, list[str]]:
    return {
        "questioners": [r[0] for r in rows],
        "respondents": list(dict.fromkeys(r[1] for r in rows)),
        "topics": [r[2] for r in rows],
        "ids": [r[3] for r in rows],
    }


def plenary_questions(title: str) -> dict[str, list[str]]:
    """All questions of a title of one or more lines; respondents once each."""
    rows = []
    for m in PLENARY_QUESTION.finditer(title):
        who = m[1].strip().replace("- ", "")
        rows.append((MISSPELT.get(who, who), m[2].strip(), m[3].strip(), f"Q{m[4]}" if m[4] else ""))
    return _collected(rows)


def commission_questions(title: str) -> dict[str, list[str]]:
    """P20: as P19 with quoted topics and optional respondents."""
    rows = [(m[1].strip().replace("- ", "").replace("de heer ", ""), (m[2] or "Onbekend").strip(), m[3].strip(), f"Q{m[4].strip()}") for m in COMMISSION_QUESTION.finditer(title)]
    return _collected(rows)


def speaker_turns(text: str, fixed: bool = False) -> list[tuple[str, str]]:
    """(speaker, text) of each turn with text.

    Only the last turn's paragraph separators become newlines; ``fixed`` turns all.
    """
    text, out = clean(text), []
    marks = list(SPEAKER.finditer(text))
    for k, m in enumerate(marks):
        last = k + 1 == len(marks)
        said = text[m.end() : len(text) if last else marks[k + 1].start()]
        for phrase in CLOSINGS:
            said = said.replace(phrase, "")
        if last or fixed:
            said = said.replace(PARAGRAPH, "\n")
        name = "Voorzitter"
        if m[2] is not None:
            bare = re.match(r"[^(,:\n\r]+", TITLES.sub("", m[2].strip()))
            name = bare[0].strip() if bare else "Onbekend"
        if said.strip() and name:
            out.append((name, said.strip()))
    return out


def turns_json(text: str, fixed: bool = False) -> str:
    """The turns as pretty JSON."""
    turns = [{"speaker": s, "text": t} for s, t in speaker_turns(text, fixed)]
    return json.dumps(turns, indent=2, ensure_ascii=False)


def proposition(text: str) -> tuple[str, str, str]:
    """(topic, dossier, document); the document loses a leading ``1-``."""
    m = PROPOSITION.search(text)
    if m:
        return m[1].strip(), m[2], m[3].removeprefix("1-")
    return text.split("(", 1)[0].strip(), "", ""


def vote_title(text: str) -> tuple[str, str, str, str]:
    """(topic, dossier, document, motion); titles of several lines keep their topic only."""
    if m := VOTE_OF_DOSSIER.match(text):
        return m[1].strip(), m[2], m[3], ""
    if m := VOTE_OF_MOTION.match(text):
        return m[1].strip(), "", "", m[2]
    return text.split("(", 1)[0].strip(), "", "", ""


def chair_names(text: str) -> str:
    """The chairs that a text names, joined by comma and space; empty if none."""
    m = CHAIRED_BY.search(text)
    names = [CHAIR_TITLES.sub("", part.strip()).strip() for part in m[1].replace("\xa0", " ").strip().split(" en ")] if m else []
    return ", ".join(filter(None, names))


def redirect_url(text: str, base: str, session: str = "56") -> str | None:
    """The document that a page cites as the same text."""
    m = REDIRECT.search(text)
    return f"{base}/{session}/{m[2]}/{m[1]}K{m[2]}{m[3]}.pdf" if m else None


TURNS = ArrayType(StructType([StructField("speaker", StringType()), StructField("text", StringType())]))
QUESTIONS = StructType([StructField(x, ArrayType(StringType())) for x in ("questioners", "respondents", "topics", "ids")])


@F.pandas_udf(TURNS)
def turns_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [{"speaker": s, "text": x} for s, x in speaker_turns(t or "")])


@F.pandas_udf(StringType())
def turns_json_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: turns_json(t or ""))


@F.pandas_udf(QUESTIONS)
def plenary_questions_udf(title: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([plenary_questions(t or "") for t in title], columns=["questioners", "respondents", "topics", "ids"])


@F.pandas_udf(QUESTIONS)
def commission_questions_udf(title: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([commission_questions(t or "") for t in title], columns=["questioners", "respondents", "topics", "ids"])
