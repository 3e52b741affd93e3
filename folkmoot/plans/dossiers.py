"""Dossiers and their subdocuments."""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.dom import Node, parse
from .documents import Skipped, good, per_document

ADOPTED = ("ArtikelenAangenomenInPlenum", "AangenomenTekst")
SUBDOCUMENT = "struct<id:string,date:string,type:string,authors:string,file_url:string>"
FIELDS = f"session_id string, id string, last_updated string, title string, authors string, submission_date string, end_date string, vote_date string, document_type string, status string, eurovoc_main_descriptor string, eurovoc_descriptors string, subdocuments array<{SUBDOCUMENT}>"


@lru_cache(4096)
def _rule(raw: str, rules: tuple[tuple[str, str], ...]) -> str:
    low = raw.strip().lower()
    return next((name for keyword, name in rules if keyword in low), "Onbekend")


@lru_cache(4096)
def _date(raw: str) -> str:
    try:
        return datetime.strptime(raw.strip(), "%d/%m/%Y").date().isoformat()
    except ValueError:
        return raw


@lru_cache(4096)
def _author(raw: str) -> str:
    return "government" if any(g in raw.lower() for g in T.GOVERNMENT) else raw.strip().replace(",", "")


def _first_text(node: Node | None) -> str | None:
    texts = node.texts() if node is not None else []
    return texts[0] if texts else None


def subdocuments(cell: Node, base: str, fixed: bool = False) -> list[dict]:
    """Rows of one cell part the records.

    A record needs an id and a date. A type stays for the records after it, until
    another is told; ``fixed`` starts each record without one.
    """
    table = cell.first("table")
    blank = lambda kind: {"id": "", "date": "", "type": kind, "authors": [], "file_url": None}
    out, now, authors, complete = [], blank("Onbekend"), False, False

    def finish() -> None:
        nonlocal now, authors, complete
        out.append({**now, "authors": ",".join(now["authors"])})
        now, authors, complete = blank("Onbekend" if fixed else now["type"]), False, False

    for row in table.select("tr") if table is not None else ():
        cells = [*row.select("td")]
        if len(cells) < 2:
            if complete:
                finish()
            continue
        label, value = cells[0].text().strip().lower(), cells[1].text().strip().lower()
        anchors = [*cells[0].select("a")]
        if anchors and (number := _first_text(anchors[-1])) is not None:
            now["id"] = number.strip().lstrip("0")
        if (kind := cells[1].first("font")) is not None:
            now["type"] = _rule(kind.text(), T.DOCUMENT_TYPES)
            files = [a.attrs["href"] for a in anchors if a.attrs.get("href", "").endswith(".pdf")]
            if files:
                now["file_url"] = files[-1] if files[-1].startswith("http") else base + files[-1]
        if "datum ronddeling" in label:
            now["date"] = _date(value)
        authors = authors or "auteur(s)" in label
        if authors and (name := _first_text(cells[1].first("a"))) is not None:
            now["authors"].append(_author(name))
        complete = complete or bool(now["id"] and now["date"])
    if complete:
        finish()
    return out


def dossier_row(session_id: str, dossier_id: str, last_updated: str, html: str, base: str, fixed: bool = False) -> list[dict]:
    """Label and value cells of the first table's own rows (J10); the last assignment of a field holds."""
    page = parse(html)
    table = page.first("table")
    if table is None:
        raise Skipped("no table")
    out = {"session_id": session_id, "id": dossier_id, "last_updated": last_updated, "title": (_first_text(page.first("#story h4 center")) or "").strip(), "document_type": "Onbekend", "status": "Onbekend", "subdocuments": []}
    out |= dict.fromkeys(("submission_date", "end_date", "vote_date", "eurovoc_main_descriptor", "eurovoc_descriptors"), "")
    names: list[str] = []
    body = table.first("tbody")
    for row in body.children if body is not None else ():
        cells = [*row.select("td")] if isinstance(row, Node) and row.tag == "tr" else []
        if len(cells) < 2:
            continue
        label, value = cells[0].text().strip().lower(), cells[1].text().strip()
        for keyword, field in (("indieningsdatum", "submission_date"), ("stemming kamer", "vote_date"), ("einddatum", "end_date")):
            if keyword in label:
                out[field] = _date(value.lower())
                break
        else:
            if "auteur(s)" in label:
                names += [_author(t) for a in cells[1].select("a") if (t := _first_text(a)) is not None]
                names = names or [_author(t) for t in cells[1].texts() if t.strip()]
            elif "document type" in label:
                out["document_type"] = _rule(value, T.DOCUMENT_TYPES)
            elif "status" in label:
                out["status"] = _rule(value, T.STATUSES)
            elif "subdocumenten" in label:
                out["subdocuments"] = subdocuments(cells[1], base, fixed)
            elif not label:
                told = _rule(value, T.STATUSES)
                out["status"] = out["status"] if told == "Onbekend" else told
            elif "eurovoc-hoofddescriptor" in label:
                out["eurovoc_main_descriptor"] = value.upper()
            elif "eurovoc descriptoren" in label or "eurovoc kandidaat-descriptoren" in label:
                out["eurovoc_descriptors"] = ",".join(s.strip() for s in value.split("|") if s.strip())
    return [{**out, "authors": ",".join(names)}]


def parsed(docs: DataFrame, base: str, fixed: bool = False) -> DataFrame:
    """``docs``: (dossier_id, session_id, last_updated, html); one row each, subdocuments nested."""
    return per_document(docs, ["dossier_id", "session_id", "last_updated", "html"], lambda i, s, u, html: dossier_row(s, i, u, html, base, fixed), FIELDS)


def latest_adopted_text(subs: Column, fixed: bool = False) -> Column:
    """Articles adopted in plenary before adopted texts, then the greatest id as text (``fixed``: as number), the last on ties."""
    own = F.filter(F.transform(subs, lambda s, i: F.struct((s["type"] == ADOPTED[0]).alias("plenary"), (F.coalesce(s["id"].try_cast("long"), F.lit(-1)) if fixed else s["id"]).alias("id"), i.alias("at"), s["type"].alias("type"), s["file_url"].alias("url"))), lambda s: s["url"].isNotNull() & s["type"].isin(*ADOPTED))
    return F.array_max(own)["url"]


def latest_report(subs: Column) -> Column:
    """The last report with a file."""
    return F.try_element_at(F.filter(subs, lambda s: (s["type"] == "Verslag") & s["file_url"].isNotNull()), F.lit(-1))["file_url"]


def dossiers(rows: DataFrame, fixed: bool = False) -> DataFrame:
    """The dossiers table of :func:`parsed` rows."""
    subs = F.col("subdocuments")
    return good(rows).select(
        "session_id", "id", "last_updated", "title", "authors", "submission_date", "end_date", "vote_date", "document_type", "status",
        latest_adopted_text(subs, fixed).alias("latest_adopted_text_url"), latest_report(subs).alias("latest_report_url"), "eurovoc_main_descriptor", "eurovoc_descriptors",
    )


def subdocument_table(rows: DataFrame) -> DataFrame:
    """The subdocuments table of :func:`parsed` rows."""
    return good(rows).select(F.col("id").alias("dossier_id"), F.inline("subdocuments"))
