"""The tables' raw schemas (all text), typed views of them, and the check of their required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns in order; a question mark marks those that may be null.
RAW = {
    "sessions": "session_id start_date end_date",
    "commissions": "name type chairs subchairs permanent_members replacement_members",
    "lobby": "name contacts interests url",
    "members": "member_id session_id first_name last_name date_of_birth place_of_birth language constituency fraction email active start?",
    "remunerations": "first_name last_name year mandate institute remuneration_min remuneration_max",
    "plenary_meetings": "session_id meeting_id date time_of_day start_time end_time",
    "plenary_questions": "question_id session_id meeting_id questioners respondents topics_nl topics_fr discussion internal_ids",
    "plenary_propositions": "proposition_id session_id meeting_id title_nl title_fr dossier_id document_id",
    "plenary_votes": "vote_id session_id meeting_id date title_nl title_fr yes no abstain members_yes members_no members_abstain dossier_id document_id motion_id",
    "plenary_notices": "notice_id session_id meeting_id title_nl title_fr",
    "commission_meetings": "session_id commission_id date time_of_day start_time end_time commission chair",
    "commission_questions": "question_id session_id meeting_id questioners respondents topics_nl topics_fr discussion dossier_ids",
    "dossiers": "session_id id last_updated title authors submission_date end_date vote_date document_type status latest_adopted_text_url? latest_report_url? eurovoc_main_descriptor eurovoc_descriptors",
    "subdocuments": "dossier_id id date type authors file_url?",
    "summaries": "input_hash original summary model meeting_id? created_at",
    "dossier_content": "summary_hash summary model dossier_id source created_at",
    "dossier_arguments": "summary_hash arguments model dossier_id source created_at",
}
TURNS = "array<struct<speaker:string,text:string>>"


def columns(table: str) -> list[str]:
    return [c.rstrip("?") for c in RAW[table].split()]


def raw(df: DataFrame, table: str) -> DataFrame:
    """The table's columns, in order and as text."""
    return df.select(*(F.col(c).cast("string").alias(c) for c in columns(table)))


def null_counts(df: DataFrame, table: str) -> dict[str, int]:
    """Nulls in each required column."""
    required = [c for c in RAW[table].split() if not c.endswith("?")]
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required)).first().asDict()


def assert_not_null(df: DataFrame, table: str) -> DataFrame:
    """``df``, if no required column of the table has a null: Parquet does not keep that promise."""
    bad = {c: n for c, n in null_counts(df, table).items() if n}
    if bad:
        raise ValueError(f"{table}: nulls in {bad}")
    return df


def _listed(c: str, joiner: str) -> Column:
    return F.filter(F.transform(F.split(c, joiner), F.trim), lambda x: x != "")


def _typed(c: str) -> Column:
    if c in ("yes", "no", "abstain", "year"):
        return F.col(c).try_cast("int")
    if c in ("session_id", "meeting_id", "commission_id", "question_id", "vote_id", "proposition_id", "notice_id"):
        return F.col(c).try_cast("long")
    if c in ("date", "last_updated", "submission_date", "end_date", "vote_date", "date_of_birth", "start"):
        return F.try_to_date(c, "yyyy-MM-dd")
    if c in ("remuneration_min", "remuneration_max"):
        return F.col(c).try_cast("double")
    if c == "active":
        return F.col(c).try_cast("boolean")
    if c in ("topics_nl", "topics_fr"):
        return _listed(c, ";")
    if c in ("questioners", "respondents", "internal_ids", "dossier_ids", "members_yes", "members_no", "members_abstain", "authors", "eurovoc_descriptors", "chairs", "subchairs", "permanent_members", "replacement_members", "contacts"):
        return _listed(c, ",")
    if c == "discussion":
        return F.from_json(c, TURNS)
    return F.col(c)


def typed(df: DataFrame, table: str) -> DataFrame:
    """Numbers, dates, flags, lists and turns of a raw table; what does not parse is null. ``sessions`` dates are years and stay text."""
    own = columns(table)
    keep = {"start_date", "end_date"} if table == "sessions" else set()
    return df.select(*((F.col(c) if c in keep else _typed(c)).alias(c) for c in own))
