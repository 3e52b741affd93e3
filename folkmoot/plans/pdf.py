"""Page-layout blocks to Markdown.

Input rows are text blocks: (doc_id, page_idx, page_w, page_h, block_no, type, bbox
array<double>, lines array<struct<spans array<struct<text, flags, size>>>>). All in the JVM: layout tests
are arithmetic, runs are folded by ``aggregate``, pages are put together by a sorted
collection for each document.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.grammar import REDIRECT
from ..session import work_folder

BLOCKS = "doc_id string, page_idx int, page_w double, page_h double, block_no int, type int, bbox array<double>, lines array<struct<spans:array<struct<text:string,flags:int,size:double>>>>"

# Deletions in this order, letters in either case, line by line.
REMOVED = (
    r"\*?(?:Brussel|Bruxelles)[^*\n]*\d{4}[^*\n]*\*?\n?",
    r"\*?De voorzitt?e?r(?:ster)? van de Kamer[^*\n]*\*?\n?",
    r"\*?van volksvertegenwoordigers,[^*\n]*\*?\n?",
    r"\*?De griffier(?:ster)? van de Kamer[^*\n]*\*?\n?",
    r"\*?L[ae] pr[eé]sident(?:e)? de la Chambre[^*\n]*\*?\n?",
    r"\*?des représentants,[^*\n]*\*?\n?",
    r"\*?L[ae] greffier(?:ère)? de la Chambre[^*\n]*\*?\n?",
    r"^\s*\*{1,2}\s*\*?\s*\*{0,2}\s*$",
    r"\*De rapport(?:eur(?:s)?|rice),\s*De voorzitt?e?r(?:ster)?,\*\n[^\n]+\n?",
    r"\*?Dames en [Hh]eren,\*?\n?",
)


@dataclass(frozen=True)
class Layout:
    """Fractions of the page that are other column, header and footer; the title page has its own."""

    right: float = 0.50
    title_top: float = 0.35
    title_bottom: float = 0.55
    top: float = 0.08
    bottom: float = 0.09
    garbled: float = 0.02


ADOPTED_TEXT, REPORT = Layout(), Layout(top=0.07, bottom=0.08)


def strip_patterns(x: Column) -> Column:
    """The deletions, then one newline at the end."""
    for p in REMOVED:
        x = F.regexp_replace(x, f"(?imuUd){p}", "")
    return F.concat(F.regexp_replace(x, r"(?U)\s+\z", ""), F.lit("\n"))


def block_text(lines: Column) -> Column:
    return F.array_join(F.flatten(F.transform(lines, lambda line: F.transform(line["spans"], lambda s: s["text"]))), " ")


def reason(bbox: Column, page_idx: Column, w: Column, h: Column, layout: Layout) -> Column:
    """F16: why a block goes, or ``kept``; the other column first, then header, then footer.

    Fractions count as the decimals they are written as: 7 % of 800 is 56, and a block that ends there is none of the header.
    """
    top = F.when(page_idx == 0, _part(h, layout.title_top)).otherwise(_part(h, layout.top))
    bottom = F.when(page_idx == 0, _part(h, layout.title_bottom, rest=True)).otherwise(_part(h, layout.bottom, rest=True))
    return (
        F.when((bbox[0] + bbox[2]) / 2 > _part(w, layout.right, rest=True), "right_column")
        .when(bbox[3] < top, "header")
        .when(bbox[1] > bottom, "footer")
        .otherwise("kept")
    )


def _part(length: Column, fraction: float, rest: bool = False) -> Column:
    """A decimal fraction of a length, or what is left of it: rounded once, in the division."""
    part = Fraction(str(fraction))
    part = 1 - part if rest else part
    return length * float(part.numerator) / float(part.denominator)


def default_skip(layout: Layout = ADOPTED_TEXT) -> Column:
    """F14, F15, over a page's ``page_idx`` and text ``t``: committee members (the second page), contents (the third), or garbled text."""
    return (
        ((F.col("page_idx") == 1) & (T.marker_hits(F.col("t"), T.COMMITTEE_MARKERS) >= 2))
        | ((F.col("page_idx") == 2) & (T.marker_hits(F.col("t"), T.CONTENTS_MARKERS) >= 2))
        | (T.garbled_share(F.col("t")) > layout.garbled)
    )


def skipped_pages(blocks: DataFrame, layout: Layout = ADOPTED_TEXT, skip: Column | None = None) -> DataFrame:
    """The pages for which ``skip`` holds: a condition on ``doc_id``, ``page_idx`` and the page's text ``t``; by default :func:`default_skip`."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", block_text(F.col("lines")).alias("t")))), lambda x: x["t"]), "\n")
    pages = blocks.where("type = 0").groupBy("doc_id", "page_idx").agg(said.alias("t"))
    return pages.where(default_skip(layout) if skip is None else skip).select("doc_id", "page_idx")


def block_reasons(blocks: DataFrame, layout: Layout = ADOPTED_TEXT, skip: Column | None = None) -> DataFrame:
    """``(doc_id, page_idx, block_no, bbox, reason, preview)`` of the text blocks."""
    kept = reason(F.col("bbox"), F.col("page_idx"), F.col("page_w"), F.col("page_h"), layout)
    skipped = skipped_pages(blocks, layout, skip).withColumn("_skipped", F.lit(True))
    preview = F.replace(F.left(F.replace(block_text(F.col("lines")), F.lit("\n"), F.lit(" ")), F.lit(80)), F.lit('"'), F.lit("'"))
    return blocks.where("type = 0").join(skipped, ["doc_id", "page_idx"], "left").select("doc_id", "page_idx", "block_no", "bbox", F.when(F.col("_skipped"), "skipped_page").otherwise(kept).alias("reason"), preview.alias("preview"))


def _body(lines: Column) -> Column:
    """Neighbouring spans of equal flags joined, squashed and marked."""
    spans = F.flatten(F.transform(lines, lambda line: line["spans"]))
    empty = F.array().cast("array<struct<text:string,flags:int>>")

    def fold(runs: Column, s: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        joined = F.struct(F.concat(last["text"], s["text"]).alias("text"), last["flags"].alias("flags"))
        alone = F.struct(s["text"].alias("text"), s["flags"].alias("flags"))
        same = (F.size(runs) > 0) & (last["flags"] == s["flags"])
        return F.when(same, F.concat(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(runs, F.array(alone)))

    runs = F.aggregate(spans, empty, fold)
    return T.utrim(F.array_join(F.transform(runs, lambda r: T.emphasised(T.squash(r["text"]), r["flags"])), ""))


def markdown(blocks: DataFrame, layout: Layout = ADOPTED_TEXT, skip: Column | None = None) -> DataFrame:
    """``(doc_id, markdown)``; blocks by page, top and left (O03), headings by the first span's size. ``skip`` says which pages go (§2.13)."""
    kept = reason(F.col("bbox"), F.col("page_idx"), F.col("page_w"), F.col("page_h"), layout) == "kept"
    text = blocks.where("type = 0").join(skipped_pages(blocks, layout, skip), ["doc_id", "page_idx"], "left_anti").where(kept)
    size = F.coalesce(F.try_element_at(F.try_element_at("lines", F.lit(1))["spans"], F.lit(1))["size"], F.lit(0.0))
    prefix = F.when(size >= 12, "## ").when(size >= 11, "### ").otherwise("")
    said = F.when(prefix != "", T.utrim(T.squash(block_text(F.col("lines"))))).otherwise(_body(F.col("lines")))
    placed = text.select("doc_id", F.struct("page_idx", F.col("bbox")[1].alias("y"), F.col("bbox")[0].alias("x"), "block_no", F.concat(prefix, said, F.lit("\n\n")).alias("md")).alias("b"))
    pages = placed.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["md"]), "").alias("markdown"))
    return blocks.select("doc_id").distinct().join(pages, "doc_id", "left").select("doc_id", strip_patterns(F.coalesce("markdown", F.lit(""))).alias("markdown"))


def redirect_target(text: Column, base: str, session: str = "56") -> Column:
    """P29 as a column: the URL of the document that the text cites as its own, or null."""
    pattern = f"(?isuU){REDIRECT.pattern}"
    part = lambda k: F.regexp_extract(text, pattern, k)
    return F.when(part(1) != "", F.concat(F.lit(f"{base}/{session}/"), part(2), F.lit("/"), part(1), F.lit("K"), part(2), part(3), F.lit(".pdf")))


def follow_redirects(documents: DataFrame, base: str, hops: int | None = 3) -> DataFrame:
    """``documents`` (url, text) with ``final_url`` after at most ``hops`` fetches; a chain that leaves the table ends where it left."""
    targets = documents.select(F.col("url").alias("source"), redirect_target(F.col("text"), base).alias("target"))
    ends = chased(targets, hops)
    return documents.select("url").join(ends, F.col("url") == F.col("source"), "left").select("url", F.coalesce("final", "url").alias("final_url"))


def chased(links: DataFrame, hops: int | None = None) -> DataFrame:
    """``(source, final, cyclic)`` for each source of ``links`` (source, target): where its chain is after ``hops`` steps, or ends.

    Pointer jumping: the links of 2, 4, 8, … steps are each made by one join of those before
    with themselves, so a chain of n takes some log2(n) joins. ``hops`` steps are put
    together from its binary digits. Without a bound the jumps go on until a round ends no
    chain: as every place of a chain is a source of its own, only cycles are left then, and what
    runs into them. Their ``final`` is their source.

    Null sources and targets are no links; of several targets of a source the least counts; a
    link to itself is a cycle of one.
    """
    jumps = links.where("source is not null and target is not null").groupBy("source").agg(F.min("target").alias("final"))
    jumps = _written(jumps.withColumn("ended", F.lit(False)), "jumps")
    if hops is not None:
        found, left = None, hops
        while left:
            if left & 1:
                found = jumps if found is None else _jumped(found, jumps)
            left >>= 1
            if left:
                jumps = _written(_jumped(jumps, jumps), "jumps")
        stays = jumps.select("source", F.col("source").alias("final"))
        return (stays if found is None else found.select("source", "final")).withColumn("cyclic", F.lit(False))
    before, open_ = None, jumps.count()
    while open_ and open_ != before:
        jumps = _written(_jumped(jumps, jumps), "jumps")
        before, open_ = open_, jumps.where(~F.col("ended")).count()
    return jumps.select("source", F.when(F.col("ended"), F.col("final")).otherwise(F.col("source")).alias("final"), (~F.col("ended")).alias("cyclic"))


def _jumped(first: DataFrame, then: DataFrame) -> DataFrame:
    """``first`` followed by ``then``; a chain whose place is no source has ended there."""
    onward = then.select(F.col("source").alias("_at"), F.col("final").alias("_to"), F.col("ended").alias("_ended"))
    joined = first.join(onward, ~F.col("ended") & (F.col("final") == F.col("_at")), "left")
    return joined.select("source", F.coalesce("_to", "final").alias("final"), F.coalesce("_ended", F.lit(True)).alias("ended"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its plan does not grow with the rounds."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
