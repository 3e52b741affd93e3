"""Personal data by patterns, and by bootstrapped contextual extraction; SQL functions only.

Base matches (e-mail, IP, card, phone) are the seeds. The two words before a match
and the two words after it are its lexical patterns. Patterns and instances form a
graph that is scored in turns: a pattern by the share of its distinct instances that
are known for a kind (with at least ``support`` of them), an instance by the patterns
that reach it (noisy or). Tokens with a digit or @ that no base match covers become
known at ``trust``, and count as seeds in the next turn; their places beside such
patterns are the ``context`` spans. Turns end when no score changes any more (scores
only rise, and are rounded). All counts are over all documents.

Places come from marking: matches are enclosed in a private-use character, the
text is split there, and the lengths of the pieces are summed up in order.

Edge cases: null is the empty text; rows equal in id and text are scanned once
and each reported; the marking character in a text is read as another of the
same length; tokens and words of any length count; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, row_key, written

KINDS = ("email", "ip", "card", "phone")
#: Runs begin where no character of their class stands before (or a match ended), and never give back: linear, and equal to the plain patterns' leftmost matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "token": "[0-9@]"}
MARK, STAND_IN = "\ue000", "\ue001"
SUPPORT, TRUST = 5, 0.8


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """Whether a match stands: parts, number of digits, check digit."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    n = F.length(_digits(match))
    return (
        F.when(kind == "ip", match.rlike(rf"^(?:{part}\.){{3}}{part}$"))
        .when(kind == "card", F.when(n.between(14, 19), luhn(_digits(match))).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(True)
    )


def _beside(piece: Column) -> Column:
    """The first two words of a piece that begins with white space, in lower case, one space between them; else empty."""
    return F.regexp_replace(F.lower(F.regexp_extract(piece, r"(?U)^\s++(\S++\s++\S++)", 1)), r"(?U)\s+", " ")


def matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(_k, kind, start, end, match, before, after)`` of base matches and of tokens; ``docs`` keyed by ``_k``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, STAND_IN)).otherwise(text)
    hint = lambda kind: F.contains(F.col("t"), F.lit("@")) if kind == "email" else F.col("t").rlike(HINTS[kind])
    marked = [F.when(hint(k), F.struct(F.lit(k).alias("kind"), F.split(F.regexp_replace("t", p, f"{MARK}$0{MARK}"), MARK).alias("parts"))) for k, p in PATTERNS.items()]
    said = F.col("idx") % 2 == 1
    pieces = (
        docs.select("_k", text.alias("t"))
        .where(F.col("t").rlike("[0-9@]"))
        .select("_k", F.explode(F.filter(F.array(*marked), lambda m: m.isNotNull() & (F.size(m["parts"]) > 1))).alias("m"))
        .select("_k", "m.kind", F.posexplode("m.parts").alias("idx", "piece"))
        .select(
            "_k",
            "kind",
            "idx",
            F.char_length("piece").alias("n"),
            F.when(said, F.col("piece")).alias("match"),
            F.when(~said, F.reverse(_beside(F.reverse("piece")))).alias("last"),
            F.when(~said, _beside(F.col("piece"))).alias("first"),
        )
    )
    in_text = Window.partitionBy("_k", "kind").orderBy("idx")
    placed = (
        pieces.repartition("_k", "kind")
        .dropDuplicates(["_k", "kind", "idx"])
        .withColumn("end", F.sum("n").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.lag("last").over(in_text))
        .withColumn("after", F.lead("first").over(in_text))
        .where("match is not null")
    )
    return placed.where(valid(F.col("kind"), F.col("match"))).select("_k", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "match", "before", "after")


def _free_tokens(found: DataFrame) -> DataFrame:
    """Tokens that no base match overlaps, by one sorted pass over each text's matches."""
    at = Window.partitionBy("_k").orderBy("start")
    base = F.col("kind") != "token"
    reached = F.max(F.when(base, F.col("end"))).over(at.rangeBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(base, F.col("start"))).over(at.rangeBetween(0, Window.unboundedFollowing))
    free = found.withColumn("_reached", reached).withColumn("_next", following).where(~base)
    return free.where((F.coalesce("_reached", F.lit(0)) <= F.col("start")) & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))).drop("_reached", "_next")


def beside(found: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` and ``pattern`` for each lexical pattern of each match: ``<`` and the words before it, ``>`` and those after it."""
    both = F.array(F.concat(F.lit("<"), F.coalesce("before", F.lit(""))), F.concat(F.lit(">"), F.coalesce("after", F.lit(""))))
    return found.select(*columns, F.explode(F.filter(both, lambda p: F.char_length(p) > 1)).alias("pattern"))


def bootstrap(found: DataFrame, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """``(pattern, instance, kind, score)`` of the unseen identifiers that patterns reach.

    ``found`` has rows ``(kind, match, before, after)``, tokens being of kind ``token``.
    """
    graph = written(beside(found, F.lower("match").alias("instance"), "kind").distinct(), "graph")
    edges = written(graph.select("pattern", "instance").distinct(), "edges")
    unseen = graph.where("kind = 'token'").select("pattern", "instance")
    seeds = written(graph.where("kind <> 'token'").select("instance", "kind", F.lit(1.0).alias("score")).distinct(), "seeds")
    reach = written(edges.groupBy("pattern").agg(F.count("*").alias("all")), "reach")
    new, before = None, None
    while True:
        known = seeds if new is None else seeds.unionByName(new.groupBy("instance", "kind").agg(F.max("score").alias("score")))
        patterns = written(
            edges.join(known, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("held"), F.count("*").alias("hits"))
            .where(F.col("hits") >= support)
            .join(reach, "pattern")
            .select("pattern", F.col("kind").alias("k"), F.least(F.lit(0.99), F.round(F.col("held") / F.col("all"), 4)).alias("trusted"))
            .where(F.col("trusted") >= trust),
            "patterns",
        )
        met = unseen.join(patterns, "pattern")
        reached = met.groupBy("instance", "k").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.col("trusted")))), 4).alias("score")).where(F.col("score") >= trust)
        turn = met.join(reached, ["instance", "k"]).select("pattern", "instance", F.col("k").alias("kind"), "score")
        last, new = new, written(turn, "reached")
        after = new.agg(F.count("*").alias("n"), F.sum(F.col("score").cast("decimal(30,4)")).alias("s")).first()
        for done in (last, patterns):
            if done is not None:
                discard(done)
        if after == before or not after["n"]:
            for done in (graph, edges, seeds, reach):
                discard(done)
            return new
        before = after


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """Counts, digest of the base spans, and all spans of each row."""
    keyed = row_key(docs, id_col, text_col)
    every = written(matches(keyed, "_text"), "matches")
    base = every.where("kind <> 'token'")
    free = written(_free_tokens(every), "tokens")
    unseen = bootstrap(base.unionByName(free), support, trust)
    places = beside(free, "_k", "start", "end", F.lower("match").alias("instance"))
    added = places.join(unseen.select("pattern", "instance").distinct(), ["pattern", "instance"], "left_semi").select("_k", "start", "end", F.lit("context").alias("kind")).distinct()
    order = F.array_position(F.array(*map(F.lit, (*KINDS, "context"))), F.col("kind"))
    spans = base.select("_k", "start", "end", "kind").unionByName(added).select("_k", F.struct("start", order.alias("o"), "end", "kind").alias("s")).groupBy("_k").agg(F.array_sort(F.collect_list("s")).alias("s"))
    base_of = F.filter("s", lambda s: s["o"] <= len(KINDS))
    count_of = lambda kind: F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long")
    said = lambda arr: F.array_join(F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    per_row = spans.select(F.col("_k").alias("_f"), *(count_of(k).alias(f"n_{k}") for k in KINDS), said(base_of).alias("base"), said(F.col("s")).alias("spans"))
    return keyed.select(F.col("_id").alias(id_col), "_k").join(per_row, F.col("_k") == F.col("_f"), "left").select(
        id_col,
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
