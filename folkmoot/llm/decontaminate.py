"""Benchmark decontamination as a prefix-filtered set join; SQL functions only.

A window is ``size`` consecutive words of an item (all words of a shorter item).
Its tokens are its shingles of ``SHINGLE`` words (a shorter window is one shingle).
All of them must stand in a document for the window to occur there, so the rarest
one is a necessary prefix: rarity is counted over all documents. One pass over the
documents finds the places of all shingles that the benchmark has; the prefix
shingles' places give the possible starts, the document's bounds discard those that
leave it, and in the documents left each window is compared word for word with the
words there.

Hashes of shingles, prefixes, windows and candidates are broadcast only where they
take at most ``BROADCAST_BYTES``; beyond that the same joins are shuffled.

Edge cases: null and word-less texts have no words and no hits; word-less items
are no items; repeated documents are each reported; repeated items count once by
id, items with a null id hit words but have no id to list; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, packed, row_key, unpacked, written

SIZE, SHINGLE, BROADCAST_BYTES = 10, 5, 32 << 20
#: All ASCII characters but digits and lower-case letters.
SEPARATORS = r"[\x00-/:-`{-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) maximal runs of digits, letters and non-ASCII characters."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once a row however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def shingles(w: Column, n: int) -> Column:
    """The 64-bit hashes of ``n`` consecutive words, in order."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(n))))
    return F.when(F.size(w) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def small(df: DataFrame, size: Column) -> DataFrame:
    """``df`` marked for broadcast, if ``size`` summed over its rows is at most ``BROADCAST_BYTES``."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """``(win_id, win, len)``, the distinct windows as text, and ``(win_id, item)``, ids as strings."""

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1)))
        return F.when(F.size(w) > 0, F.transform(starts, lambda s: F.array_join(F.slice(w, s, size), " ")))

    each = written(benchmark.select(F.col(id_col).cast("string").alias("item"), F.explode(once(words(F.col(text_col)), cut)).alias("win")).distinct(), "windows")
    wins = written(each.select("win").distinct().select(F.monotonically_increasing_id().alias("win_id"), "win", F.size(F.split("win", " ")).alias("len")), "window-ids")
    return wins, each.where("item is not null").withColumnRenamed("win", "w").join(wins, F.col("w") == F.col("win")).select("win_id", "item")


def met(docs: DataFrame, tokens: DataFrame, text_col: str, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``(*keys, n_words)`` for each row of ``docs``, and ``(*keys, n_words, pos, sh)`` for each place of a shingle of ``tokens``."""
    sizes = sorted(r["n"] for r in tokens.select("n").distinct().collect())  # at most SHINGLE rows
    vocabulary = tokens.select(F.col("sh").alias("known")).distinct()
    every = docs.select(*keys, once(words(F.col(text_col)), lambda w: F.struct(F.size(w).alias("n"), F.concat(F.array().cast("array<bigint>"), *(shingles(w, n) for n in sizes)).alias("sh"))).alias("w"))
    spread = every.select(*keys, F.col("w.n").alias("n_words"), F.posexplode_outer("w.sh").alias("idx", "sh"))
    found = written(spread.join(small(vocabulary, F.lit(64)), F.col("sh") == F.col("known"), "left").where("known is not null or coalesce(idx, 0) = 0"), "shingles")
    # the hashes of each size follow those of the smaller ones
    pos, before = F.lit(None).cast("int"), F.lit(0)
    for n in sizes:
        pos = F.when(F.col("idx") >= before, F.col("idx") - before).otherwise(pos)
        before = before + F.greatest(F.col("n_words") - n + 1, F.lit(0))
    return found.where("coalesce(idx, 0) = 0").select(*keys, "n_words"), found.where("known is not null").select(*keys, "n_words", pos.alias("pos"), "sh")


def prefixes(tokens: DataFrame, places: DataFrame) -> DataFrame:
    """Each window that can occur at all: its rarest shingle and that one's place (from 0)."""
    counted = places.groupBy("sh").agg(F.count("*").alias("c")).withColumnRenamed("sh", "s")
    ranked = tokens.join(counted, F.col("sh") == F.col("s"), "left")
    rare = ranked.groupBy("win_id").agg(F.min_by(F.struct("sh", "at", "len"), F.struct("c", "at")).alias("r"), F.count_if(F.col("c").isNull()).alias("unseen")).where("unseen = 0")
    return rare.select("win_id", F.col("r.sh").alias("rare"), F.col("r.at").alias("at"), F.col("r.len").alias("len"))


def occurrences(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = SIZE, keys: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(*keys, _k, n_words)`` of each row of ``docs`` (keyed by ``_k``); ``(_k, start, len, win_id)`` for each place where a window stands, start from 0; ``(win_id, item)``."""
    wins, items = windows(benchmark, size=size)

    def parts(n: int) -> DataFrame:
        of_size = wins.where(F.col("len") == n if n < SHINGLE else F.col("len") >= n)
        return of_size.select("win_id", "len", F.lit(n).alias("n"), F.posexplode(once(F.split("win", " "), lambda w: shingles(w, n))).alias("at", "sh"))

    lengths = [r["n"] for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("n")).distinct().collect()]  # at most SHINGLE rows
    tokens = parts(SHINGLE)
    for n in lengths:
        tokens = tokens.unionByName(parts(n)) if n < SHINGLE else tokens
    tokens = written(tokens, "tokens")
    rows, places = met(docs, tokens, text_col, (*keys, "_k"))
    prefix = written(prefixes(tokens, places), "prefixes")
    start = F.col("pos") - F.col("at")
    starts = places.join(small(prefix, F.lit(96)), F.col("sh") == F.col("rare")).where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    asked = written(starts.groupBy(F.col("_k").alias("a")).agg(F.collect_set(F.struct(start.alias("start"), "len", "win_id")).alias("c")), "candidates")
    texts = docs.select("_k", text_col)
    if (asked.count() or 1) * 64 <= BROADCAST_BYTES:  # so that only their texts are shuffled, where the candidates themselves are too many
        texts = texts.join(F.broadcast(asked.select("a")), F.col("_k") == F.col("a"), "left_semi")
    said = lambda w: F.transform("c", lambda c: F.struct(c["start"].alias("start"), c["len"].alias("len"), c["win_id"].alias("i"), F.array_join(F.slice(w, c["start"] + 1, c["len"]), " ").alias("said")))
    read = texts.join(small(asked, 32 + 40 * F.size("c")), F.col("_k") == F.col("a")).select("_k", F.explode(once(words(F.col(text_col)), said)).alias("c")).select("_k", "c.*")
    stands = read.join(small(wins.select("win_id", "win"), F.octet_length("win") + 48), (F.col("i") == F.col("win_id")) & (F.col("said") == F.col("win")))
    return rows, written(stands.select("_k", "start", "len", "win_id"), "occurrences"), items


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per row of ``docs``: word counts, items found and whether any was."""
    rows, places, items = occurrences(row_key(docs, id_col, text_col), benchmark, "_text", size, ("_id",))
    spans = places.groupBy("_k", "start").agg((F.col("start") + F.max("len")).alias("end"))
    reached = F.coalesce(F.max("end").over(Window.partitionBy("_k").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached))).groupBy("_k").agg(F.sum("new").alias("n_hit"))
    named = places.select("_k", "win_id").distinct().join(small(items.withColumnRenamed("win_id", "i"), F.octet_length("item") + 48), F.col("win_id") == F.col("i")).groupBy("_k").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = hit.join(named, "_k", "left").select(F.col("_k").alias("_f"), "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return rows.join(small(found, F.lit(64) + F.length(F.array_join("items", ","))), F.col("_k") == F.col("_f"), "left").select(
        F.col("_id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs."""
    keyed = packed(docs, id_col, text_col)
    _, places, _ = occurrences(keyed.select("_k", "_text"), benchmark, "_text", size)
    hit = places.select("_k").distinct()
    return unpacked(keyed.join(small(hit, F.lit(64)), "_k", "left_anti"), docs.columns)
