"""Summary tables kept by the hash of their input, with an injected completion function."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.relational import least_meeting, upsert
from ..sources.completion import RateLimiter, complete

#: Model prompts are the caller's; these are ours.
TOPIC_PROMPT = "Vat de onderwerpen van deze vragen samen in één korte zin."
DISCUSSION_PROMPT = "Vat dit debat samen voor een gewone lezer, in hooguit drie neutrale zinnen."
CONTENT_PROMPT = "Vat deze aangenomen tekst samen in hooguit vier eenvoudige zinnen."
ARGUMENTS_PROMPT = "Geef de standpunten in dit verslag als JSON met de velden title, description, arguments_pro, arguments_contra, arguments_neutral en debate_summary."
LEAST_BYTES = 500
#: Replies that are kept together.
KEPT_EVERY = 5


def eligible(text: Column, task: str) -> Column:
    """topics of several questions, or discussions with turns."""
    bare = T.utrim(text)
    return F.contains(text, F.lit(";")) if task == "topics" else (bare != "[]") & (bare != "")


def pending(rows: DataFrame, cache: DataFrame, column: str, task: str) -> DataFrame:
    """``(input_hash, original, meeting_id)`` still to be summarised: one row for each text, that of its latest meeting, the anti-join before any call."""
    hashed = rows.where(eligible(F.col(column), task)).select(F.sha2(column, 256).alias("input_hash"), F.col(column).alias("original"), "meeting_id")
    place = F.struct(F.coalesce(F.col("meeting_id").try_cast("long"), F.lit(0)), F.col("meeting_id"))
    once = hashed.groupBy("input_hash").agg(F.first("original").alias("original"), F.max_by("meeting_id", place).alias("meeting_id"))
    return once.join(cache.select("input_hash"), "input_hash", "left_anti")


def completed(df: DataFrame, text: str, out: str, completer: Callable[[str, str], tuple[int, str, float | None]], prompt: str, rate: float, journal: str | None = None, callers: int = 1) -> DataFrame:
    """Add the reply for each row; rows without one go, to be tried again in the next run.

    The rows are dealt to ``callers`` tasks that share the rate (S24), so the stages
    above keep their own parallelism. With a ``journal`` folder replies are kept there
    every ``KEPT_EVERY`` rows (K09, K10) as they come: a run that breaks off loses no
    more than those, and rows that have a reply there are not asked again.
    """
    schema = df.withColumn(out, F.lit("")).schema
    spark = df.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limiter = RateLimiter(rate / callers)
        for b in batches:
            for lo in range(0, len(b), KEPT_EVERY):
                rows = b.slice(lo, KEPT_EVERY)
                said = [complete(completer, prompt, x, limiter) for x in rows.column(rows.schema.get_field_index(text)).to_pylist()]
                full = pa.RecordBatch.from_arrays([*rows.columns, pa.array(said, pa.string())], names=[*rows.schema.names, out])
                full = full.filter(pa.array([x is not None for x in said]))
                if journal is not None and len(full):
                    _keep(full, journal)
                yield full

    if journal is None:
        return df.repartition(callers).mapInArrow(run, schema)
    fs = spark._jvm.org.apache.hadoop.fs.Path(journal)
    system = fs.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = lambda: spark.read.schema(schema).parquet(journal)
    wanted = df.join(kept().select(text), text, "left_anti").select(*df.columns) if system.exists(fs) else df
    wanted.repartition(callers).mapInArrow(run, schema).write.format("noop").mode("overwrite").save()
    if not system.exists(fs):
        return spark.createDataFrame([], schema)
    return kept().join(df.select(text), text, "left_semi").dropDuplicates([text]).select(*schema.names)


def _keep(rows: pa.RecordBatch, journal: str) -> None:
    """One file of the journal, whole or not there: written under a hidden name, then renamed."""
    from pyarrow import fs, parquet

    name = uuid.uuid4().hex
    system, folder = fs.FileSystem.from_uri(journal)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/_{name}") as sink:
        parquet.write_table(pa.Table.from_batches([rows]), sink)
    system.move(f"{folder}/_{name}", f"{folder}/{name}.parquet")


def refreshed(cache: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """A10: known texts get the least meeting that has them now; others keep theirs."""
    now = least_meeting(rows.select(F.sha2(column, 256).alias("input_hash"), F.col("meeting_id").alias("_m")), "input_hash", "_m")
    return cache.join(now, "input_hash", "left").withColumn("meeting_id", F.coalesce("_m", "meeting_id")).drop("_m")


def summarise(rows: DataFrame, cache: DataFrame, column: str, task: str, completer, model: str, rate: float, now: str, prompt: str | None = None, journal: str | None = None) -> DataFrame:
    """The summary table after a run: known rows refreshed, new ones added."""
    prompt = prompt or (TOPIC_PROMPT if task == "topics" else DISCUSSION_PROMPT)
    new = completed(pending(rows, cache, column, task), "original", "reply", completer, prompt, rate, journal)
    fresh = new.select("input_hash", "original", T.strip_markdown(F.col("reply")).alias("summary"), F.lit(model).alias("model"), "meeting_id", F.lit(now).alias("created_at"))
    return refreshed(upsert(cache, fresh, "input_hash"), rows, column)


def dossier_inputs(files: DataFrame, kind: str, fixed: bool = False) -> DataFrame:
    """``files``: (dossier_id, name, content). Texts for contents (F12) or arguments.

    Arguments need a report file but read the adopted text; ``fixed`` reads the report.
    """
    texts = files.where(F.col("name") == "adopted_text.md").select("dossier_id", "content")
    if kind == "content":
        chosen = texts.where(T.utrim(F.col("content")) != "").withColumn("source", F.lit("adopted_text.md"))
    else:
        reports = files.where(F.col("name") == "report.md")
        texts = reports.select("dossier_id", "content") if fixed else texts.join(reports.select("dossier_id"), "dossier_id", "left_semi")
        chosen = texts.where(F.octet_length(T.utrim(F.col("content"))) >= LEAST_BYTES).withColumn("source", F.lit("report.md"))
    return chosen.withColumn("summary_hash", F.sha2("content", 256))


def summarise_dossiers(files: DataFrame, cache: DataFrame, kind: str, completer, model: str, rate: float, now: str, fixed: bool = False, journal: str | None = None) -> DataFrame:
    """dossier_content or dossier_arguments after a run."""
    column = "summary" if kind == "content" else "arguments"
    wanted = dossier_inputs(files, kind, fixed).dropDuplicates(["summary_hash"]).join(cache.select("summary_hash"), "summary_hash", "left_anti")
    new = completed(wanted, "content", "reply", completer, CONTENT_PROMPT if kind == "content" else ARGUMENTS_PROMPT, rate, journal)
    reply = F.col("reply") if kind == "content" else T.arguments_json(F.col("reply"))
    fresh = new.select("summary_hash", reply.alias(column), F.lit(model).alias("model"), "dossier_id", "source", F.lit(now).alias("created_at"))
    return upsert(cache, fresh, "summary_hash")
