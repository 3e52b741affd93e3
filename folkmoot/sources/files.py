"""Cached pages and small state files as relations."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as T


def directories(environment: dict[str, str] | None = None) -> tuple[str, str]:
    """(data, cache) from the environment, with defaults."""
    env = os.environ if environment is None else environment
    return env.get("DATA_DIR", "data"), env.get("CACHE_DIR", "scrapers/cache")


def pages(spark: SparkSession, path: str, pattern: str = "*.html", legacy: bool = False) -> DataFrame:
    """``(path, stem, html)`` of the files below ``path`` (S04, S07, S12, S14); ``legacy`` decodes Windows-1252."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    html = T.legacy_text(F.col("content")) if legacy else F.try_validate_utf8(F.col("content").cast("string"))
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("stem"), html.alias("html"))


#: What a task hands on together: files, and bytes of them.
FILES, BYTES = 4096, 4 << 20


def listed_pages(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """``(path, stem, html)`` as :func:`pages` has them, for a folder of millions of files: one task lists the folder, others the folders in it, and read.

    Neither the names nor the files come to the driver, and tasks are not dealt by the files' number. Read by Arrow's file systems. An empty
    file is an empty page; :func:`pages` leaves it out.
    """

    def top(_: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path)
        found = [x for x in system.get_file_info(fs.FileSelector(folder)) if x.base_name[:1] not in ("_", ".")]
        for k in range(0, len(found), FILES):
            part = found[k : k + FILES]
            yield pa.RecordBatch.from_arrays([pa.array([x.path for x in part], pa.string()), pa.array([x.type == fs.FileType.Directory for x in part], pa.bool_())], names=["path", "folder"])

    def read(batches: Iterator) -> Iterator:
        import fnmatch

        import pyarrow as pa
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(path)
        wanted = lambda name: name[:1] not in ("_", ".") and fnmatch.fnmatchcase(name, pattern)

        def below(place: str, folder: bool) -> Iterator[str]:
            if not folder:
                if wanted(place.rpartition("/")[2]):
                    yield place
                return
            for x in system.get_file_info(fs.FileSelector(place)):
                if x.type == fs.FileType.Directory:
                    if x.base_name[:1] not in ("_", "."):
                        yield from below(x.path, True)
                elif wanted(x.base_name):
                    yield x.path

        names: list[str] = []
        held: list[bytes] = []
        size = 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(held, pa.binary())], names=["path", "content"])
        for b in batches:
            for place, folder in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for name in below(place, folder):
                    with system.open_input_stream(name, compression=None) as file:
                        content = file.read()
                    names.append(name)
                    held.append(content)
                    size += len(content)
                    if size > BYTES or len(names) >= FILES:
                        yield batch()
                        names, held, size = [], [], 0
        if names:
            yield batch()

    tasks = max(16, 2 * spark.sparkContext.defaultParallelism)
    places = spark.range(0, 1, 1, 1).mapInArrow(top, "path string, folder boolean").repartition(tasks)
    files = places.mapInArrow(read, "path string, content binary")
    return files.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("stem"), F.try_validate_utf8(F.col("content").cast("string")).alias("html"))


def dossier_pages(spark: SparkSession, path: str) -> DataFrame:
    """Keys from stems of the form ``session_dossier_date``."""
    parts = F.split("stem", "_", 3)
    found = listed_pages(spark, path).where(F.size(parts) == 3)
    return found.select(parts[0].alias("session_id"), parts[1].alias("dossier_id"), parts[2].alias("last_updated"), "html")


def stale(cached: DataFrame, wanted: DataFrame, today: str) -> DataFrame:
    """The dossiers to fetch: not cached, or cached too long ago for their last meeting."""
    have = cached.select(F.col("dossier_id").alias("_d"), F.col("last_updated").alias("fetched"))
    joined = wanted.join(have, F.col("dossier_id") == F.col("_d"), "left")
    return joined.where(F.col("fetched").isNull() | T.needs_refetch(F.col("fetched"), F.col("date"), F.lit(today))).select("dossier_id", "date", "fetched")


def sorted_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, place)`` of text files that were written in order: places from 1, by file name, split and line."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("_n"))
    # a running count within each split, moved on by the splits before it
    split = ["file_path", "file_block_start"]
    own = F.row_number().over(Window.partitionBy(*split).orderBy("_n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = lines.groupBy(*split).agg(F.count("*").alias("n")).select(*split, before.alias("before"))  # a row for each split
    return lines.withColumn("own", own).join(starts, split).select("line", (F.col("before") + F.col("own")).alias("place"))


def dossier_ids(spark: SparkSession, path: str) -> DataFrame:
    """``id TAB date`` lines; blank ones are skipped, a missing date is empty, the last line of an id holds.

    The last line is the one furthest down in the file whose path is greatest; ``path`` may be a
    folder, and files may be read in any number of splits. A task reads each split from its
    start on, so within a split its row ids tell the order, and only there.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", place.alias("_place")).where(T.utrim(F.col("value")) != "")
    parts = F.split("value", "\t", 2)
    rows = lines.select(T.utrim(parts[0]).alias("dossier_id"), T.utrim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("date"), "_place")
    return rows.groupBy("dossier_id").agg(F.max_by("date", "_place").alias("date"))


def watermark(spark: SparkSession, path: str) -> int:
    """The integer in a state file."""
    return int(spark.read.text(path).first()["value"].strip())


def last_meeting(known: int, exists: Callable[[int], bool], misses: int = 1, fixed: bool = False) -> int:
    """Probe upwards until ``misses`` absences in a row.

    After an absence the same id is asked again, so gaps are never crossed;
    ``fixed`` goes on to the next id.
    """
    last, ahead, missed = known, 1, 0
    while missed < misses:
        if exists(last + ahead):
            last, ahead, missed = last + ahead, 1, 0
        else:
            missed += 1
            ahead += int(fixed)
    return last


def dossier_rows(df: DataFrame, only: str | None = None) -> DataFrame:
    """``(id, adopted_text_url, report_url)``, URLs trimmed, empty ones null, rows without either dropped."""
    url = lambda c: F.nullif(T.utrim(F.col(c)), F.lit("")) if c in df.columns else F.lit(None).cast("string")
    out = df.select("id", url("latest_adopted_text_url").alias("adopted_text_url"), url("latest_report_url").alias("report_url"))
    out = out.where(F.coalesce("adopted_text_url", "report_url").isNotNull())
    return out if only is None else out.where(F.col("id") == only)


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """``(dossier_id, name, content)`` of the Markdown files below ``path``, whole."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    name = F.col("_metadata.file_path")
    return files.select(F.regexp_extract(name, r"([^/]+)/[^/]+$", 1).alias("dossier_id"), F.regexp_extract(name, r"([^/]+)$", 1).alias("name"), F.col("value").alias("content"))


def read_through(spark: SparkSession, folder: str, urls: DataFrame | dict[str, str], client: "Client", refetch: DataFrame | frozenset[str] = frozenset(), legacy: bool = False, callers: int = 1) -> DataFrame:
    """The pages of ``urls`` (name, url) below ``folder``; absent ones, and those to ``refetch`` (name), are asked for and kept first.

    What is absent is an anti-join of the names with the folder's listing, so neither comes to the
    driver; the requests are dealt to ``callers`` tasks, whose waits are as much longer. A page that
    cannot be had is left as it was. Small lists may be given as a dict and a set.
    """
    from .sinks import write_files

    wanted = urls if isinstance(urls, DataFrame) else spark.createDataFrame([*urls.items()], "name string, url string")
    again = refetch if isinstance(refetch, DataFrame) else spark.createDataFrame([(n,) for n in refetch], "name string")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name")) if _exists(spark, folder) else wanted.select("name").limit(0)
    absent = wanted.join(listed.join(again, "name", "left_anti"), "name", "left_anti")
    kept = asked(absent, client, callers).where("body is not null").select("name", F.col("body").alias("content"))
    write_files(kept, folder).write.format("noop").mode("overwrite").save()
    return pages(spark, folder, "*", legacy)


def asked(urls: DataFrame, client: "Client", callers: int = 1) -> DataFrame:
    """``urls`` (name, url) with the ``body`` of each url, null where it cannot be had; ``callers`` tasks share the rate of one."""

    def run(batches: Iterator) -> Iterator:
        import random
        import time

        import pyarrow as pa

        for b in batches:
            bodies = []
            for url in b.column(1).to_pylist():
                time.sleep(callers * random.uniform(client.least_wait, client.most_wait))
                try:
                    bodies.append(client.fetch(url))
                except OSError:
                    bodies.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bodies, pa.binary())], names=["name", "url", "body"])

    return urls.select("name", "url").repartition(callers).mapInArrow(run, "name string, url string, body binary")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass
class Client:
    """Who asks, how long to wait between requests, and the transport."""

    agent: str
    fetch: Callable[[str], bytes]
    least_wait: float = 1.0
    most_wait: float = 3.999

    def __post_init__(self) -> None:
        if not self.agent.strip() or "example" in self.agent.lower():
            raise ValueError("the user agent must name a contact")


class UrlSource(DataSource):
    """``(url, body)`` of URLs, by a fetch function; one partition, so that waits between requests hold."""

    client: Client
    urls: tuple[str, ...] = ()

    @classmethod
    def name(cls) -> str:
        return "folkmoot-urls"

    def schema(self) -> str:
        return "url string, body binary"

    def reader(self, schema) -> DataSourceReader:
        return _UrlReader(self.client, self.urls)


class _UrlReader(DataSourceReader):
    def __init__(self, client: Client, urls: tuple[str, ...]):
        self.client, self.urls = client, urls

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import random
        import time

        for url in self.urls:
            time.sleep(random.uniform(self.client.least_wait, self.client.most_wait))
            try:
                yield url, self.client.fetch(url)
            except OSError:
                yield url, None


def fetched(spark: SparkSession, client: Client, urls: list[str]) -> DataFrame:
    source = type("BoundUrls", (UrlSource,), {"client": client, "urls": tuple(urls)})
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()
