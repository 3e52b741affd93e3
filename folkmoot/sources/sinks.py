"""Writers: Parquet tables, keyed tables rewritten whole, state and text files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, skip_empty: bool = False) -> bool:
    """Overwrite; ``skip_empty`` leaves the old table if there are no rows."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def rewrite_table(df: DataFrame, path: str) -> None:
    """As ``df`` may read ``path``, write beside it, then change places.

    The old table is moved aside and deleted last: whenever this stops, one of both is whole.
    """
    spark = df.sparkSession
    beside, aside = (f"{path.rstrip('/')}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.write.parquet(beside)
    fs, place = _fs(spark, path)
    new, old = _fs(spark, beside)[1], _fs(spark, aside)[1]
    held = fs.exists(place)
    if held and not fs.rename(place, old):
        raise OSError(f"{path} could not be moved to {aside}")
    if not fs.rename(new, place):
        if held:
            fs.rename(old, place)
        raise OSError(f"{beside} could not take the place of {path}")
    if held:
        fs.delete(old, True)


def write_lines(lines: list[str], spark: SparkSession, path: str) -> None:
    """One file, lines joined by newlines, none at the end."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()


def write_dossier_ids(df: DataFrame, path: str) -> None:
    """``id TAB date``, sorted by bytes. A line for each dossier of a session: small."""
    lines = df.select(F.concat_ws("\t", "dossier_id", "date").alias("line")).orderBy("line").toLocalIterator()
    write_lines([r["line"] for r in lines], df.sparkSession, path)


def write_sorted_dossier_ids(df: DataFrame, folder: str) -> None:
    """K11, O02 for many: the same lines as files below ``folder``, whose names are in the order of what they hold."""
    df.select(F.concat_ws("\t", "dossier_id", "date").alias("line")).orderBy("line").write.mode("overwrite").text(folder)


def write_watermark(spark: SparkSession, value: int, path: str) -> None:
    """K12."""
    write_lines([str(value)], spark, path)


def write_absent_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """A file for each row that has none yet; returns ``(name, written)``. Executors write, by Arrow's file systems."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, top = fs.FileSystem.from_uri(folder)
        made = set()
        for b in batches:
            done = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                path = f"{top}/{key}"
                absent = system.get_file_info(path).type == fs.FileType.NotFound
                if absent:
                    parent = path.rpartition("/")[0]
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    with system.open_output_stream(path, compression=None) as out:
                        out.write((text or "").encode())
                done.append(absent)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done)], names=["name", "written"])

    return df.select(name, content).mapInArrow(run, "name string, written boolean")


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """A file for each row, over what was there: written under a hidden name, then renamed; returns ``name``."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        for b in batches:
            for key, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, path = fs.FileSystem.from_uri(f"{folder}/{key}")
                parent, _, last = path.rpartition("/")
                system.create_dir(parent, recursive=True)
                hidden = f"{parent}/_{uuid.uuid4().hex}"
                with system.open_output_stream(hidden, compression=None) as out:
                    out.write(data.encode() if isinstance(data, str) else data or b"")
                system.move(hidden, f"{parent}/{last}")
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["name"])

    return df.select(name, content).mapInArrow(run, "name string")
