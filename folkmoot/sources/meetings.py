"""Meetings as a stream: the offset is the greatest meeting id, so each run goes on where the last one was committed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .files import last_meeting

Meetings = Callable[[int, int], Iterator[tuple[int, str | None]]]


def one_by_one(fetch: Callable[[int], str | None]) -> Meetings:
    """The ids of a range fetched in turn; one that fails is there without a page, and the others go on."""

    def read(first: int, last: int) -> Iterator[tuple[int, str | None]]:
        for meeting in range(first, last + 1):
            try:
                yield meeting, fetch(meeting)
            except OSError:
                yield meeting, None

    return read


@dataclass
class IdRange(InputPartition):
    """Meetings ``first`` to ``last``, both included."""

    first: int
    last: int


class MeetingReader(DataSourceStreamReader):
    """Offsets are ``{"meeting": id}``: all meetings up to it have been handed on.

    New ids are looked for above the last one found (S10, S11), at most ``most`` of them a batch;
    a batch is dealt in ranges of ``span`` ids. Spark logs a batch's offsets before it reads,
    so a batch that is killed is read again with the same ids.
    """

    def __init__(self, read: Meetings, exists: Callable[[int], bool], start: int, span: int, most: int):
        self.source, self.exists, self.start, self.span, self.most = read, exists, start, span, most
        self.last = start

    def initialOffset(self) -> dict:
        return {"meeting": self.start}

    def latestOffset(self) -> dict:
        limit = self.last + self.most
        self.last = last_meeting(self.last, lambda meeting: meeting <= limit and self.exists(meeting))
        return {"meeting": self.last}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        # after a restart the offsets of the checkpoint may be ahead of what has been looked for
        self.last = max(self.last, end["meeting"])
        firsts = range(start["meeting"] + 1, end["meeting"] + 1, self.span)
        return [IdRange(first, min(first + self.span - 1, end["meeting"])) for first in firsts]

    def read(self, partition: IdRange) -> Iterator[tuple]:
        yield from self.source(partition.first, partition.last)


class MeetingSource(DataSource):
    """``(meeting_id, html)``; ``html`` is null where a meeting could not be had."""

    options_of: tuple

    @classmethod
    def name(cls) -> str:
        return "folkmoot-meetings"

    def schema(self) -> str:
        return "meeting_id long, html string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MeetingReader(*self.options_of)


def meetings(spark: SparkSession, read: Meetings, exists: Callable[[int], bool], start: int = 0, span: int = 100, most: int = 10_000) -> DataFrame:
    """A stream of the meetings after ``start``; the checkpoint of its query is the high-water mark."""
    bound = type("BoundMeetings", (MeetingSource,), {"options_of": (read, exists, start, span, most)})
    spark.dataSource.register(bound)
    return spark.readStream.format(bound.name()).load()
