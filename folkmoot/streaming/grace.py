"""The freshness rule as keyed state: a dossier asks to be fetched again when its week has ended."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

if TYPE_CHECKING:
    import pandas as pd

WEEK = 7
REQUESTS = "dossier_id string, fetched string, meeting string"
#: Timers need this store.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Dossiers are kept in so many buckets by the hash of their id: a bucket is one key of the state, and has one timer.
BUCKETS = 1024
_HELD = pa.schema([("dossier_id", pa.string()), ("fetched", pa.string()), ("meeting", pa.string()), ("due", pa.int64())])


def _day(text: str | None) -> date | None:
    try:
        return date.fromisoformat(text or "")
    except ValueError:
        return None


def within_week(fetched: str | None, meeting: str | None) -> bool:
    """Whether a dossier was fetched less than a week from its meeting, when the page may still change."""
    a, b = _day(fetched), _day(meeting)
    return a is not None and b is not None and abs((a - b).days) < WEEK


@lru_cache(1 << 16)
def _due(fetched: str | None, meeting: str | None) -> int | None:
    """When a dossier asks, in milliseconds: 0 at once, at its week's end, or null for never."""
    if fetched is None or (meeting is not None and fetched < meeting):
        return 0
    if within_week(fetched, meeting):
        end = datetime.combine(_day(meeting) + timedelta(days=WEEK), datetime.min.time(), timezone.utc)
        return int(end.timestamp() * 1000)
    return None


def _latest(a: str | None, b: str | None) -> str | None:
    return b if a is None else a if b is None or a > b else b


class Grace(StatefulProcessor):
    """State: each dossier's last fetch and last meeting, and when it asks next; a bucket's dossiers together, as one value.

    One never fetched, or fetched before its meeting, asks at once. One fetched within a week after
    it asks at the week's end, unless it has been fetched since; a later fetch or meeting
    takes that back. What was fetched today does not ask. A bucket's timer is that of the
    first dossier to ask: a call of the store for each dossier would cost more than all else.
    """

    def __init__(self, today: str | None = None):
        self.today = today

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "dossiers binary")

    def _known(self) -> dict[str | None, tuple[str | None, str | None, int | None]]:
        kept = self.held.get()
        if kept is None or kept[0] is None:
            return {}
        columns = pa.ipc.open_stream(bytes(kept[0])).read_all().columns
        ids, *told = (c.to_pylist() for c in columns)
        return dict(zip(ids, zip(*told)))

    def _keep(self, known: dict[str | None, tuple[str | None, str | None, int | None]]) -> None:
        """The state written, and the timer of the first dossier to ask."""
        columns = [[*known], *map(list, zip(*known.values()))]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _HELD) as out:
            out.write_table(pa.table(columns, schema=_HELD))
        self.held.update((sink.getvalue().to_pybytes(),))
        first = min((due for _, _, due in known.values() if due is not None), default=None)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if first is not None:
            self.handle.registerTimer(first)

    def _asked(self, ids: list[str | None], known: dict[str | None, tuple[str | None, str | None, int | None]], now: int) -> Iterator[pd.DataFrame]:
        import pandas as pd

        today = self.today or datetime.fromtimestamp(now / 1000, timezone.utc).date().isoformat()
        asking = [(i, known[i][0], known[i][1]) for i in ids if known[i][0] != today]
        if asking:
            yield pd.DataFrame(asking, columns=["dossier_id", "fetched", "meeting"], dtype=object)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        text = lambda column: [x if isinstance(x, str) else None for x in column]
        known = self._known()
        touched: dict[str | None, None] = {}
        for part in rows:
            # the latest of each: rows of a batch have no order
            for dossier, fetched, meeting in zip(text(part["dossier_id"]), text(part["fetched"]), text(part["meeting"])):
                had = known.get(dossier, (None, None, None))
                known[dossier] = (_latest(had[0], fetched), _latest(had[1], meeting), None)
                touched[dossier] = None
        at_once = []
        for dossier in touched:
            fetched, meeting, _ = known[dossier]
            due = _due(fetched, meeting)
            if due == 0:
                at_once.append(dossier)
            known[dossier] = (fetched, meeting, due or None)
        self._keep(known)
        yield from self._asked(at_once, known, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, now = self._known(), timerValues.getCurrentProcessingTimeInMs()
        ended = [i for i, (_, _, due) in known.items() if due is not None and due <= now]
        self._keep(known | {i: (*known[i][:2], None) for i in ended})
        yield from self._asked(ended, known, now)

    def close(self) -> None:
        pass


def refetches(stream: DataFrame, today: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Requests of a stream of ``(dossier_id, fetched, meeting)``, ISO dates or null; ``today`` stands in for the clock's day.

    A batch reads and writes the buckets of its dossiers. ``buckets`` belongs to the state: a checkpoint keeps its number.
    """
    stream.sparkSession.conf.set(*PROVIDER)
    bucket = F.pmod(F.xxhash64("dossier_id"), F.lit(buckets)).cast("int")
    return stream.select("dossier_id", "fetched", "meeting", bucket.alias("bucket")).groupBy("bucket").transformWithStateInPandas(Grace(today), REQUESTS, outputMode="append", timeMode="ProcessingTime")
