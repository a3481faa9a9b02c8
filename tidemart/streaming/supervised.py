"""Streams that are started, watched and stopped together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from threading import Event

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryProgress

#: Seconds between looks at queries that have neither failed nor ended.
_LOOK = 1.0


def rows_seen(progress: Iterable[StreamingQueryProgress]) -> int:
    """Rows read from the sources; a self-join reads its source twice."""
    return sum(p.numInputRows for p in progress)


def rows_late(progress: Iterable[StreamingQueryProgress]) -> int:
    """Rows that stateful operators dropped as older than the watermark.

    An aggregation counts the groups of a partition that it dropped, a keyed
    state its rows.
    """
    return sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators)


def watermark(progress: Iterable[StreamingQueryProgress]) -> str | None:
    """The latest watermark, as Spark reports it."""
    return max((p.eventTime["watermark"] for p in progress if "watermark" in p.eventTime), default=None)


class Watch(StreamingQueryListener):
    """What the queries of a group report: rows read and dropped by name, and the first failure."""

    def __init__(self, running: Mapping[str, StreamingQuery]) -> None:
        self.names = {str(q.runId): name for name, q in running.items()}
        self.read, self.late = dict.fromkeys(running, 0), dict.fromkeys(running, 0)
        self.failed: tuple[str, str] | None = None
        self.changed = Event()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        if name := self.names.get(str(event.progress.runId)):
            self.read[name] += rows_seen([event.progress])
            self.late[name] += rows_late([event.progress])

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        if name := self.names.get(str(event.runId)):
            if event.exception and not self.failed:
                self.failed = (name, event.exception)
            self.changed.set()


def await_all(running: Mapping[str, StreamingQuery]) -> Watch:
    """Wait until all queries have ended; as soon as one fails, stop the others and raise.

    A failed query goes on from its checkpoint when the group is started again.
    """
    watch = Watch(running)
    manager = SparkSession.getActiveSession().streams
    manager.addListener(watch)
    try:
        while any(q.isActive for q in running.values()):
            watch.changed.wait(_LOOK)
            watch.changed.clear()
            if any(not q.isActive and q.exception() for q in running.values()):
                break
        failed = {name: q.exception() for name, q in running.items() if not q.isActive and q.exception()}
        if failed:
            name, why = next(iter(failed.items()))
            raise RuntimeError(f"stream {name} failed; all {len(running)} were stopped") from why
        return watch
    finally:
        for query in running.values():
            if query.isActive:
                query.stop()
        manager.removeListener(watch)
