"""Several streaming queries as one: progress of all, and an end to all when one fails."""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS_DDL = "query string, run string, batch long, started string, input_rows long, seconds double, failure string"

# Events come on a thread of their own; a query whose event is late is looked at after so long.
_LOOK_AGAIN = 1.0


class _Watch(StreamingQueryListener):
    """Batches of all queries, and a signal when one ends."""

    def __init__(self):
        self.batches: dict[tuple[str, int], dict] = {}
        self.changed = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.note(str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.batchDuration)

    def onQueryTerminated(self, event) -> None:
        self.changed.set()

    def note(self, run: str, batch: int, started: str, rows: int, milliseconds: int | None) -> None:
        if rows:
            self.batches[run, batch] = {"started": started, "input_rows": int(rows), "seconds": (milliseconds or 0) / 1000}


class Supervisor:
    """Use as a context around the start of queries and ``finish``; it listens while it is open.

    counts: a folder to which a row per batch with input is appended in the end, and one
    per failed query: which query, which batch, when, rows, seconds, failure.
    """

    def __init__(self, spark: SparkSession, counts: str | None = None):
        self.spark = spark
        self.counts = counts
        self.watch = _Watch()

    def __enter__(self) -> Supervisor:
        self.spark.streams.addListener(self.watch)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self.watch)

    def finish(self, *queries: StreamingQuery, names: Sequence[str] = (), timeout: float | None = None) -> dict[str, int]:
        """Wait until all have ended; returns the rows that each has read, by name.

        When one fails, the others are stopped and its exception is raised, whichever it is
        and whatever the others do. So it is when ``timeout`` seconds are over.
        """
        names = list(names) or [q.name or str(q.id) for q in queries]
        until = None if timeout is None else time.monotonic() + timeout
        failed = None
        try:
            while failed is None and any(q.isActive for q in queries):
                left = _LOOK_AGAIN if until is None else min(_LOOK_AGAIN, until - time.monotonic())
                if left <= 0:
                    raise TimeoutError(f"streams did not end within {timeout} s: {[n for n, q in zip(names, queries, strict=True) if q.isActive]}")
                self.watch.changed.wait(left)
                self.watch.changed.clear()
                failed = next((q for q in queries if not q.isActive and q.exception() is not None), None)
            failed = failed or next((q for q in queries if q.exception() is not None), None)
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
            self._settle(queries)
            rows = self._rows(queries, names)
            if self.counts and rows:
                table = self.spark.createDataFrame(rows, COUNTS_DDL)
                table.coalesce(1).write.mode("append").parquet(self.counts)
        if failed is not None:
            raise failed.exception()
        return {n: sum(r[4] for r in rows if r[0] == n) for n in names}

    def _settle(self, queries: Sequence[StreamingQuery]) -> None:
        """Events of the last batches may be on their way; the queries know these themselves."""
        for q in queries:
            for p in q.recentProgress:
                self.watch.note(str(p["runId"]), p["batchId"], p["timestamp"], p["numInputRows"], p.get("batchDuration"))

    def _rows(self, queries: Sequence[StreamingQuery], names: Sequence[str]) -> list[tuple]:
        out = []
        for name, q in zip(names, queries, strict=True):
            run = str(q.runId)
            for (of, batch), own in sorted(self.watch.batches.items()):
                if of == run:
                    out.append((name, run, batch, own["started"], own["input_rows"], own["seconds"], None))
            if q.exception() is not None:
                out.append((name, run, None, None, 0, None, str(q.exception())[:2000]))
        return out
