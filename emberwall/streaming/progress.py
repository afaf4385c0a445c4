"""Streaming progress (ST4/K5): a listener that turns progress events into snapshots.

The reference writes ``total_docs, parts_written, elapsed_sec, rate_rps``
every 100,000 documents. Here Spark's own progress events carry the counts;
the listener accumulates them per query and hands a snapshot to a callback
each time another ``every_docs`` documents have passed.
"""

from __future__ import annotations

import threading
import time
import warnings
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.constants import PROGRESS_EVERY
from ..schemas import PROGRESS_SCHEMA

#: Newest micro-batches kept in detail; totals cover all of them.
BATCHES_KEPT = 1000


class ProgressCollector(StreamingQueryListener):
    """Totals per query from progress events; a snapshot at every multiple of ``every_docs`` documents.

    ``count_parts`` says how many parts have been written when a snapshot is taken.
    """

    def __init__(self, every_docs: int = PROGRESS_EVERY, on_snapshot: Callable[[dict], None] | None = None,
                 count_parts: Callable[[], int] | None = None):
        super().__init__()
        self.every_docs = every_docs
        self.on_snapshot = on_snapshot
        self.count_parts = count_parts
        self.batches: deque[tuple] = deque(maxlen=BATCHES_KEPT)
        self._lock = threading.Lock()
        self._docs: dict[str, int] = {}
        self._done: dict[str, int] = {}
        self._start: dict[str, float] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's callback names
        qid = str(event.id)
        with self._lock:
            self._start[qid] = time.monotonic()
            self._docs[qid] = self._done[qid] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        qid, rows = str(p.id), int(p.numInputRows)
        with self._lock:
            before = self._docs.get(qid, 0)
            self._docs[qid] = before + rows
            if rows:
                self._done[qid] = self._done.get(qid, 0) + 1
                self.batches.append((qid, int(p.batchId), rows))
        if (before + rows) // self.every_docs > before // self.every_docs:
            self._emit(qid)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        qid = str(event.id)
        self._emit(qid)
        with self._lock:
            self._ended.add(qid)

    def _emit(self, qid: str) -> None:
        if self.on_snapshot is None:
            return
        try:
            self.on_snapshot(self.snapshot(qid))
        except Exception as error:  # noqa: BLE001 - a failed progress write does not stop the job
            warnings.warn(f"progress of {qid} could not be written: {error}", stacklevel=2)

    def totals(self, qid: str) -> tuple[int, int]:
        """Documents and micro-batches with documents so far."""
        with self._lock:
            return self._docs.get(qid, 0), self._done.get(qid, 0)

    def snapshot(self, qid: str) -> dict:
        """The progress document of one query (wall-clock fields included)."""
        docs, _ = self.totals(qid)
        elapsed = time.monotonic() - self._start.get(qid, time.monotonic())
        return {
            "total_docs": docs,
            "parts_written": self.count_parts() if self.count_parts else 0,
            "elapsed_sec": round(elapsed, 1),
            "rate_rps": round(docs / max(elapsed, 1), 1),
            "updated_at": time.strftime("%Y-%m-%dT%H:%M:%S.000Z", time.gmtime()),
        }

    def wait_ended(self, qid: str, timeout: float = 60.0) -> bool:
        """Listener events arrive asynchronously; wait until the query's end was reported."""
        deadline = time.monotonic() + timeout
        while time.monotonic() < deadline:
            with self._lock:
                if qid in self._ended:
                    return True
            time.sleep(0.05)
        return False

    def to_frame(self, spark: SparkSession, qid: str) -> DataFrame:
        """The latest snapshot of a query as a one-row frame (K5 schema)."""
        snap = self.snapshot(qid)
        return spark.createDataFrame([tuple(snap[f.name] for f in PROGRESS_SCHEMA.fields)], PROGRESS_SCHEMA)


def watched(spark: SparkSession, start: Callable, collector: ProgressCollector):
    """Run ``start()`` (which starts a query and waits for its end) with ``collector`` attached; returns the query."""
    spark.streams.addListener(collector)
    try:
        query = start()
        collector.wait_ended(str(query.id))
        return query
    finally:
        spark.streams.removeListener(collector)
