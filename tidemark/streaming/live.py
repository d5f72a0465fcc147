"""What a running query does, while it runs."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.apply import BatchResult


class LiveStats(StreamingQueryListener):
    """Totals of the batches a query has published, as soon as they are, and its pace.

    ``run_stream`` reports the batches; the pace comes from the query's progress, of which Spark tells a listener. A batch that
    is tried again counts once, as it is told by its number; what it did when it was published counts.
    """

    def __init__(self, on_batch: Callable[[dict[str, Any]], None] | None = None) -> None:
        self._lock = threading.Lock()
        self._batches: dict[int, BatchResult] = {}
        self._pace: dict[str, Any] = {}
        self._busy = time.monotonic()
        self._on_batch = on_batch
        self.runs: set[str] = set()

    def published(self, batch: int, result: BatchResult) -> None:
        with self._lock:
            self._batches[batch] = result
            self._busy = time.monotonic()
        if self._on_batch:
            self._on_batch(self.totals())

    def totals(self) -> dict[str, Any]:
        """Batches, received, deduped, applied, stale and bad messages, events per kind, and the pace of the last progress."""
        with self._lock:
            whole = BatchResult()
            for result in self._batches.values():
                whole.add(result)
                whole.bad += result.bad
            counts = {c: getattr(whole, c) for c in ("received", "deduped", "applied", "stale", "bad")}
            return {"batches": len(self._batches), **counts, "ops": dict(whole.ops), **self._pace}

    def quiet_for(self) -> float:
        """Seconds since there was anything to do."""
        with self._lock:
            return time.monotonic() - self._busy

    # ---- what Spark tells

    def onQueryStarted(self, event: Any) -> None:
        with self._lock:
            self._busy = time.monotonic()

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        if str(progress.runId) not in self.runs:
            return
        with self._lock:
            if progress.numInputRows:
                self._busy = time.monotonic()
                self._pace = {
                    "rows_per_second": progress.processedRowsPerSecond, "batch_ms": progress.batchDuration,
                }

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


def stop_when_idle(query: StreamingQuery, stats: LiveStats, seconds: float, poll: float = 0.2) -> dict[str, Any]:
    """Waits until a running query has had nothing to do for ``seconds``, stops it, and returns its totals. Fails if it
    does."""
    while query.isActive:
        status = query.status
        busy = status["isTriggerActive"] and status["isDataAvailable"]
        if not busy and stats.quiet_for() >= seconds:
            query.stop()
            break
        time.sleep(poll)
    if error := query.exception():
        raise error
    return stats.totals()
