"""What running streams report, added up by a listener.

``recentProgress`` holds the last hundred batches of a query; a listener hears of all of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Condition

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LATENCY = "etl_latency_ms"


class ProgressTotals(StreamingQueryListener):
    """Sums over all batches of each query: batches, rows read, milliseconds, and every observed number."""

    def __init__(self) -> None:
        self._changed = Condition()
        self._sums: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        with self._changed:
            sums = self._sums[str(seen.runId)]
            sums["batches"] += 1
            sums["rows"] += seen.numInputRows
            sums[LATENCY] += seen.durationMs.get("triggerExecution", 0)
            for name, row in seen.observedMetrics.items():
                for field, value in row.asDict().items():
                    sums[f"{name}.{field}"] += value or 0

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 60.0) -> dict[str, float]:
        """The sums of a query that has ended, once its last event was heard."""
        run = str(query.runId)
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"query {run} reported no end within {seconds} seconds")
            return dict(self._sums[run])


@contextmanager
def listening(spark: SparkSession) -> Iterator[ProgressTotals]:
    """Totals of all queries that run meanwhile."""
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    try:
        yield totals
    finally:
        spark.streams.removeListener(totals)
