"""Taps: numbers seen on the way, of batch jobs and of streams, without a further pass and without printing rows."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

WAIT_SECONDS = 60.0


def tapped(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with a tap. Whatever job runs it first fills ``observation.get``, which waits for that."""
    observation = Observation(name)
    return df.observe(observation, *[metric.alias(key) for key, metric in metrics.items()]), observation


class StreamTaps(StreamingQueryListener):
    """The metrics of every batch of the streams of a session, by the name that they were observed under."""

    def __init__(self) -> None:
        self.batches: dict[str, list[dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            with self._lock:
                self.batches.setdefault(name, []).append(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery) -> None:
        """Until all of an ended query has been reported; reports come behind the query."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(WAIT_SECONDS):
            raise TimeoutError(f"no report of the end of {query.name}")

    def total(self, name: str, metric: str) -> int:
        return sum(batch[metric] or 0 for batch in self.batches.get(name, []))


@contextmanager
def stream_taps(spark: SparkSession) -> Iterator[StreamTaps]:
    """Listens to the streams of ``spark`` for a while."""
    taps = StreamTaps()
    spark.streams.addListener(taps)
    try:
        yield taps
    finally:
        spark.streams.removeListener(taps)
