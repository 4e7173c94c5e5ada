"""Counts of each micro-batch of a stream, as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

ROWS = "query string, batch long, metric string, value long"
#: Rows that came too late, which no observation sees: the state operators count them.
LATE = "late"


def counted(df: DataFrame, name: str) -> DataFrame:
    """The same rows, whose number each micro-batch reports as ``name``."""
    return df.observe(name, F.count("*").alias("rows"))


class BatchMetrics(StreamingQueryListener):
    """Collects what ``counted`` observes, and the rows dropped as late.

    Add it with ``spark.streams.addListener`` before the query starts. It keeps a few
    numbers per micro-batch of the queries that run while it is added; ``take`` hands them out and forgets them, so
    a long-running job stores them from time to time.
    """

    def __init__(self) -> None:
        self._rows: list[tuple[str, int, str, int]] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = {name: row["rows"] for name, row in progress.observedMetrics.items() if "rows" in row}
        found[LATE] = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self._lock:
            self._rows += [
                (str(progress.id), progress.batchId, name, int(value)) for name, value in found.items()
            ]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until the reports of a query that has ended are in."""
        return self._end_of(str(query.runId)).wait(seconds)

    def take(self, spark: SparkSession) -> DataFrame:
        """``query, batch, metric, value`` of all reports since the last call."""
        with self._lock:
            rows, self._rows = self._rows, []
        return spark.createDataFrame(rows, ROWS)
