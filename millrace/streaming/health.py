"""What streams report of themselves: batches, rows, durations and failures, kept for a while and as a table."""

from __future__ import annotations

from collections import deque
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_TYPE = (
    "query string, batch bigint, `rows` bigint, seconds double, rows_per_second double, waiting double, at string"
)


class Recorder(StreamingQueryListener):
    """The last ``keep`` progress reports of all queries, and the errors with which queries ended.

    Register it with ``spark.streams.addListener``. ``waiting`` is how many rows a second come in beyond
    what is processed: a query that stays above zero falls behind.
    """

    def __init__(self, keep: int = 10_000):
        self.reports: deque[tuple] = deque(maxlen=keep)
        self.failures: deque[tuple[str, str]] = deque(maxlen=keep)
        self.active: set[str] = set()
        self.lock = Lock()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.active.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        speed = p.processedRowsPerSecond or 0.0
        waiting = max(0.0, (p.inputRowsPerSecond or 0.0) - speed)
        took = p.durationMs.get("triggerExecution", 0) / 1000
        with self.lock:
            self.reports.append((p.name or str(p.id), p.batchId, p.numInputRows, took, speed, waiting, p.timestamp))

    def onQueryIdle(self, event) -> None:
        """An idle query reports nothing."""

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.active.discard(str(event.runId))
            if event.exception:
                self.failures.append((str(event.id), event.exception))

    def table(self, spark: SparkSession) -> DataFrame:
        """The reports held, as rows."""
        with self.lock:
            rows = list(self.reports)
        return spark.createDataFrame(rows, PROGRESS_TYPE)


def behind(reports: DataFrame, seconds: float) -> DataFrame:
    """Queries whose last batch took longer than ``seconds`` or that take in more than they process."""
    last = F.max_by(F.struct("batch", "seconds", "waiting"), "at").alias("last")
    found = reports.groupBy("query").agg(last).select("query", "last.*")
    return found.filter((F.col("seconds") > seconds) | (F.col("waiting") > 0))
