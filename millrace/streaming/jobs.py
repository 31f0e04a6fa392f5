"""Stream settings and the jobs that need a per-batch view."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.enrich import enrich
from millrace.operators.words import word_count
from millrace.sinks.local import fan_out, print_rows
from millrace.streaming.dims import Dimension

# Entries of a source list: each is a query, or a reader, that the driver holds open.
MAX_SOURCES = 1000


@dataclass(frozen=True)
class StreamSettings:
    """Checkpoint folder and trigger of one query.

    The folder is fixed per query, so a restart resumes where the last run stopped. ``every`` is a
    processing-time interval such as ``"10 seconds"``; without it the query reads what is there and
    ends. ``run`` restarts a failed query ``retries`` times, ``delay`` seconds after each failure. A batch
    that takes longer than ``batch_timeout`` seconds counts as a failure: it is stopped and runs again.
    """

    checkpoint: str
    every: str | None = None
    retries: int = 3
    delay: float = 0
    batch_timeout: float | None = None

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.every:
            return writer.trigger(processingTime=self.every)
        return writer.trigger(availableNow=True)


def start(writer: DataStreamWriter, settings: StreamSettings) -> StreamingQuery:
    return settings.apply(writer).start()


def run(writer: DataStreamWriter, settings: StreamSettings) -> StreamingQuery:
    """Start and wait; a failed run is started again from its checkpoint."""
    for attempt in range(settings.retries + 1):
        query = start(writer, settings)
        try:
            await_in_time(query, settings.batch_timeout)
            return query
        except Exception:
            if attempt == settings.retries:
                raise
            time.sleep(settings.delay)
    raise ValueError("retries must not be negative")


def await_in_time(query: StreamingQuery, batch_timeout: float | None, poll: float = 0.2) -> None:
    """Wait for a query's end; one whose batch takes longer than ``batch_timeout`` seconds is stopped, an error."""
    if batch_timeout is None:
        query.awaitTermination()
        return
    batch, since = None, time.monotonic()
    while not query.awaitTermination(poll):
        done = query.lastProgress["batchId"] if query.lastProgress else -1
        if done != batch or not query.status["isTriggerActive"]:
            batch, since = done, time.monotonic()
        elif time.monotonic() - since > batch_timeout:
            query.stop()
            raise TimeoutError(f"the batch after {done} took longer than {batch_timeout} seconds")


def stop_after_batch(query: StreamingQuery, patience: float = 600.0, poll: float = 0.05) -> bool:
    """Stop a query between two batches; whether it came to that within ``patience`` seconds.

    A batch that begins in the moment of the stop is cut short and runs again after a restart.
    """
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(poll)
    idle = not (query.isActive and query.status["isTriggerActive"])
    query.stop()
    return idle


def paced(act: Callable[[DataFrame, int], None], pause: float) -> Callable[[DataFrame, int], None]:
    """The same action, begun at least ``pause`` seconds after its last batch ended."""
    ended: list[float] = []

    def later(batch: DataFrame, batch_id: int) -> None:
        if ended:
            time.sleep(max(0.0, ended[-1] + pause - time.monotonic()))
        act(batch, batch_id)
        ended[:] = [time.monotonic()]

    return later


def per_batch(
    stream: DataFrame, act: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(act)


def open_dims(read_dims: Callable[[], DataFrame | Dimension]) -> tuple[DataFrame, bool | None]:
    """The dimension as it stands, and whether it is small (None: not known without measuring).

    Only a table not known to be large is kept for the length of the batch.
    """
    found = read_dims()
    table, small = (found.table, found.small) if isinstance(found, Dimension) else (found, None)
    return (table if small is False else table.persist()), small


def enriched_batches(
    facts: DataFrame,
    read_dims: Callable[[], DataFrame | Dimension],
    write: Callable[[DataFrame, int], None],
    envelope: str = "envelope",
    tenant: bool = True,
) -> DataStreamWriter:
    """Enrich every micro-batch with the dimension as it stands when the batch starts.

    ``read_dims`` is called inside each batch. Rows whose key is not mapped yet pass through
    unchanged and are not corrected later.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        dims, small = open_dims(read_dims)
        # The large join counts its rows before it joins them: the batch is computed once.
        batch = batch if small else batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(enrich(batch, dims, envelope, tenant, small=small), batch_id)
        finally:
            dims.unpersist()
            batch.unpersist()

    return per_batch(facts, act)


def overwrite_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Parquet writer with one folder per batch, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def batch_word_counts(
    lines: DataFrame, path: str, line: str = "value", delimiter: str = ":"
) -> DataStreamWriter:
    """Word counts of each micro-batch on its own, never added up across batches."""
    write = overwrite_batch(path)

    def act(batch: DataFrame, batch_id: int) -> None:
        write(word_count(batch, line, delimiter), batch_id)

    return per_batch(lines, act)


def running_word_counts(lines: DataFrame, line: str = "value", delimiter: str = ":") -> DataFrame:
    """Counts over the whole stream so far, for complete or update mode."""
    return word_count(lines, line, delimiter)


def fan_out_batches(
    stream: DataFrame, sinks: Sequence[Callable[[DataFrame, int], None]]
) -> DataStreamWriter:
    """Hand each micro-batch, computed once, to several sinks.

    A sink gets the batch number too, to replace its own output when a batch runs again.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, [partial(_numbered, sink, batch_id) for sink in sinks])

    return per_batch(stream, act)


def _numbered(sink: Callable[[DataFrame, int], None], batch_id: int, batch: DataFrame) -> None:
    sink(batch, batch_id)


def stamped(df: DataFrame, out: str = "processed_at") -> DataFrame:
    """Add processing time, one value per batch."""
    return df.withColumn(out, F.current_timestamp())


def source_entries(descriptors: DataFrame, most: int = MAX_SOURCES) -> list[Row]:
    """The entries of a source list, which is job configuration; more than ``most`` is an error."""
    entries = descriptors.limit(most + 1).collect()
    if len(entries) > most:
        raise ValueError(f"a source list holds at most {most} entries")
    return entries


def source_streams(
    descriptors: DataFrame, open_source: Callable[[Row], DataFrame], most: int = MAX_SOURCES
) -> list[tuple[Row, DataFrame]]:
    """One stream per entry of a source list, ready to run alone or to union.

    Entries of one server are better read by one subscription: pass their tables to ``read_changes``.
    """
    return [(entry, open_source(entry)) for entry in source_entries(descriptors, most)]


def start_each(
    streams: Sequence[tuple[Row, DataFrame]],
    sink: Callable[[Row, DataFrame], DataStreamWriter],
    settings: Callable[[Row], StreamSettings],
) -> list[StreamingQuery]:
    """An independent query per source, each with its own checkpoint; ``run_each`` also restarts."""
    return [start(sink(entry, stream), settings(entry)) for entry, stream in streams]


def run_each(
    streams: Sequence[tuple[Row, DataFrame]],
    sink: Callable[[Row, DataFrame], DataStreamWriter],
    settings: Callable[[Row], StreamSettings],
    poll: float = 0.5,
) -> None:
    """Run a query per source until all have ended, each restarted as ``run`` does.

    When one has used up its restarts the others are stopped and its error is raised.
    """
    settled = [settings(entry) for entry, _ in streams]
    queries = [start(sink(entry, stream), s) for (entry, stream), s in zip(streams, settled)]
    failures = [0] * len(queries)
    try:
        while True:
            seen = list(failures)
            for i in range(len(queries)):
                failures[i] = _restarted(streams[i], sink, settled[i], queries, i, failures[i])
            if failures == seen and not any(query.isActive for query in queries):
                return
            time.sleep(poll)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def _restarted(source, sink, settings: StreamSettings, queries: list, i: int, failed: int) -> int:
    """Start query ``i`` again if it has failed; the number of its failures so far."""
    error = None if queries[i].isActive else queries[i].exception()
    if error is None:
        return failed
    if failed >= settings.retries:
        raise error
    time.sleep(settings.delay)
    queries[i] = start(sink(*source), settings)
    return failed + 1


def printed(stream: DataFrame, prefix: str = "", n: int = 10) -> DataStreamWriter:
    """Print the first rows of every micro-batch."""
    return per_batch(stream, lambda batch, batch_id: print_rows(batch, prefix, n))


def discarded(stream: DataFrame) -> DataStreamWriter:
    """Run a stream and write nothing."""
    return stream.writeStream.format("noop")
