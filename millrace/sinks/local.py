"""Previews, no-op writes, fan-out and dataset controls."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

PREVIEW_ROWS = 10


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First rows, for looking at; the full frame is untouched."""
    return df.limit(n)


def print_rows(df: DataFrame, prefix: str = "", n: int = PREVIEW_ROWS) -> None:
    """Print a preview as ``prefix> row`` lines."""
    mark = f"{prefix}> " if prefix else ""
    for row in preview(df.select(F.to_json(F.struct("*")).alias("j")), n).collect():
        print(mark + row["j"])


def discard(df: DataFrame) -> None:
    """Run the plan and write nothing."""
    df.write.format("noop").mode("overwrite").save()


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Hand one frame to several sinks; computed once, released afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut at a copy in the shared folder."""
    return cut_lineage(df, "checkpointed")


def fewer_files(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions without a shuffle."""
    return df.coalesce(n)


def for_each_row(df: DataFrame, action: Callable) -> None:
    """Run a side effect on every row, in the tasks."""

    def each(rows) -> None:
        for row in rows:
            action(row)

    df.foreachPartition(each)
