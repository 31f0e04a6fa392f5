"""JDBC sinks: positional facts and dynamic columns. Connection settings come from the caller."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.operators.projections import drop_transient
from millrace.sinks.tables import promote_columns

BATCH_SIZE = 10_000


def positional_rows(
    df: DataFrame, target: Sequence[str] | None = None, excluded: Iterable[str] = ()
) -> DataFrame:
    """Columns in declaration order without the marked ones, renamed to the target by position."""
    rows = drop_transient(df, excluded)
    if target is None:
        return rows
    if len(target) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} values for {len(target)} columns")
    return rows.toDF(*target)


def write_options(
    url: str, table: str, batch: int = BATCH_SIZE, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch), **(extra or {})}


def append_rows(df: DataFrame, options: Mapping[str, str], fmt: str = "jdbc") -> None:
    df.write.format(fmt).options(**options).mode("append").save()


def append_positional(
    df: DataFrame,
    options: Mapping[str, str],
    target: Sequence[str] | None = None,
    excluded: Iterable[str] = (),
) -> None:
    append_rows(positional_rows(df, target, excluded), options)


def append_dynamic(
    df: DataFrame, target: StructType, options: Mapping[str, str], envelope: str = "envelope"
) -> None:
    append_rows(promote_columns(df, target, envelope), options)


def positional_stream(
    df: DataFrame,
    options: Mapping[str, str],
    checkpoint: str,
    target: Sequence[str] | None = None,
) -> DataStreamWriter:
    """Per-batch appends, at least once: a batch may be written again after a failure."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_positional(batch, options, target)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def dynamic_stream(
    df: DataFrame,
    target: StructType,
    options: Mapping[str, str],
    checkpoint: str,
    envelope: str = "envelope",
) -> DataStreamWriter:
    """Per-batch appends of object rows, at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_dynamic(batch, target, options, envelope)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
