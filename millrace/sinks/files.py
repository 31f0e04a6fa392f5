"""Text files by table and day, and single-file saves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Fixed value: folder for rows that name no table.
UNKNOWN_TABLE = "unknow-source"

MAX_RECORDS_PER_FILE = 5_000_000


def landing_rows(
    df: DataFrame,
    body: str = "body",
    table: Column | None = None,
    day: Column | None = None,
    by_day: bool = True,
    unknown: str = UNKNOWN_TABLE,
) -> DataFrame:
    """``(value, table[, dt])``: the day is the processing date unless one is given."""
    name = F.coalesce(F.col("table") if table is None else table, F.lit(unknown))
    columns = [F.col(body).alias("value"), name.alias("table")]
    if by_day:
        # As text, which is what the folder name holds; streams accept no other type here.
        columns.append(F.date_format(F.current_date() if day is None else day, "yyyy-MM-dd").alias("dt"))
    return df.select(*columns)


def land_by_table(
    rows: DataFrame,
    path: str,
    mode: str = "append",
    rebalance: bool = True,
    max_records: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Write landing rows as text below ``table=.../dt=...``.

    Rebalancing gathers each table and day into files of about the advisory partition size and
    splits the hot ones, so the file count follows the data and not tasks x tables x days.
    """
    parts = [c for c in ("table", "dt") if c in rows.columns]
    if rebalance:
        rows = rows.hint("rebalance", *parts)
    writer = rows.write.mode(mode).partitionBy(*parts).option("maxRecordsPerFile", max_records)
    writer.text(path)


def land_batch(
    rows: DataFrame, path: str, batch_id: int, max_records: int = MAX_RECORDS_PER_FILE
) -> None:
    """Land one micro-batch below ``.../batch_id=N``; a repeated batch replaces its own files."""
    parts = [c for c in ("table", "dt") if c in rows.columns]
    (
        rows.hint("rebalance", *parts)
        .withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*parts, "batch_id")
        .text(path)
    )


def land_stream(
    rows: DataFrame, path: str, checkpoint: str, max_records: int = MAX_RECORDS_PER_FILE
) -> DataStreamWriter:
    """The same layout from a stream, each batch landed by ``land_batch``.

    The rows of a table and day are rebalanced by size, so a small table has few files and a hot one
    as many writers as its rows need. A batch that runs again replaces its own files.
    """
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda batch, batch_id: land_batch(batch, path, batch_id, max_records))


def save_pairs_text(pairs: DataFrame, path: str, files: int | None = None) -> None:
    """Save ``(word, 1)`` rows as text lines of that form, in parallel.

    ``files=1`` gives one file, which takes all rows through one writer: for small results only.
    """
    row = F.concat(F.lit("("), F.concat_ws(",", *[F.col(c).cast("string") for c in pairs.columns]), F.lit(")"))
    lines = pairs.select(row.alias("value"))
    if files:
        lines = lines.coalesce(files)
    lines.write.text(path)
