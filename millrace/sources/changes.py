"""Change-capture sources: change topics, and table snapshots in the same layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.messages import read_message_files, read_messages, topic_options


@dataclass(frozen=True)
class ChangeSource:
    """Where the change topics of one server live.

    ``servers`` is a broker list; ``folder`` replaces it with landed JSON message files.
    """

    server: str
    servers: str | None = None
    folder: str | None = None


def table_topics(server: str, tables: Sequence[str]) -> list[str]:
    """One topic per ``schema.table``."""
    return [f"{server}.{table}" for table in tables]


def read_changes(
    spark: SparkSession,
    source: ChangeSource,
    tables: Sequence[str] = (),
    start: str = "initial",
    streaming: bool = True,
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """Change records of some tables, or of a whole server without any, as message rows.

    ``max_files`` bounds a batch of landed files, ``max_per_batch`` one of a broker.
    """
    if source.folder:
        rows = read_message_files(spark, source.folder, streaming, max_files)
        if tables:
            return rows.filter(F.col("topic").isin(table_topics(source.server, tables)))
        return rows.filter(F.col("topic").startswith(f"{source.server}."))
    if tables:
        chosen = {"topics": table_topics(source.server, tables)}
    else:
        chosen = {"pattern": source.server.replace(".", "\\.") + "\\..*"}
    return read_messages(
        spark, topic_options(source.servers, start=start, **chosen, **options), streaming
    )


def snapshot_records(rows: DataFrame, server: str, db: str, table: str) -> DataFrame:
    """Rows of a table as ``read`` change records, ready to union with its changes."""
    record = F.struct(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("after"),
        F.struct(F.lit(db).alias("db")).alias("source"),
        F.lit("r").alias("op"),
    )
    return rows.select(
        F.lit(f"{server}.{table}").alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(record).alias("value"),
        # In front of every change.
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; ``split`` is (column, low, high, parts) for parallel readers."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if split:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return {**options, **(extra or {})}


def read_snapshot(
    spark: SparkSession, options: Mapping[str, str], server: str, db: str, table: str
) -> DataFrame:
    """Snapshot of a database table over JDBC as change records."""
    rows = spark.read.format("jdbc").options(**options).load()
    return snapshot_records(rows, server, db, table)
