"""A dimension kept up to date by one stream and read by another.

The folder holds tables and a small state file. Every batch writes what it changed as a table of its
own (a delta) and then a new state file, which names all tables that count: the last full one and the
deltas after it. After ``merge_after`` deltas they are merged into a full table. So what a batch or a
reader does besides its own rows is the same after two batches as after two million: one small file is
read, and at most ``merge_after`` + 1 tables in one scan. Each value carries its position in the feed,
and the latest position wins whatever the order of tables, so a batch that runs again, or a new
checkpoint that replays the feed, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from millrace.lookup import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, row_bytes
from millrace.operators.enrich import DIM_TYPE, dim_writes, last_writes
from millrace.session import expire_folders, newest_text, put_text

# Deltas that readers merge before the next full table is written.
MERGE_AFTER = 16
# Seconds after which tables that a full one replaced are deleted; longer than any batch reads.
KEEP_SECONDS = 24 * 3600.0


@dataclass
class Dimension:
    """A dimension as published, and whether it is small enough to broadcast."""

    table: DataFrame
    small: bool


@dataclass
class State:
    """What counts after a batch: its number, the schema of all tables, and ``{name, rows, bytes}`` of each."""

    number: int
    schema: dict | None
    tables: list[dict]

    def text(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema, "tables": self.tables})


def read_state(spark: SparkSession, path: str) -> State:
    """The state as last published; number zero if nothing was yet."""
    text = newest_text(spark, f"{path}/state")
    return State(**json.loads(text)) if text else State(0, None, [])


def _publish(spark: SparkSession, path: str, state: State, table: DataFrame, full: bool) -> State:
    """Write a table under a new name, then the state that names it: a reader sees all of it or nothing."""
    name = f"{'full' if full else 'delta'}-{uuid.uuid4().hex}"
    size = Observation()
    bytes_of = row_bytes(table.drop("seq")).cast("bigint")
    counted = table.observe(size, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bytes_of), F.lit(0)).alias("bytes"))
    counted.write.parquet(f"{path}/tables/{name}")
    entry = {"name": name, **size.get}
    after = State(state.number + 1, json.loads(table.schema.json()), [entry] if full else [*state.tables, entry])
    put_text(spark, f"{path}/state", f"{after.number:020}.json", after.text())
    return after


def _merged(spark: SparkSession, path: str, state: State) -> DataFrame:
    """The last write per key of all tables that count, in one scan of known schema."""
    folders = [f"{path}/tables/{t['name']}" for t in state.tables]
    return last_writes(spark.read.schema(StructType.fromJson(state.schema)).parquet(*folders))


def maintained_dims(
    feed: DataFrame, path: str, seq: str | Column = "seq", honor_deletes: bool = False, merge_after: int = MERGE_AFTER
) -> DataStreamWriter:
    """Fold a feed of envelopes into the latest value per key, published after every batch.

    ``seq`` is the position of a feed row, any comparable type. One query may write to a folder.
    """
    writes = dim_writes(feed, seq=seq, honor_deletes=honor_deletes)

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _publish(spark, path, read_state(spark, path), last_writes(batch), full=False)
        if len(state.tables) > merge_after:
            state = _publish(spark, path, state, _merged(spark, path, state), full=True)
            _expire(spark, path, state)

    return writes.writeStream.foreachBatch(publish)


def _expire(spark: SparkSession, path: str, state: State, keep: float = KEEP_SECONDS) -> int:
    """Delete tables that do not count any more and were written more than ``keep`` seconds ago."""
    return expire_folders(spark, f"{path}/tables", {t["name"] for t in state.tables}, keep)


def read_dims(spark: SparkSession, path: str) -> Dimension:
    """The dimension as last published, with its size known from the state; empty before that."""
    state = read_state(spark, path)
    if not state.tables:
        return Dimension(spark.createDataFrame([], DIM_TYPE), True)
    rows, size = (sum(t[c] for t in state.tables) for c in ("rows", "bytes"))
    last = _merged(spark, path, state)
    of_kind = [F.max(F.when(F.col("kind") == k, F.col("value"))).alias(c) for k, c in (("guid", "guid"), ("tenant", "tenantid"))]
    table = last.groupBy("database").agg(*of_kind).filter("guid is not null or tenantid is not null")
    return Dimension(table, rows <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES)


def snapshot_dims(spark: SparkSession, path: str) -> DataFrame:
    """The published dimension as ``(database, guid, tenantid)``."""
    return read_dims(spark, path).table
