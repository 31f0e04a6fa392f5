"""Message-topic sources. Every option comes from the caller; nothing is built in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of Spark's Kafka source that the transforms use; a file stream with the same
# columns stands in for a broker.
MESSAGE_TYPE = (
    "topic string, key string, value string, partition int, offset bigint, timestamp timestamp"
)

# Name of the message header that carries an id.
ID_HEADER = "id"

START = {"initial": "earliest", "latest": "latest"}


def topic_options(
    servers: str,
    topics: Sequence[str] = (),
    pattern: str | None = None,
    start: str = "initial",
    group: str | None = None,
    max_per_batch: int | None = None,
    extra: Mapping[str, str] | None = None,
    min_per_batch: int | None = None,
    max_wait: str | None = None,
) -> dict[str, str]:
    """Options of a Kafka read: a topic list, or a pattern over per-table topics.

    ``start`` is ``initial`` (snapshot topics from the beginning) or ``latest`` (changes only).
    Progress lives in the query's checkpoint; ``group`` only names the consumer. A batch begins as soon
    as ``min_per_batch`` messages wait **or** ``max_wait`` (such as ``"2000ms"``) has passed since the
    last one, whichever comes first, and takes at most ``max_per_batch``; give both or neither.
    """
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": START[start]}
    if topics:
        options["subscribe"] = ",".join(topics)
    else:
        options["subscribePattern"] = pattern
    if group:
        options["kafka.group.id"] = group
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if bool(min_per_batch) != bool(max_wait):
        raise ValueError("give both min_per_batch and max_wait, or neither")
    if min_per_batch:
        options |= {"minOffsetsPerTrigger": str(min_per_batch), "maxTriggerDelay": max_wait}
    return {**options, **(extra or {})}


def read_messages(
    spark: SparkSession, options: Mapping[str, str], streaming: bool = True
) -> DataFrame:
    """Text rows of a broker with their place in it, in the columns of ``MESSAGE_TYPE``."""
    reader = spark.readStream if streaming else spark.read
    options = dict(options)
    if not streaming and options.get("startingOffsets") == "latest":
        raise ValueError("a batch read cannot start at latest")
    raw = reader.format("kafka").options(**options).load()
    text = [F.col(c).cast("string") for c in ("key", "value")]
    return raw.select("topic", *text, "partition", "offset", "timestamp")


def position() -> Column:
    """Where a message stands in its feed: by time, then by its place in its partition.

    Messages of one key stand in one partition, so of two writes to a key the later one is larger.
    """
    return F.struct("timestamp", "partition", "offset")


def header_id(headers: Column) -> Column:
    """The id in a broker's message headers, null without one; read with the option ``includeHeaders``."""
    found = F.filter(headers, lambda h: h["key"] == ID_HEADER)
    return F.get(found, F.lit(0))["value"].cast("string")


def read_once(messages: DataFrame, delay: str, id_col: str = "id", time_col: str = "timestamp") -> DataFrame:
    """A stream of messages without those whose id came before, for a topic that is written at least once.

    ``delay`` is how far apart the times of two copies may lie: longer than a failed writer takes to come
    back. Ids are kept in the query's state for that long and then forgotten, so state is bounded by the
    messages of that time. Messages without an id all stay.
    """
    marked = messages.withColumn("_id", F.coalesce(F.col(id_col), F.uuid()))
    return marked.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def read_message_files(
    spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None
) -> DataFrame:
    """The same rows from a folder of JSON files: landed topics, replays, tests.

    A file that does not give a message's place has nulls there.
    """
    if not streaming:
        return spark.read.schema(MESSAGE_TYPE).json(path)
    reader = spark.readStream.schema(MESSAGE_TYPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
