"""Message-topic sinks, at least once; ids that a repeated batch gives again let readers drop repeats."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.sources.messages import ID_HEADER


def message_rows(
    df: DataFrame, body: str = "body", topic: Column | None = None, key: Column | None = None
) -> DataFrame:
    """``(value[, topic][, key])``; a topic column routes every row, e.g. by its table."""
    columns = [F.col(body).cast("string").alias("value")]
    if topic is not None:
        columns.append(topic.alias("topic"))
    if key is not None:
        columns.append(key.cast("string").alias("key"))
    return df.select(*columns)


def identified(batch: DataFrame, batch_id: int, name: str = "id") -> DataFrame:
    """Messages of a micro-batch with an id each: batch, split and place in the split.

    A batch that runs again after a failure reads the same splits in the same order, so it gives every
    message the id it had. For batches that only select, filter and rewrite rows; behind a shuffle rows
    have no fixed order, and an id must come from their content.
    """
    place = F.monotonically_increasing_id()
    split, ordinal = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    return batch.withColumn(name, F.concat_ws("-", F.lit(batch_id), split, ordinal))


def id_headers(id_col: Column) -> Column:
    """The headers column of a broker's message that carries its id; ``sources.messages.header_id`` reads it."""
    return F.array(F.struct(F.lit(ID_HEADER).alias("key"), F.encode(id_col, "UTF-8").alias("value"))).alias("headers")


def identified_batches(
    messages: DataFrame, write: Callable[[DataFrame], None], name: str = "id"
) -> DataStreamWriter:
    """Write every micro-batch with ids; a repeated batch writes the same ids again."""
    return messages.writeStream.foreachBatch(lambda batch, batch_id: write(identified(batch, batch_id, name)))


def sink_options(
    servers: str, topic: str | None = None, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    if topic:
        options["topic"] = topic
    return {**options, **(extra or {})}


def write_messages(rows: DataFrame, options: Mapping[str, str], fmt: str = "kafka") -> None:
    rows.write.format(fmt).options(**options).save()


def stream_messages(
    rows: DataFrame, options: Mapping[str, str], checkpoint: str, fmt: str = "kafka"
) -> DataStreamWriter:
    """Raw rows of any stream (envelopes, log tails) to a broker."""
    return (
        rows.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    )
