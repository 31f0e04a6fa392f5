"""Left lookup joins against one-row-per-key tables, safe for large tables and hot keys."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

BROADCAST_MAX_ROWS = 2_000_000
# Text bytes; the relation an executor builds from them takes several times as much.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# A key with more than this share of the rows is hot and gets a slot per such share.
HOT_SHARE = 1 / 1000

_UNHASHABLE = ("map<", "variant")


def row_bytes(df: DataFrame) -> Column:
    """Text bytes of a row and a fixed cost per field."""
    size = F.lit(0)
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        text = col.cast("string") if not field.dataType.typeName() == "array" else F.to_json(col)
        size = size + F.lit(16) + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Exact row count and text bytes, from one partially aggregated pass."""
    rows, size = (
        df.select(row_bytes(df).cast("bigint").alias("b")).agg(F.count("*"), F.sum("b")).first()
    )
    return rows, size or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """True when the measured (not estimated) size is below both bounds."""
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def settled(df: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """A computed table, written once, and whether it may be broadcast.

    Measuring a frame and then joining it would otherwise compute it twice.
    """
    table = cut_lineage(df, label)
    return table, fits_broadcast(table)


def _row_number(df: DataFrame) -> Column:
    """Number of a row by its content and input split: a re-run task gives the same, copies of a
    row in other splits give others. Open objects count by their JSON text."""
    content = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if not any(word in f.dataType.simpleString() for word in _UNHASHABLE):
            content.append(col)
        elif f.dataType.typeName() in ("map", "struct", "array", "variant"):
            content.append(F.to_json(col))
    return F.xxhash64(F.spark_partition_id(), *content)


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """``(key, slots)`` of the keys with more than ``HOT_SHARE`` of all rows, so fewer than 1000.

    Rows are counted per key in one pass, combined before the shuffle; a key gets so many slots
    that none holds more than that share.
    """
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    counts = counts.persist(StorageLevel.DISK_ONLY)
    try:
        total = counts.agg(F.sum("_n")).first()[0] or 0
        share = F.col("_n") / F.lit(max(total * HOT_SHARE, 1.0))
        hot = counts.filter(share > 1).select(key, F.ceil(share).cast("int").alias("_slots"))
        return facts.sparkSession.createDataFrame(hot.collect(), hot.schema)
    finally:
        counts.unpersist()


def lookup_join(
    facts: DataFrame, table: DataFrame, key: str, *, small: bool | None = None
) -> DataFrame:
    """Left join to a table with at most one row per ``key``.

    A table whose measured size is small is broadcast and the facts do not move. Otherwise both
    sides are shuffled, with the rows of a hot key spread over slots that each meet a copy of that
    key's one row, and rows without a key spread over slots that meet nothing. A stream cannot count
    its rows first: join it to a large table inside ``foreachBatch`` (``jobs.enriched_batches``).
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return facts.join(F.broadcast(table), key, "left")
    if facts.isStreaming:
        raise ValueError("join a stream to a large table batch by batch, in foreachBatch")
    table = table.filter(F.col(key).isNotNull())
    hot = hot_keys(facts, key)
    slots = F.coalesce("_slots", F.lit(1))
    table = table.join(F.broadcast(hot), key, "left")
    keyed = facts.join(F.broadcast(hot), key, "left")
    keyed = keyed.withColumn("_slots", F.when(F.col(key).isNull(), round(1 / HOT_SHARE)).otherwise(slots))
    # Only rows of hot keys, and rows without a key, are numbered.
    number = F.pmod(_row_number(facts), F.col("_slots")).cast("int")
    keyed = keyed.withColumn("_slot", F.when(F.col("_slots") > 1, number).otherwise(0))
    copies = table.withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1)))
    return keyed.drop("_slots").join(copies.drop("_slots"), [key, "_slot"], "left").drop("_slot")


def save_bucketed(table: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A lookup table in the catalog, its rows in ``buckets`` by key: joins on the key need not move it.

    Take at least as many buckets as shuffles have partitions, or Spark moves both sides to have more.
    """
    writer = table.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def bucketed_join(facts: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join to a bucketed table with at most one row per ``key``, which stays where it is.

    Facts are shuffled to the table's buckets. Rows of hot keys (fewer than 1,000 keys) would all go to
    their key's bucket; they meet a broadcast copy of those keys' rows instead, as do rows without a key.
    """
    if facts.isStreaming:
        raise ValueError("join a stream to a large table batch by batch, in foreachBatch")
    hot = F.broadcast(hot_keys(facts, key).select(key))
    marked = facts.join(hot.withColumn("_hot", F.lit(True)), key, "left")
    warm = F.col("_hot").isNotNull() | F.col(key).isNull()
    few = table.join(hot, key, "left_semi")
    one = marked.filter(warm).drop("_hot").join(F.broadcast(few), key, "left")
    rest = marked.filter(~warm).drop("_hot").join(table.hint("merge"), key, "left")
    return rest.unionByName(one)
