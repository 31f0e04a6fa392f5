"""The two whole flows, as streams: changes to files by table, and changes to typed facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import objects
from millrace.operators import envelope as env
from millrace.operators.enrich import enrich
from millrace.operators.projections import FACT_IMAGE, typed_rows, without_data
from millrace.sinks.files import land_batch, landing_rows
from millrace.streaming.dims import Dimension
from millrace.streaming.jobs import open_dims, per_batch

# Folder, beside those of the tables, for records that could not be read.
ASIDE = "_unusable"


def capture_to_files(
    changes: DataFrame,
    read_dims: Callable[[], DataFrame | Dimension],
    path: str,
    day: Column | None = None,
    tenant: bool = True,
    aside: str | None = None,
) -> DataStreamWriter:
    """Change records to flat envelopes, enriched per batch, as text by table and day.

    The day is the batch's processing date unless given; it is fixed before the batch runs, so a
    repeated batch lands in the same folders. Every batch has its own folders: let the trigger be
    the interval at which files should roll. Records that cannot be read land in the same batch
    below ``aside`` (by default ``<path>-unusable``), each with its topic, key and value.
    """
    day = F.current_date() if day is None else day
    records = env.read_records(changes.withColumn("_day", day))

    def act(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for what follows
        dims, small = open_dims(read_dims)
        try:
            flat = env.flat_envelope(batch).select("envelope", "_day")
            text = env.envelope_text(enrich(flat, dims, tenant=tenant, small=small))
            table = objects.get_string(F.col("envelope"), "table")
            land_batch(landing_rows(text, table=table, day=F.col("_day")), path, batch_id)
            lost = landing_rows(env.quarantine_text(batch), table=F.lit(ASIDE), day=F.col("_day"))
            land_batch(lost, aside or f"{path.rstrip('/')}-unusable", batch_id)
        finally:
            batch.unpersist()
            dims.unpersist()

    return per_batch(records, act)


def capture_to_facts(
    changes: DataFrame, path: str, now: Column | None = None, aside: str | None = None
) -> DataStreamWriter:
    """Change records of the fact table to typed rows in a parquet folder the figures read.

    Rows are partitioned by the day of their date: figures over ``ts="dt"`` read one folder. Every
    batch has its own folders below, so a repeated batch replaces itself. Records that cannot be
    read, or hold no row, land as text below ``aside`` (by default ``<path>-unusable``).
    """
    records = env.read_records(changes, image=FACT_IMAGE)

    def act(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            nested = env.nested_envelope(batch)
            facts = typed_rows(nested, now=now).withColumn("dt", F.to_date("date"))
            (
                facts.withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("dt", "batch_id")
                .parquet(path)
            )
            empty = without_data(nested)
            names = [c for c in ("topic", "key", "value") if c in empty.columns]
            empty = empty.select(F.to_json(F.struct(*names)).alias("body"))
            lost = env.quarantine_text(batch).select("body").union(empty)
            lost = landing_rows(lost, table=F.lit(ASIDE), by_day=False)
            land_batch(lost, aside or f"{path.rstrip('/')}-unusable", batch_id)
        finally:
            batch.unpersist()

    return per_batch(records, act)
