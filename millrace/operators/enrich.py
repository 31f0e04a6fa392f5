"""Tenant enrichment: latest value per key from a dimension feed, then a left lookup join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import objects
from millrace.lookup import bucketed_join, lookup_join

DIM_TYPE = "database string, guid string, tenantid string"


def dim_writes(
    feed: DataFrame,
    envelope: str = "envelope",
    seq: str | Column = "seq",
    honor_deletes: bool = False,
) -> DataFrame:
    """``(database, kind, value, seq)``: the two mappings that each feed row writes.

    ``DataBase -> guid`` is of kind ``guid`` and ``db_name -> tenant_id`` of kind ``tenant``. Null
    keys are dropped; a null value un-maps its key. Deletes re-put their old value, or remove the
    key when ``honor_deletes``.
    """
    obj = F.col(envelope)
    gone = objects.get_string(obj, "type") == "delete" if honor_deletes else F.lit(False)

    def write(kind: str, key: str, value: str):
        kept = F.when(F.coalesce(gone, F.lit(False)), None).otherwise(objects.get_string(obj, value))
        return F.struct(
            F.lit(kind).alias("kind"),
            objects.get_string(obj, key).alias("database"),
            kept.alias("value"),
            (F.col(seq) if isinstance(seq, str) else seq).alias("seq"),
        )

    both = F.array(write("guid", "DataBase", "guid"), write("tenant", "db_name", "tenant_id"))
    return feed.select(F.inline(both)).filter("database is not null")


def last_writes(writes: DataFrame) -> DataFrame:
    """The write with the latest position per key and kind, un-mapping ones included."""
    last = F.max(F.struct("seq", "value")).alias("last")
    return writes.groupBy("database", "kind").agg(last).select("database", "kind", "last.value", "last.seq")


def latest_dims(
    feed: DataFrame,
    envelope: str = "envelope",
    seq: str | Column = "seq",
    honor_deletes: bool = False,
) -> DataFrame:
    """Dimension ``(database, guid, tenantid)`` from change envelopes; last write per key wins.

    See ``dim_writes`` for what a feed row writes, and ``sources.messages.position`` for the
    position of a change record. The two kinds of key live in two columns and cannot collide.
    """
    writes = dim_writes(feed, envelope, seq, honor_deletes)

    def last(kind: str):
        order = F.when(F.col("kind") == kind, F.struct("seq", "value"))
        return F.max_by("value", order)

    return (
        writes.groupBy("database")
        .agg(last("guid").alias("guid"), last("tenant").alias("tenantid"))
        .filter("guid is not null or tenantid is not null")
    )


def attach(
    facts: DataFrame, dims: DataFrame, key: str, small: bool | None = None, bucketed: bool = False
) -> DataFrame:
    """Add the dimension's columns, prefixed ``dim_``, to plain columns; unmatched rows stay.

    ``bucketed``: the dimension is a catalog table bucketed by ``database`` (``lookup.save_bucketed``).
    """
    names = [c for c in dims.columns if c != "database"]
    table = dims.select(F.col("database").alias(key), *[F.col(c).alias(f"dim_{c}") for c in names])
    return bucketed_join(facts, table, key) if bucketed else lookup_join(facts, table, key, small=small)


def enrich(
    facts: DataFrame,
    dims: DataFrame,
    envelope: str = "envelope",
    tenant: bool = True,
    small: bool | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """Replace ``database`` by the mapped guid and, when ``tenant``, add ``tenantid``.

    Rows without a mapping, or without a ``database``, pass through unchanged.
    """
    columns = ["database", "guid"] + (["tenantid"] if tenant else [])
    keyed = facts.withColumn("_db", objects.get_string(F.col(envelope), "database"))
    joined = attach(keyed, dims.select(*columns), "_db", small=small, bucketed=bucketed)
    added = {"database": F.col("dim_guid")}
    if tenant:
        added["tenantid"] = F.col("dim_tenantid")
    joined = joined.withColumn(envelope, objects.put_strings(F.col(envelope), added))
    return joined.select(*facts.columns)
