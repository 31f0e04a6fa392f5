"""Row-wise record transforms; all work on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import objects
from millrace.functions.clock import epoch_millis_text, now_column
from millrace.functions.text import split_tokens

FACT_TYPE = "id string, total_amount bigint, is_new string, pro_cnt bigint, tm string, date timestamp"

# The row image of a fact record, for ``read_records``.
FACT_IMAGE = "struct<id:string,total_amount:string,is_new:string,pro_cnt:string,tm:string>"

TRANSIENT = "transient"


def record_text(df: DataFrame, value: str = "value", out: str = "value") -> DataFrame:
    """Message payload bytes as text."""
    return df.withColumn(out, F.col(value).cast("string"))


def id_only(df: DataFrame, envelope: str = "envelope", out: str = "body") -> DataFrame:
    """``{"id": "<Id>"}`` from a flat envelope; ``{}`` when it has no ``Id``."""
    body = F.to_json(F.struct(objects.get_string(F.col(envelope), "Id").alias("id")))
    return df.withColumn(out, body)


def _whole_number(text: Column) -> Column:
    """Text to bigint, cutting decimals; blank is null and other text is an error."""
    filled = F.when(F.trim(text) != "", F.trim(text))
    return filled.cast("decimal(38,6)").cast("bigint")


def _data(df: DataFrame, envelope: str) -> Column:
    if df.schema[envelope].dataType.typeName() == "string":
        return F.from_json(envelope, f"data {FACT_IMAGE}")["data"]
    return F.col(f"{envelope}.data")


def without_data(df: DataFrame, envelope: str = "envelope") -> DataFrame:
    """The rows that ``typed_rows`` makes no fact of: malformed text, or an envelope without data."""
    return df.filter(_data(df, envelope).isNull())


def typed_rows(df: DataFrame, envelope: str = "envelope", now: Column | None = None) -> DataFrame:
    """Fact rows from the ``data`` of nested envelopes, stamped with processing time.

    The envelope may be a struct, with its data open or as ``FACT_IMAGE``, or still text. Absent
    amounts and counts are 0. An envelope without data is no fact: see ``without_data``.
    """
    # One or no element: a filter would be pushed below the parse and parse again.
    data = _data(df, envelope)
    rows = df.select(F.explode(F.when(data.isNotNull(), F.array(data))).alias("data"))
    if rows.schema["data"].dataType.typeName() == "struct":
        rows = rows.select("data.*")
    else:
        names = ["id", "total_amount", "is_new", "pro_cnt", "tm"]
        rows = rows.select(*[objects.get_string(F.col("data"), n).alias(n) for n in names])
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "id",
        F.coalesce(_whole_number(F.col("total_amount")), zero).alias("total_amount"),
        "is_new",
        F.coalesce(_whole_number(F.col("pro_cnt")), zero).alias("pro_cnt"),
        "tm",
        now_column(now).cast("timestamp").alias("date"),
    )


def flatten(df: DataFrame, envelope: str = "envelope") -> DataFrame:
    """``database, id, age, name, type, table`` from a nested envelope struct."""
    data = F.col(f"{envelope}.data")
    return df.select(
        F.col(f"{envelope}.database").alias("database"),
        objects.get_string(data, "Id").alias("id"),
        objects.get_string(data, "Age").cast("int").alias("age"),
        objects.get_string(data, "Name").alias("name"),
        F.col(f"{envelope}.type").alias("type"),
        F.col(f"{envelope}.table").alias("table"),
    )


def suffix_id(df: DataFrame, envelope: str = "envelope", suffix: str = "f") -> DataFrame:
    """Append text to the ``id`` of an envelope; a missing id counts as the text ``null``."""
    obj = F.col(envelope)
    new_id = F.concat(F.coalesce(objects.get_string(obj, "id"), F.lit("null")), F.lit(suffix))
    return df.withColumn(envelope, objects.put_string(obj, "id", new_id))


def rewrite_event(
    df: DataFrame, body: str = "body", now: Column | None = None, headers: str | None = None
) -> DataFrame:
    """Headers ``timestamp`` and ``table`` from a JSON body, and the body without ``table``.

    The timestamp is the body's ``ModifyTime``, else the current epoch milliseconds. Other
    headers of a ``headers`` map column stay. A malformed body is kept as it is, with no table.
    """
    parsed = df.withColumn("_obj", objects.parse_object(F.col(body)))
    obj = F.col("_obj")
    stamp = F.coalesce(objects.get_string(obj, "ModifyTime"), epoch_millis_text(now))
    own = F.create_map(
        F.lit("timestamp"), stamp, F.lit("table"), objects.get_string(obj, "table")
    )
    if headers:
        kept = F.map_filter(F.col(headers), lambda k, v: ~k.isin("timestamp", "table"))
        own = F.map_concat(kept, own)
    return (
        parsed.withColumn(headers or "headers", own)
        .withColumn(body, F.coalesce(objects.to_text(objects.remove_key(obj, "table")), body))
        .drop("_obj")
    )


def mark_transient(schema: StructType, names: Iterable[str]) -> StructType:
    """Schema copy whose named fields are marked as not to be written."""
    names = set(names)
    out = StructType()
    for field in schema.fields:
        extra = {TRANSIENT: True} if field.name in names else {}
        out.add(field.name, field.dataType, field.nullable, {**field.metadata, **extra})
    return out


def drop_transient(df: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Without the fields marked transient in the schema, or named here; order is kept."""
    marked = {f.name for f in df.schema.fields if f.metadata.get(TRANSIENT)}
    return df.drop(*(marked | set(excluded)))


def tokens(df: DataFrame, text: str, delimiter: str, out: str = "word") -> DataFrame:
    """One row per token of every text."""
    return df.select(F.explode(split_tokens(F.col(text), delimiter)).alias(out))


def paired(words: DataFrame, word: str = "word") -> DataFrame:
    """``(word, 1)`` rows."""
    return words.select(F.col(word), F.lit(1).alias("one"))
