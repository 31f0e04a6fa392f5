"""Change records to uniform change envelopes (flat and nested).

An envelope is kept as an object column until a sink writes it as text, so each record is parsed
once. Records that cannot be read are marked, not lost: see ``quarantine``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import objects
from millrace.functions.change import change_type, topic_part

def read_records(
    df: DataFrame,
    topic: str = "topic",
    value: str = "value",
    strict: bool = False,
    image: str = objects.OBJECT_TYPE,
) -> DataFrame:
    """Add ``change``: schema, table, database, type, row image, and whether the record is usable.

    The image is ``after``, else ``before``. A usable record has a three-part topic, a source
    database and an operation; ``strict`` fails the job on any other. Where one table's columns
    are known, ``image`` may name them as a struct type, which parses faster than an open object.
    """
    if image == objects.OBJECT_TYPE:
        record = objects.parse_value(F.col(value), strict)
    else:
        known = f"before {image}, after {image}, source struct<db:string>, op string"
        record = F.from_json(value, known, {"mode": "FAILFAST"} if strict else {})
    parsed = df.withColumn("_record", record)

    def part(path: str, kind: str) -> Column:
        if image == objects.OBJECT_TYPE:
            return F.try_variant_get("_record", f"$.{path}", kind)
        return F.col(f"_record.{path}")

    table = topic_part(F.col(topic), 2)
    db, op = part("source.db", "string"), part("op", "string")
    usable = table.isNotNull() & db.isNotNull() & op.isNotNull()
    if strict:
        message = F.concat(F.lit("unusable change record on topic "), F.col(topic))
        usable = F.when(usable, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    change = F.struct(
        topic_part(F.col(topic), 1).alias("schema"),
        table.alias("table"),
        db.alias("db"),
        change_type(op).alias("type"),
        F.coalesce(part("after", image), part("before", image)).alias("image"),
        usable.alias("usable"),
    )
    return parsed.withColumn("change", change).drop("_record")


def usable(records: DataFrame) -> DataFrame:
    """The records that could be read.

    Written as an explode of one or no element: a plain filter would be pushed below the parse
    and parse every record again.
    """
    kept = F.explode(F.when(F.col("change.usable"), F.array("change"))).alias("change")
    return records.select(*[c for c in records.columns if c != "change"], kept)


def quarantine(records: DataFrame) -> DataFrame:
    """The records that could not be read, as they came."""
    return records.filter(~F.col("change.usable")).drop("change")


def quarantine_text(records: DataFrame, out: str = "body") -> DataFrame:
    """The records that could not be read, each as one JSON text of its topic, key and value."""
    aside = quarantine(records)
    names = [c for c in ("topic", "key", "value") if c in aside.columns]
    return aside.withColumn(out, F.to_json(F.struct(*names)))


def _text_variant(value: Column) -> Column:
    return value.cast("string").cast("variant")


def flat_envelope(records: DataFrame, out: str = "envelope") -> DataFrame:
    """``{database, table, <row columns>, type}`` as one object.

    A row column called ``database`` or ``table`` replaces the envelope's own, even when it is
    null; the envelope's ``type`` replaces a row column of that name. Null entries are absent.
    """
    image = F.col("change.image")

    def in_row(key: str) -> Column:
        return F.coalesce(F.map_contains_key(image, key), F.lit(False))

    def own(key: str, value: Column) -> Column:
        return F.when(in_row(key), image.getItem(key)).otherwise(_text_variant(value))

    head = F.create_map(
        F.lit("database"), own("database", F.col("change.db")),
        F.lit("table"), own("table", F.col("change.table")),
        F.lit("type"), _text_variant(F.col("change.type")),
    )
    head = F.when(in_row("database") | in_row("table"), objects.drop_nulls(head)).otherwise(head)
    row = F.map_filter(
        image,
        lambda k, v: ~k.isin("database", "table", "type") & objects.is_value(v),
    )
    envelope = F.map_concat(head, F.coalesce(row, F.create_map().cast(objects.OBJECT_TYPE)))
    return usable(records).withColumn(out, envelope).drop("change")


def nested_envelope(records: DataFrame, out: str = "envelope") -> DataFrame:
    """``{database: <db>-<schema>, table, data: {<row columns>}, type}`` as a struct."""
    ok, image = usable(records), F.col("change.image")
    if ok.schema["change"].dataType["image"].dataType.typeName() == "map":
        image = objects.drop_nulls(image)
    body = F.struct(
        F.concat_ws("-", "change.db", "change.schema").alias("database"),
        F.col("change.table").alias("table"),
        image.alias("data"),
        F.col("change.type").alias("type"),
    )
    return ok.withColumn(out, body).drop("change")


def envelope_text(
    df: DataFrame, envelope: str = "envelope", out: str = "body", text: str | None = None
) -> DataFrame:
    """Serialise an envelope column, flat or nested; envelopes hold no null entries.

    ``text`` names the column the envelopes were read from: where one could not be read, that text
    is kept as it came.
    """
    body = F.to_json(envelope)
    return df.withColumn(out, F.coalesce(body, F.col(text)) if text else body)


def parse_envelope(
    df: DataFrame, body: str = "value", out: str = "envelope", strict: bool = False
) -> DataFrame:
    """Read envelope text (one JSON object per row) back into an object column."""
    return df.withColumn(out, objects.drop_nulls(objects.parse_object(F.col(body), strict)))


def unparsed(df: DataFrame, body: str = "value", envelope: str = "envelope") -> DataFrame:
    """The rows whose text ``parse_envelope`` could not read."""
    return df.filter(F.col(body).isNotNull() & F.col(envelope).isNull())
