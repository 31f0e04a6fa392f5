"""JSON objects with unknown keys, held as ``map<string,variant>`` so values keep their types."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

OBJECT_TYPE = "map<string,variant>"


def parse_value(text: Column, strict: bool = False) -> Column:
    """Parse JSON text; malformed text gives null or fails if ``strict``.

    Of a repeated key the last value counts. That is a setting of the session, made here.
    """
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.parse_json(text) if strict else F.try_parse_json(text)


def parse_object(text: Column, strict: bool = False) -> Column:
    """Parse a JSON object; other text gives null, or fails the job when ``strict``."""
    get = F.variant_get if strict else F.try_variant_get
    return get(parse_value(text, strict), "$", OBJECT_TYPE)


def get_string(obj: Column, key: str) -> Column:
    """Value of a (case-sensitive) key as text; nested values come back as JSON text."""
    return obj.getItem(key).cast("string")


def get_object(obj: Column, key: str) -> Column:
    """Nested object of a key as another object column."""
    return obj.getItem(key).cast(OBJECT_TYPE)


def put_strings(obj: Column, values: Mapping[str, Column]) -> Column:
    """Set or overwrite keys; a null value leaves its key as it is."""
    texts = {key: value.cast("string") for key, value in values.items()}
    pairs = [x for key, text in texts.items() for x in (F.lit(key), text.cast("variant"))]
    given = reduce(or_, [text.isNotNull() for text in texts.values()])

    def untouched(k: Column, v: Column) -> Column:
        return ~reduce(or_, [(k == key) & text.isNotNull() for key, text in texts.items()])

    changed = F.map_concat(F.map_filter(obj, untouched), drop_nulls(F.create_map(*pairs)))
    return F.when(given, changed).otherwise(obj)


def put_string(obj: Column, key: str, value: Column) -> Column:
    """Set or overwrite one key; a null value leaves the object as it is."""
    return put_strings(obj, {key: value})


def remove_key(obj: Column, key: str) -> Column:
    return F.map_filter(obj, lambda k, v: k != key)


def is_value(value: Column) -> Column:
    """False for a missing value and for JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def drop_nulls(obj: Column) -> Column:
    """Without the entries that hold JSON null."""
    return F.map_filter(obj, lambda k, v: is_value(v))


def to_text(obj: Column) -> Column:
    """JSON text without null entries."""
    return F.to_json(drop_nulls(obj))


def string_values(obj: Column) -> Column:
    """The same object with every value as text."""
    return F.transform_values(obj, lambda k, v: v.cast("string"))


def quoted_column_list(obj: Column, quote: str = "`") -> Column:
    """Keys as a quoted, comma-separated list."""
    return F.concat(
        F.lit(quote), F.array_join(F.map_keys(obj), f"{quote},{quote}"), F.lit(quote)
    )


def quoted_value_list(obj: Column) -> Column:
    """Values as quoted text, comma-separated, in the order of the keys; null as empty text."""
    return F.concat(
        F.lit("'"), F.array_join(F.map_values(string_values(obj)), "','", ""), F.lit("'")
    )
