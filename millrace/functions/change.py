"""Parts of a database change record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One-letter operation codes of the public Debezium record format and their names.
OPERATION_NAMES = {
    "r": "read",
    "c": "create",
    "u": "update",
    "d": "delete",
    "t": "truncate",
    "m": "message",
}


def topic_part(topic: Column, index: int) -> Column:
    """Part of a ``server.schema.table`` topic, null when the topic is too short."""
    return F.get(F.split(topic, "[.]"), F.lit(index))


def change_type(op: Column) -> Column:
    """Lower-case operation name, with ``create`` called ``insert``; other names pass through."""
    names = {**OPERATION_NAMES, "c": "insert", "create": "insert"}
    given = F.lower(op)
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, given), given)
