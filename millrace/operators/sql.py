"""The lookups as SQL functions of a session, for queries written as SQL text.

Each lookup writes its table once and registers functions over it: a scalar one to use in any
expression, and for addresses a table function for ``LATERAL`` joins. Spark unfolds their bodies into
the query that calls them, so a call is a join on equal keys and no code runs per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.net import IPV4_SHAPE
from millrace.operators.geo import NO_MATCH, NULL_MESSAGE, range_pieces
from millrace.operators.hierarchy import FIRST_HOP_GROUP, parent_paths
from millrace.session import cut_lineage

_PIECES = "ARRAY<STRUCT<start_ip: BIGINT, end_ip: BIGINT, location: STRING>>"


def quoted(text: str) -> str:
    """A SQL text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(ip: str) -> str:
    """``ip_to_long`` in SQL. A body inside a subquery cannot call another function, so it is spelt out."""
    shaped = f"CASE WHEN {ip} IS NULL OR {ip} RLIKE {quoted(IPV4_SHAPE)} THEN {ip} ELSE '0.0.0.0' END"
    return f"aggregate(split({shaped}, '[.]'), 0L, (number, octet) -> shiftleft(number, 8) | CAST(octet AS BIGINT))"


def _function(spark: SparkSession, name: str, takes: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {returns} RETURN {body}")


def register_ip_number(spark: SparkSession, name: str = "ip_number") -> None:
    """``name(ip)``: an address as a number; 0 for a bad shape, null for null."""
    _function(spark, name, "ip STRING", "BIGINT", _number("ip"))


def register_ip_location(
    spark: SparkSession, ranges: DataFrame, name: str = "ip_location", no_match: str = NO_MATCH, null_message: str = NULL_MESSAGE
) -> None:
    """``name(ip)``: the location of an address; ``name_of(ip)``: a table of its location, for ``LATERAL``.

    Pieces of ranges are gathered per prefix: at most 256 in a row, as ``range_pieces`` promises for a
    /24 and ``DENSE`` for a /16. The scalar function is two left joins, on the /16 and on the /24, and a
    search in the row found. The table function gives no row for an address in no range.
    """
    pieces = cut_lineage(range_pieces(ranges), "ranges")
    pieces.createOrReplaceTempView(f"{name}_pieces")
    rows = F.sort_array(F.collect_list(F.struct("start_ip", "end_ip", "location")))
    gathered = cut_lineage(pieces.groupBy("bits", "prefix").agg(rows.alias("pieces")), "range-rows")
    gathered.createOrReplaceTempView(f"{name}_rows")
    within = "try_element_at(filter(pieces, p -> p.start_ip <= number AND p.end_ip >= number).location, 1)"
    _function(spark, f"{name}_within", f"pieces {_PIECES}, number BIGINT", "STRING", within)
    number = _number("ip")

    def found(bits: int) -> str:
        row = f"SELECT first(pieces) FROM {name}_rows WHERE bits = {bits} AND prefix = shiftright({number}, {bits})"
        return f"{name}_within(({row}), {number})"

    answer = f"coalesce({found(16)}, {found(8)}, {quoted(no_match)})"
    _function(spark, name, "ip STRING", "STRING", f"CASE WHEN ip IS NULL THEN {quoted(null_message)} ELSE {answer} END")
    over = " UNION ALL ".join(
        f"SELECT location FROM {name}_pieces WHERE bits = {bits} AND prefix = shiftright({number}, {bits}) "
        f"AND start_ip <= {number} AND end_ip >= {number}"
        for bits in (16, 8)
    )
    _function(spark, f"{name}_of", "ip STRING", "TABLE(location STRING)", over)


def register_parent_path(
    spark: SparkSession, edges: DataFrame, name: str = "parent_path", group: str = FIRST_HOP_GROUP
) -> None:
    """``name(id)``: ``id,parent,...`` up to the root; an unknown id is its own path, null stays null."""
    paths = cut_lineage(parent_paths(edges, group), "paths")
    paths.createOrReplaceTempView(f"{name}_paths")
    body = f"coalesce((SELECT first(path) FROM {name}_paths WHERE {name}_paths.id = node), node)"
    _function(spark, name, "node STRING", "STRING", body)
