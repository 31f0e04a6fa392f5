"""Ancestor paths of a parent-pointer table, by doubling the known part of every path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_not_blank
from millrace.lookup import lookup_join, row_bytes, settled
from millrace.session import cut_lineage

# Fixed value: the group label the first hop must carry.
FIRST_HOP_GROUP = "产品类目"

# Both sides of a round are the same table, so only a small one is worth sending to every task.
ROUND_BROADCAST_BYTES = 32 * 1024 * 1024


def _state(chains: DataFrame) -> tuple[int, bool]:
    """Paths still open, and whether the whole table may be broadcast; one small pass."""
    live, size = chains.select(
        F.col("tip").isNotNull().cast("bigint").alias("live"), row_bytes(chains).alias("b")
    ).agg(F.sum("live"), F.sum("b")).first()
    return live or 0, (size or 0) <= ROUND_BROADCAST_BYTES


def ancestor_chains(nodes: DataFrame) -> tuple[DataFrame, bool]:
    """``(id, above)`` with all ancestors of every id, nearest first; and whether that is small.

    ``nodes`` has one row per id. Each round joins the open paths to the table itself at their
    upper end, so a tree of depth d takes about log2(d) rounds. A cycle ends where it would
    repeat. Every round is written to the shared folder.
    """
    parent = F.when(is_not_blank(F.col("parent")) & (F.col("parent") != F.col("id")), F.col("parent"))
    chains = nodes.withColumn("tip", parent).select(
        "id",
        F.when(F.col("tip").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array("tip"))
        .alias("above"),
        "tip",
    )
    live, small = _state(chains)
    closed = chains.filter("tip is null")
    while live:
        upper = chains.select(
            F.col("id").alias("tip"), F.col("above").alias("_more"), F.col("tip").alias("_tip")
        )
        grown = lookup_join(chains.filter("tip is not null"), upper, "tip", small=small)
        walked = F.concat("above", F.coalesce("_more", F.array().cast("array<string>")))
        grown = grown.withColumn("_walked", walked).withColumn(
            "above", F.array_remove(F.array_distinct("_walked"), F.col("id"))
        )
        repeats = F.size("above") < F.size("_walked")
        grown = grown.select(
            "id", "above", F.when(~repeats, F.col("_tip")).alias("tip")
        )
        # Only the paths that grew are written; those that ended before stay where they are.
        grown = cut_lineage(grown, "chains")
        chains = closed.unionByName(grown)
        closed = closed.unionByName(grown.filter("tip is null"))
        live, small = _state(chains)
    return chains.select("id", "above"), small


def parent_paths(edges: DataFrame, group: str = FIRST_HOP_GROUP) -> DataFrame:
    """``(id, path)`` for every id whose first hop carries ``group``; path is ``id,parent,...``.

    ``edges`` is ``(id, parentid, cfg_group)``. Only the first hop looks at the group. An id with
    several parents takes the smallest.
    """
    ids = edges.select(F.col("id").cast("string"), F.col("parentid").cast("string"), "cfg_group")
    nodes = (
        ids.filter("id is not null")
        .groupBy("id")
        .agg(
            F.min("parentid").alias("parent"),
            F.min(F.when(F.col("cfg_group") == group, F.col("parentid"))).alias("first"),
        )
    )
    nodes = cut_lineage(nodes, "nodes")
    chains, small = ancestor_chains(nodes.select("id", "parent"))
    starts = nodes.filter(is_not_blank(F.col("first"))).select("id", "first")
    upper = chains.select(F.col("id").alias("first"), "above")
    joined = lookup_join(starts, upper, "first", small=small)
    none = F.array().cast("array<string>")
    walk = F.array_distinct(F.concat(F.array("id", "first"), F.coalesce("above", none)))
    return joined.select("id", F.array_join(walk, ",").alias("path"))


def with_parent_path(
    df: DataFrame, id_col: str, edges: DataFrame, group: str = FIRST_HOP_GROUP, out: str = "path"
) -> DataFrame:
    """Add the ancestor path of an id; an unknown id is its own path, null stays null."""
    paths = parent_paths(edges, group).select(F.col("id").alias("_id"), F.col("path").alias("_path"))
    paths, small = settled(paths, "paths")
    keyed = df.withColumn("_id", F.col(id_col).cast("string"))
    joined = lookup_join(keyed, paths, "_id", small=small)
    return joined.withColumn(out, F.coalesce("_path", "_id")).select(*df.columns, out)
