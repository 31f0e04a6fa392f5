"""Connected components of an undirected graph, in a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

MAX_ROUNDS = 60


def _smallest(pairs: DataFrame) -> DataFrame:
    """``(u, m)``: the smallest ``v`` of each ``u``.

    Grouped by the complement of ``u``: the later join then shuffles this side too, and so Spark
    may split a vertex with very many edges over several tasks.
    """
    least = pairs.groupBy(F.bitwise_not("u").alias("k")).agg(F.min("v").alias("m"))
    return least.select(F.bitwise_not("k").alias("u"), "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a vertex on the smallest of its neighbours and itself."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a vertex and its smaller neighbours on the smallest of them; expects ``u > v``."""
    least = _smallest(edges)
    hung = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _open(edges: DataFrame) -> bool:
    """Whether some vertex hangs on two others, or hangs on one while another hangs on it."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not counts.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every vertex with an edge; the component is its smallest vertex.

    Alternating large and small stars: each round is a fixed number of shuffles on vertex ids and
    the result converges in about log2(n) rounds; edges that are stars already need none. Every
    round is a table in the shared folder; a vertex stands once in the result. Loops, repeated
    edges, null ends and an empty table are fine.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y"))
    pairs = pairs.filter("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
    current = scratch.keep(pairs.distinct())
    for _ in range(MAX_ROUNDS):
        if not _open(current):
            break
        after = scratch.keep(_small_star(_large_star(current)))
        scratch.drop(current)
        current = after
    else:
        raise RuntimeError(f"vertices still hang in chains after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
