"""Nearest neighbours by inner product, found through low-dimensional stable projections.

Vectors get one more coordinate so that all have the same length; the nearest by distance is then the
largest inner product. ``PROJECTIONS`` Gaussian (2-stable) projections of a difference, squared and
summed, are its squared length times a chi-square variable with as many degrees of freedom. Projected
vectors are indexed by a kd-tree: its upper levels, fitted on a bounded sample, cut the table into
cells, and a task builds the lower levels over one bounded block of a cell. A query visits projected
neighbours in order of distance, verifies them on the original vectors, and stops when the chi-square
test says that a vector nearer than its k-th so far would, with probability ``CERTAINTY``, have been
seen. Its own cell comes first; the k-th distance found there decides which other cells it visits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, arrays, usable_vectors

PROJECTIONS = 8
CERTAINTY = 0.96
SEED = 20240501
# Rows the upper levels are fitted on; every row is then put in a cell.
SAMPLE_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 64
# Queries that meet a block in one task.
QUERY_ROWS = 4096
# Leaves a query visits between two stopping tests.
WAVE = 4


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi_square_point(certainty: float, freedom: int) -> float:
    """Where the distribution function reaches ``certainty``."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < certainty:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < certainty else (low, mid)
    return high


@dataclass
class Space:
    """Length of the extended vectors and the projections; the same for all tasks."""

    length: float
    matrix: np.ndarray
    stop: float

    @classmethod
    def of(cls, dimension: int, length: float, projections: int, certainty: float) -> Space:
        matrix = np.random.default_rng(SEED).standard_normal((dimension + 1, projections))
        return cls(length, matrix, chi_square_point(certainty, projections))

    def data(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.length**2 - norms**2, 0))
        return np.column_stack([vectors, more]) @ self.matrix

    def queries(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        scaled = vectors * (self.length / norms)[:, None]
        return scaled @ self.matrix[:-1]

    def radius(self, scores: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared projected distance at which a query with that k-th score may stop."""
        squared = 2 * self.length**2 - 2 * self.length * scores / norms
        return np.where(np.isfinite(scores), self.stop * np.maximum(squared, 0), np.inf)


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0) ** 2
    return out


def kd_leaves(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves: the widest side is cut at its median until ``rows`` or fewer stay."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= rows:
            leaves.append(own)
            continue
        side = np.ptp(points[own], axis=0).argmax()
        own = own[np.argsort(points[own, side], kind="stable")]
        todo += [own[: len(own) // 2], own[len(own) // 2 :]]
    return leaves


@dataclass
class Cells:
    """Upper levels of the tree as a heap: the side and place of each cut, level by level."""

    sides: np.ndarray
    cuts: np.ndarray
    depth: int

    @classmethod
    def fit(cls, points: np.ndarray, depth: int) -> Cells:
        size = 1 << depth
        sides, cuts, groups = np.zeros(size, np.int64), np.zeros(size), {1: points}
        for node in range(1, size):
            own = groups.pop(node)
            side = np.ptp(own, axis=0).argmax() if len(own) else 0
            cut = np.median(own[:, side]) if len(own) else 0.0
            sides[node], cuts[node] = side, cut
            right = own[:, side] > cut
            groups[2 * node], groups[2 * node + 1] = own[~right], own[right]
        return cls(sides, cuts, depth)

    def of(self, points: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(points), np.int64), np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.sides[node]] > self.cuts[node])
        return node - (1 << self.depth)


def search_block(
    space: Space, k: int, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray,
    query_ids: np.ndarray, queries: np.ndarray, query_norms: np.ndarray, query_points: np.ndarray, known: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query number, row number, score)`` of each query's k best rows of a block, or fewer.

    ``known`` is a lower bound of each query's k-th score from other blocks: rows below it, which
    cannot be among the k best, are not returned.
    """
    leaves = kd_leaves(points, LEAF_ROWS)
    low = np.array([points[leaf].min(axis=0) for leaf in leaves])
    high = np.array([points[leaf].max(axis=0) for leaf in leaves])
    far = box_distance(query_points, low, high)
    order = np.argsort(far, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    rows = np.full((len(queries), k), -1)
    live = np.arange(len(queries))
    for start in range(0, len(leaves), WAVE):
        radius = space.radius(np.maximum(best[live, -1], known[live]), query_norms[live])
        next_far = far[live, order[live, start]]
        on = next_far <= radius
        live, radius = live[on], radius[on]
        if not len(live):
            break
        wave = order[live, start : start + WAVE]
        within = far[live[:, None], wave] <= radius[:, None]
        for leaf in np.unique(wave[within]):
            who = live[((wave == leaf) & within).any(axis=1)]
            own = leaves[leaf]
            # Rounded, so that copies of a vector tie however a product was summed.
            scores = np.round(queries[who] @ vectors[own].T, 12)
            scores[query_ids[who, None] == ids[None, own]] = -np.inf
            scores = np.concatenate([best[who], scores], axis=1)
            numbers = np.concatenate([rows[who], np.broadcast_to(own, (len(who), len(own)))], axis=1)
            names = np.where(numbers >= 0, ids[numbers], np.iinfo(np.int64).max)
            top = np.lexsort((names, -scores), axis=1)[:, :k]
            best[who] = np.take_along_axis(scores, top, axis=1)
            rows[who] = np.take_along_axis(numbers, top, axis=1)
    found, place = np.nonzero(np.isfinite(best) & (best >= known[:, None] - 1e-9))
    row = rows[found, place]
    return found, row, np.einsum("ij,ij->i", queries[found], vectors[row])


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    projections: int = PROJECTIONS,
    certainty: float = CERTAINTY,
) -> DataFrame:
    """``(query_id, rank, id, score)``: each query's k nearest rows of ``df`` by inner product.

    Scores are inner products of the original vectors in double precision, larger first, ties to the
    smaller id. A row is never its own query's neighbour (the same id); a query gets fewer than k
    rows only if there are fewer. Null ids, null, empty and zero vectors, vectors with null or
    non-finite components, and vectors of another length than the commonest take no part, as rows or
    as queries. Rows that repeat an id each count; queries that repeat an id are one. Empty tables
    give no rows. Other columns are ignored.

    Every row is indexed and the answer is approximate only through the stopping test. Blocks and
    groups of queries have bounded sizes; a cell with very many rows has more blocks.
    """
    if projections % 2:
        raise ValueError("the number of projections must be even")
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "neighbours")
    rows = usable_vectors(df, id_col, vec_col)
    size = rows.agg(F.count("*"), F.max("norm"), F.max(F.size("v"))).first()
    total, longest, dimension = size[0], size[1] or 1.0, size[2] or 1
    space = Space.of(dimension, longest, projections, certainty)
    asked = usable_vectors(queries, id_col, vec_col).filter(F.size("v") == dimension).dropDuplicates(["id"])
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v", "norm").collect()
    sampled = np.array([r["v"] for r in sample]).reshape(len(sample), dimension)
    points = space.data(sampled, np.array([r["norm"] for r in sample]))
    depth = min(max(0, math.ceil(math.log2(max(1, total / BLOCK_ROWS)))), int(math.log2(SAMPLE_ROWS / 64)))
    cells = Cells.fit(points, depth)

    def placed(batches: Iterator[pa.RecordBatch], project) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = project(arrays(batch.column("v"), dimension), batch.column("norm").to_numpy())
                more = [pa.array(cells.of(found), pa.int64()), pa.array(list(found), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "cell", "p"])

    schema = "id long, v array<double>, norm double, cell long, p array<double>"
    indexed = scratch.keep(rows.mapInArrow(lambda b: placed(b, space.data), schema))
    asked = scratch.keep(asked.mapInArrow(lambda b: placed(b, space.queries), schema))
    sides = [g(F.col("p")[d]).alias(f"{n}{d}") for n, g in (("l", F.min), ("h", F.max)) for d in range(projections)]
    boxes = sorted(indexed.groupBy("cell").agg(F.count("*").alias("n"), *sides).collect())
    if not boxes:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    cell = np.array([b["cell"] for b in boxes])
    blocks = np.array([-(-b["n"] // BLOCK_ROWS) for b in boxes])
    low = np.array([[b[f"l{d}"] for d in range(projections)] for b in boxes])
    high = np.array([[b[f"h{d}"] for d in range(projections)] for b in boxes])
    parts = F.element_at(F.create_map(*[F.lit(int(x)) for pair in zip(cell, blocks) for x in pair]), F.col("cell"))
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    by_block = indexed.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    by_block = by_block.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = row = np.zeros(0, np.int64)
            scores, ids, names = np.zeros(0), row, row
        else:
            ids, names = left["id"].to_numpy(), right["id"].to_numpy()
            found, row, scores = search_block(
                space, k, ids, arrays(left["v"], dimension), arrays(left["p"], projections),
                names, arrays(right["v"], dimension), right["norm"].to_numpy(), arrays(right["p"], projections),
                right["known"].to_numpy(),
            )
        return pa.table({"query_id": pa.array(names[found], pa.int64()), "id": pa.array(ids[row], pa.int64()), "score": pa.array(scores)})

    def met(visits: DataFrame) -> DataFrame:
        keys = ["cell", "part", "group"]
        return by_block.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(search, "query_id long, id long, score double")

    # A query's own cell may have no rows: the nearest cell that has some is its home.
    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = box_distance(arrays(batch.column("p"), projections), low, high)
            own = far.argmin(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            part = np.abs(batch.column("id").to_numpy() % blocks[own])
            rest = [c for c in ("id", "v", "norm", "p", "group")]
            more = [pa.array(cell[own], pa.int64()), pa.array(part, pa.int32()), pa.array(np.full(len(own), -np.inf))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *more], names=[*rest, "cell", "part", "known"])

    visit = "id long, v array<double>, norm double, p array<double>, group int, cell long, part int, known double"
    at_home = asked.mapInArrow(home, visit)
    first = scratch.keep(met(at_home))
    bound = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    bound = bound.select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("known"))

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column("known").to_numpy(zero_copy_only=False)
            known = np.where(np.isnan(known), -np.inf, known)
            far = box_distance(arrays(batch.column("p"), projections), low, high)
            row, own = np.nonzero(far <= space.radius(known, batch.column("norm").to_numpy())[:, None])
            row, own = np.repeat(row, blocks[own]), np.repeat(own, blocks[own])
            part = np.concatenate([np.arange(n) for n in blocks[own[np.r_[True, np.diff(row * len(cell) + own) != 0]]]]) if len(row) else row
            seen = (cell[own] == batch.column("cell").to_numpy()[row]) & (part == batch.column("part").to_numpy()[row])
            row, own, part = row[~seen], own[~seen], part[~seen]
            for start in range(0, len(row), 4096):
                cut = slice(start, start + 4096)
                rest = batch.select(["id", "v", "norm", "p", "group"]).take(pa.array(row[cut]))
                more = [pa.array(cell[own[cut]], pa.int64()), pa.array(part[cut], pa.int32()), pa.array(known[row[cut]])]
                yield pa.RecordBatch.from_arrays([*rest.columns, *more], names=[*rest.schema.names, "cell", "part", "known"])

    begun = at_home.drop("known").join(bound, F.col("id") == F.col("query_id"), "left").drop("query_id")
    found = first.union(met(begun.mapInArrow(onward, visit)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
