"""Near-duplicate vectors by range search on a robust-pruned flat graph.

Equal vectors are one vertex. Clusters come from a bounded sample; every vertex lies in its nearest
cluster and in the next ones, so clusters overlap, and a cluster with many vertices is dealt to parts
of bounded size. Each part builds a graph: a vertex's candidates are its nearest vertices in the part
and a few random ones, and robust pruning drops a candidate that a kept one is clearly nearer to. The
adjacency lists a vertex has from several parts are united. Then each part is searched for the
vertices of its cluster: greedily from the medoid, and on from every vertex in range until none is
left to expand. Links are verified by their exact cosine, and recall is audited against brute force
on sampled vertices; the build is done again with more overlap while recall is under its target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, arrays, usable_vectors
from millrace.llm.components import components

THRESHOLD = 0.95
DEGREE = 24
BEAM = 24
ALPHA = 1.2
OVERLAP = 3
# Rows the cluster centres are fitted on; every row is then assigned.
SAMPLE_ROWS = 8192
CLUSTER_ROWS = 1024
PART_ROWS = 2048
NEAREST, RANDOM, REACHED = 48, 24, 6
AUDIT_ROWS = 256
TARGET_RECALL = 0.99
# After the last attempt less than this is an error.
LEAST_RECALL = 0.9
ATTEMPTS = 3
SEED = 20240502


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of length one by a few rounds of spherical k-means."""
    count = max(1, min(count, len(sample)))
    centres = sample[np.random.default_rng(SEED).choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(sample[i : i + 1024] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 1024)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def build(vectors: np.ndarray, ids: np.ndarray, degree: int = DEGREE) -> list[np.ndarray]:
    """Neighbours of each vertex of one part, pruned robustly, with the edges back.

    Vectors have length one; distances are squared chords.
    """
    n = len(vectors)
    if n == 1:
        return [np.zeros(0, np.int64)]
    cosines = (vectors @ vectors.T).astype(np.float32)
    np.fill_diagonal(cosines, -2)
    near = min(NEAREST, n - 1)
    close = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
    far = np.random.default_rng(int(ids.min()) & 0xFFFFFFFF).integers(0, n, (n, RANDOM))
    candidates = np.concatenate([close, far], axis=1)
    distance = 2 - 2 * np.take_along_axis(cosines, candidates, axis=1)
    order = np.argsort(distance, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    distance = np.take_along_axis(distance, order, axis=1)
    alive = distance < 3.9  # not the vertex itself
    rows, kept = np.arange(n), np.full((n, degree), -1)
    for slot in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        chosen = candidates[rows, pick]
        kept[some, slot] = chosen[some]
        covered = ALPHA * (2 - 2 * cosines[chosen[:, None], candidates]) <= distance
        alive &= ~(covered & some[:, None])
        alive[rows, pick] = False
    source, slot = np.nonzero(kept >= 0)
    target = kept[source, slot]
    # Edges back: the nearest ``degree`` of each vertex, and every vertex's own nearest few, so that
    # each can be reached from those nearest to it however crowded they are.
    order = np.lexsort((-cosines[source, target], target))
    source, target, slot = source[order], target[order], slot[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    back = (place < degree) | (slot < REACHED)
    lists = [kept[v][kept[v] >= 0] for v in range(n)]
    starts = np.searchsorted(target[back], np.arange(n + 1))
    incoming = source[back]
    return [np.union1d(lists[v], incoming[starts[v] : starts[v + 1]]) for v in range(n)]


def range_search(
    queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, neighbours: np.ndarray, start: int, least: float, beam: int
) -> np.ndarray:
    """Which vertices each query finds at cosine ``least`` or more: a matrix of booleans.

    All queries walk at once. A query expands the best vertex it has not expanded among its ``beam``
    best, and every vertex in range. ``own`` is the query's own vertex (or -1), where it starts too.
    ``neighbours`` is a matrix of vertex numbers, -1 where there is none.
    """
    m, n = len(queries), len(vectors)
    rows = np.arange(m)
    seen, found = np.zeros((m, n), bool), np.zeros((m, n), bool)
    best = np.full((m, beam), -2.0)
    which = np.full((m, beam), -1)
    done = np.zeros((m, beam), bool)

    def meet(who: np.ndarray, vertex: np.ndarray) -> np.ndarray:
        cosine = np.einsum("ij,ij->i", queries[who], vectors[vertex])
        hit = cosine >= least
        found[who[hit], vertex[hit]] = True
        return cosine

    seen[:, start] = True
    best[:, 0], which[:, 0] = meet(rows, np.full(m, start)), start
    mine = np.flatnonzero((own >= 0) & (own != start))
    seen[mine, own[mine]] = True
    if beam > 1:
        best[mine, 1], which[mine, 1] = meet(mine, own[mine]), own[mine]
    waiting = [np.zeros((0, 2), np.int64)]  # (query, vertex) in range, pushed out of the beam unexpanded
    while True:
        open_best = np.where(done | (which < 0), -3.0, best)
        slot = open_best.argmax(axis=1)
        live = np.flatnonzero(open_best[rows, slot] > -3)
        pushed = np.concatenate(waiting)
        waiting = [np.zeros((0, 2), np.int64)]
        if not len(live) and not len(pushed):
            return found
        done[live, slot[live]] = True
        who = np.concatenate([live, pushed[:, 0]])
        vertex = np.concatenate([which[live, slot[live]], pushed[:, 1]])
        for i in range(0, len(who), 8192):
            next_to = neighbours[vertex[i : i + 8192]]
            a, b = np.nonzero(next_to >= 0)
            query, node = who[i : i + 8192][a], next_to[a, b]
            new = ~seen[query, node]
            query, node = query[new], node[new]
            # A query may meet a vertex through two expanded ones in one step.
            _, once = np.unique(query * n + node, return_index=True)
            query, node = query[once], node[once]
            if not len(query):
                continue
            seen[query, node] = True
            cosine = meet(query, node)
            held, first = np.unique(query, return_index=True)
            width = np.diff(np.append(first, len(query)))
            column = np.arange(len(query)) - np.repeat(first, width)
            more = np.full((len(held), width.max()), -2.0)
            nodes = np.full(more.shape, -1)
            at = np.repeat(np.arange(len(held)), width)
            more[at, column], nodes[at, column] = cosine, node
            all_best = np.concatenate([best[held], more], axis=1)
            all_which = np.concatenate([which[held], nodes], axis=1)
            all_done = np.concatenate([done[held], np.zeros(more.shape, bool)], axis=1)
            order = np.argsort(-all_best, axis=1, kind="stable")
            out, keep = order[:, beam:], order[:, :beam]
            lost = (np.take_along_axis(all_best, out, 1) >= least) & ~np.take_along_axis(all_done, out, 1)
            r, c = np.nonzero(lost)
            waiting.append(np.column_stack([held[r], np.take_along_axis(all_which, out, 1)[r, c]]))
            best[held] = np.take_along_axis(all_best, keep, 1)
            which[held] = np.take_along_axis(all_which, keep, 1)
            done[held] = np.take_along_axis(all_done, keep, 1)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest vertex number reachable from each of ``n`` vertices."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _linked(scratch: Scratch, vertices: DataFrame, dimension: int, total: int, least: float, overlap: int, beam: int) -> DataFrame:
    """``(id, links, root)`` per vertex and search: rows linked to it, and a vertex it hangs on."""
    sample = vertices.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("u").collect()
    sampled = np.array([r["u"] for r in sample]).reshape(len(sample), dimension)
    centres = fit_centres(sampled, min(-(-total // CLUSTER_ROWS), SAMPLE_ROWS // 16))
    overlap = min(overlap, len(centres))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cosines = arrays(batch.column("u"), dimension) @ centres.T
                near = np.sort(np.argpartition(-cosines, overlap - 1, axis=1)[:, :overlap], axis=1)
                more = pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, more], names=[*batch.schema.names, "clusters"])

    assigned = vertices.mapInArrow(assign, "id long, u array<double>, n long, clusters array<int>")
    placed = scratch.keep(assigned.withColumn("cluster", F.explode("clusters")))
    sizes = {r["cluster"]: r["n"] for r in placed.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    parts = {c: -(-n // PART_ROWS) for c, n in sizes.items()}
    part_of = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("cluster"))
    placed = placed.withColumn("parts", part_of).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def build_part(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        lists = build(arrays(rows["u"], dimension), ids)
        return pa.table({"id": rows["id"], "near": pa.array([ids[v] for v in lists], pa.list_(pa.int64()))})

    edges = placed.select("id", "u", "cluster", "part").groupBy("cluster", "part").applyInArrow(build_part, "id long, near array<long>")
    united = edges.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    # Parts of a cluster meet in pairs, each pair in a task of its own; a part meets itself in (i, i).
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")),
    )
    nodes = placed.join(united, "id").withColumn("meeting", F.explode(meetings))
    nodes = nodes.select("id", "u", "n", "clusters", "near", "cluster", "part", "meeting.i", "meeting.j")

    def search(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["id"].to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        ids, n = rows["id"].to_numpy(), rows.num_rows
        vectors, copies, part = arrays(rows["u"], dimension), rows["n"].to_numpy(), rows["part"].to_numpy()
        clusters, cluster = arrays(rows["clusters"]).astype(np.int64), rows["cluster"][0].as_py()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        near = rows["near"].combine_chunks()
        owner = np.repeat(np.arange(n), np.diff(near.offsets.to_numpy()))
        target = near.flatten().to_numpy()
        place = np.minimum(np.searchsorted(ids, target), n - 1)
        here = ids[place] == target
        a, b = [], []
        for own, other in ((i, j),) if i == j else ((i, j), (j, i)):
            asked, held = np.flatnonzero(part == own), np.flatnonzero(part == other)
            if not len(asked) or not len(held):
                continue
            local = np.full(n, -1)
            local[held] = np.arange(len(held))
            inside = here & (local[owner] >= 0) & (local[place] >= 0)
            matrix = _matrix(local[owner[inside]], local[place[inside]], len(held))
            middle = vectors[held].mean(axis=0)
            medoid = int((vectors[held] @ middle).argmax())
            for block in range(0, len(asked), 1024):
                who = asked[block : block + 1024]
                found = range_search(vectors[who], local[who], vectors[held], matrix, medoid, least, beam)
                x, y = np.nonzero(found)
                a.append(who[x])
                b.append(held[y])
        a, b = np.concatenate(a or [np.zeros(0, np.int64)]), np.concatenate(b or [np.zeros(0, np.int64)])
        pairs = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
        a, b = pairs // n, pairs % n
        a, b = a[a != b], b[a != b]
        # A pair that shares several clusters is counted in the first of them.
        counted = _first_shared(clusters, a, b) == cluster
        links = np.zeros(n, np.int64)
        np.add.at(links, a[counted], copies[b[counted]])
        np.add.at(links, b[counted], copies[a[counted]])
        label = _labels(n, a, b)
        told = (links > 0) | (label != np.arange(n))
        return pa.table({"id": ids[told], "links": links[told], "root": ids[label[told]]})

    return nodes.groupBy("cluster", "i", "j").applyInArrow(search, "id long, links long, root long")


def _first_shared(clusters: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """Smallest cluster that both ends of each pair lie in."""
    out = np.zeros(len(a), np.int64)
    for start in range(0, len(a), block):
        x, y = clusters[a[start : start + block]], clusters[b[start : start + block]]
        same = (x[:, :, None] == y[:, None, :]).any(axis=2)
        out[start : start + block] = np.where(same, x, np.iinfo(np.int64).max).min(axis=1)
    return out


def _matrix(source: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    """Adjacency as one row per vertex, padded with -1."""
    order = np.argsort(source, kind="stable")
    source, target = source[order], target[order]
    width = np.bincount(source, minlength=n)
    out = np.full((n, max(1, width.max(initial=0))), -1)
    out[source, np.arange(len(source)) - np.searchsorted(source, source)] = target
    return out


def _audited(vertices: DataFrame, counts: DataFrame, dimension: int, least: float) -> float:
    """Share of the true links of sampled vertices that were found; 1 if they have none."""
    sample = vertices.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(AUDIT_ROWS).select("id", "u").collect()
    ids = np.array([r["id"] for r in sample])
    asked = np.array([r["u"] for r in sample]).reshape(len(sample), dimension)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = arrays(batch.column("u"), dimension) @ asked.T >= least
                near &= batch.column("id").to_numpy()[:, None] != ids[None, :]
                total += (near * batch.column("n").to_numpy()[:, None]).sum(axis=0)
        yield pa.record_batch([pa.array(ids), pa.array(total)], names=["id", "links"])

    true = vertices.mapInArrow(count, "id long, links long").groupBy("id").agg(F.sum("links").alias("true"))
    both = true.join(counts, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return (both[1] or 0) / both[0] if both[0] else 1.0


def near_duplicates(
    df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM
) -> DataFrame:
    """``(id, n_links, component)`` per row of ``df``.

    ``n_links`` counts the other rows whose cosine with this row, in double precision, is
    ``threshold`` or more and was found; ``component`` is the smallest id reachable by links. Copies
    of a vector are one vertex that stands for its rows, so they cost no pairs, and a large group's
    links are counted where they are found and leave the task as counts and one hook per vertex.

    Null, empty and zero vectors, those with null or non-finite components, and those of another
    length than the commonest link with nothing: no links, and their own id as component. A null id
    comes back with no links and a null component. Rows that repeat an id and its vector are copies
    of each other; an id given to several vectors joins their groups. Empty tables give no rows and
    other columns are ignored.
    """
    scratch = Scratch(df.sparkSession, "flatgraph")
    usable = usable_vectors(df, id_col, vec_col)
    members = scratch.keep(usable.withColumn("vector", F.xxhash64("v")).select("id", "vector", "v", "norm"))
    classes = members.groupBy("vector", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("norm").alias("norm"))
    classes = scratch.keep(classes)
    unit = F.transform("v", lambda x: x / F.col("norm"))
    vertices = classes.groupBy(F.col("least").alias("id")).agg(F.min_by(unit, "vector").alias("u"), F.sum("n").alias("n"))
    vertices = scratch.keep(vertices)
    size = vertices.agg(F.count("*"), F.max(F.size("u"))).first()
    total, dimension = size[0], size[1] or 1
    counts = hooks = None
    for attempt in range(ATTEMPTS if total else 0):
        linked = scratch.keep(_linked(scratch, vertices, dimension, total, threshold, overlap << attempt, beam << attempt))
        counts = scratch.keep(linked.groupBy("id").agg(F.sum("links").alias("links")))
        hooks = linked.select("id", "root")
        recall = _audited(vertices, counts, dimension, threshold)
        if recall >= TARGET_RECALL:
            break
    else:
        if total and recall < LEAST_RECALL:
            raise RuntimeError(f"the audit found {recall:.3f} of the links after {ATTEMPTS} attempts: raise overlap or beam")
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    if not total:
        return ids.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    roots = components(hooks, "id", "root")
    found = classes.select("vector", F.col("least").alias("vertex"), "n")
    found = found.join(counts.withColumnRenamed("id", "vertex"), "vertex", "left")
    found = found.join(roots.withColumnRenamed("node", "vertex"), "vertex", "left")
    found = found.select(
        "vector",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vertex").alias("component"),
    )
    linked = members.select("id", "vector").join(found, "vector").select("id", "n_links", "component")
    rest = _left_out(df, id_col, vec_col, dimension)
    return linked.union(rest.select("id", F.lit(0).cast("long"), F.col("id")))


def _left_out(df: DataFrame, id_col: str, vec_col: str, dimension: int) -> DataFrame:
    """Ids of the rows whose vectors take no part."""
    vec = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("v"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    good = F.col("id").isNotNull() & (F.size("v") == dimension) & finite & (length > 0) & (length < float("inf"))
    return rows.filter(~F.coalesce(good, F.lit(False))).select("id")
