"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard has many points on a ring of 64-bit hashes; a row belongs to the first point clockwise
of its text's hash, so equal texts lie together. A shard takes rows up to its capacity and the rows
that find it full go on clockwise to the next point of a shard with room. Where rows go depends on
how many rows lie on each arc between two points and on nothing else, so only those counts (at most
``shards * points``, whatever the data) reach the driver; the walk gives each arc a few runs of
ranks per shard, and a row finds its run by its rank on its arc.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

POINTS = 64
# Rows are numbered in so many sections of the ring at once, and those of a hot text in so many cells.
SECTION_BITS = 16
CELLS = 256
# A text with more than this share of all rows is hot, so fewer than 1,000 are.
HOT_SHARE = 1 / 1000
PREFIX_BITS = 12


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """``(position, shard)`` clockwise. A shard's points do not depend on the number of shards."""
    if shards < 1 or points < 1:
        raise ValueError("a ring needs shards and points")
    spots = {}
    for shard in range(shards):
        for point in range(points):
            digest = hashlib.md5(f"{shard}/{point}".encode()).digest()
            spots.setdefault(int.from_bytes(digest[:8], "big", signed=True), shard)
    return sorted(spots.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard; without slack they differ by one at most and sum to ``rows``."""
    if slack:
        return [max(1, int(-(-rows * (1 + slack) // shards)))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(spots: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(arc, first, end, shard, slot)``: runs of ranks per arc, where they go and their first slot.

    All rows step clockwise together: in each round the rows waiting at a point, earlier points
    first, are taken until its shard is full, and the others step to the next point.
    """
    room, taken, runs = list(room), [0] * len(room), []
    waiting = [(arc, arc, 0, n) for arc, n in sorted(counts.items()) if n]
    while waiting:
        onward = []
        for at, arc, first, end in waiting:
            shard = spots[at][1]
            fits = min(end - first, room[shard])
            if fits:
                runs.append((arc, first, first + fits, shard, taken[shard]))
                room[shard] -= fits
                taken[shard] += fits
            if first + fits < end:
                onward.append(((at + 1) % len(spots), arc, first + fits, end))
        waiting = sorted(onward)
    return runs


def _arc(docs: DataFrame, position: Column, spots: list[tuple[int, int]]) -> DataFrame:
    """Adds ``arc``: the number of the first point at or after ``position``.

    Points are looked up by the first bits of the position, then compared; the table has
    ``2 ** PREFIX_BITS`` rows.
    """
    marks, step = [p for p, _ in spots], 1 << (64 - PREFIX_BITS)
    rows = []
    for prefix in range(-(1 << PREFIX_BITS) // 2, (1 << PREFIX_BITS) // 2):
        low, high = bisect_left(marks, prefix * step), bisect_left(marks, (prefix + 1) * step)
        rows.append((prefix, low, marks[low:high]))
    prefixes = docs.sparkSession.createDataFrame(rows, "prefix long, low int, inside array<long>")
    placed = docs.withColumn("prefix", F.shiftright(position, 64 - PREFIX_BITS)).join(F.broadcast(prefixes), "prefix")
    passed = F.size(F.filter("inside", lambda mark: mark < position))
    return placed.withColumn("arc", F.pmod(F.col("low") + passed, F.lit(len(spots))).cast("int")).drop("prefix", "low", "inside")


def shard_rows(
    docs: DataFrame,
    shards: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    points: int = POINTS,
    slack: float = 0.0,
) -> DataFrame:
    """``(id, size, crc, shard, slot)`` per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus one (null text: one), ``crc`` its unsigned CRC-32 and
    ``slot`` the row's place in its shard, gapless from 0. Without ``slack`` row counts of shards are
    at most one apart; with it a shard holds at most ``ceil((1 + slack) * rows / shards)`` rows and
    fewer rows move when a shard is added. Null text counts as empty. Rows that repeat are placed as
    often as they occur, equal texts side by side, so that only a shard that fills up or a way round the ring
    parts them; ties by id (a hot text's rows are ordered by a hash of the id first). A null id
    is kept; other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.xxhash64(text).alias("position"),
    )
    spots = ring(shards, points)
    marked = scratch.keep(_arc(hashed, F.col("position"), spots))
    total = marked.count()
    texts = marked.groupBy("position").agg(F.count("*").alias("n")).filter(F.col("n") > total * HOT_SHARE)
    hot = docs.sparkSession.createDataFrame([(r["position"],) for r in texts.collect()], "hot long")
    marked = marked.join(F.broadcast(hot), F.col("position") == F.col("hot"), "left")
    cell = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("id", "crc"), F.lit(CELLS)).cast("int")).otherwise(-1)
    # The first arc also takes what lies behind the last point; that comes first on the way round.
    turned = (F.col("position") <= spots[0][0]).cast("int")
    section = F.shiftright("position", 64 - SECTION_BITS)
    keys = ["arc", "turned", "section", "spot", "cell"]
    marked = marked.select("*", turned.alias("turned"), section.alias("section"), F.coalesce("hot", F.lit(-(1 << 63))).alias("spot"), cell.alias("cell"))
    cells = scratch.keep(marked.groupBy(*keys).agg(F.count("*").alias("n")))
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    runs = walk(spots, counts, capacities(sum(counts.values()), shards, slack))
    plan = docs.sparkSession.createDataFrame(runs, "arc int, first long, end long, shard int, slot_from long")
    earlier = F.sum("n").over(Window.partitionBy("arc").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = cells.select(*keys, F.coalesce(earlier, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("position", "crc", "size", "id"))
    ranked = (
        marked.withColumn("rank", rank).join(offsets, keys)
        .withColumn("rank", F.col("before") + F.col("rank") - 1)
    )
    run = (ranked["arc"] == plan["arc"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    placed = ranked.join(F.broadcast(plan), run)
    slot = (F.col("slot_from") + F.col("rank") - F.col("first")).alias("slot")
    return placed.select("id", "size", "crc", "shard", slot)
