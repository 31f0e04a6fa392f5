"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are dealt in blocks, and each slot of the mixture takes one block. The j-th block of
a source with weight w is released at slot floor(j / w) and due by slot ceil((j + 1) / w); in every
slot the released block with the earliest deadline is taken. On one processor that schedule meets all
deadlines. Slots are dealt a period at a time in whole quotas. What rounding leaves over or short is
carried into the quotas of the next period, so at each period's end a source is about one block from
its exact weight at most and inside a period one block further, however long the phase is. The
driver works out quotas only; executors turn them into slots. When a source runs dry the phase ends, and the next
phase gives its share to the others in proportion, until every row has its slot.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, free_name

PERIOD = 2048
# Sources beyond the largest ones share one weight, so that the driver's plan has a bound.
MAX_SOURCES = 1024
BLOCK_ROWS = 16
BUCKET_ROWS = 1_000_000
TEMPERATURE = 0.5


def temperature_weights(rows: dict[str, int], exponent: float = TEMPERATURE) -> dict[str, float]:
    """Weights in proportion to a power of the row counts: below 1 small sources gain."""
    return {s: n**exponent for s, n in rows.items()}


def quotas(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots of a period per source by largest remainders, at least one each."""
    if len(weights) > period:
        raise ValueError("more sources than slots in a period")
    total = sum(weights.values())
    free = period - len(weights)
    exact = {s: max(0.0, w / total * period - 1) for s, w in weights.items()}
    scale = free / sum(exact.values()) if sum(exact.values()) else 0
    exact = {s: x * scale for s, x in exact.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    for k in range(period - sum(out.values())):
        out[by_rest[k % len(by_rest)]] += 1
    return out


def schedule(quota: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source in one period, by earliest deadline first among released blocks."""
    period = sum(quota.values())
    release = sorted((j * period // q, -(-(j + 1) * period // q), s) for s, q in quota.items() for j in range(q))
    slots: dict[str, list[int]] = {s: [] for s in quota}
    ready, at = [], 0
    for slot in range(period):
        while at < len(release) and release[at][0] <= slot:
            heapq.heappush(ready, (release[at][1], release[at][2]))
            at += 1
        deadline, source = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        slots[source].append(slot)
    return slots


def carried(exact: dict[str, Fraction], period: int) -> dict[str, int]:
    """Slots of a period per source from what each is short of; the quotas make up the period."""
    out = {s: max(0, int(x // 1)) for s, x in exact.items()}
    while rest := period - sum(out.values()):
        step = 1 if rest > 0 else -1
        usable = [s for s in out if step > 0 or out[s]]
        for s in sorted(usable, key=lambda s: (step * (out[s] - exact[s]), s))[: abs(rest)]:
            out[s] += step
    return out


def turns(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> Iterator[tuple]:
    """``(start slot, slots used, parts)`` per period; a part is ``(source, first block, quota)``."""
    left, used = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0)
    start = 0
    while left:
        total = sum(Fraction(weights[s]) for s in left)
        share = {s: Fraction(weights[s]) / total for s in left}
        short = dict.fromkeys(left, Fraction(0))
        while all(left.values()):
            exact = {s: short[s] + share[s] * period for s in left}
            quota = carried(exact, period)
            short = {s: exact[s] - quota[s] for s in left}
            parts, end = [(s, used[s], quota[s]) for s in left if quota[s]], period
            if any(quota[s] > n for s, n in left.items()):
                # The phase ends at the first slot that would need a block of a source that has run dry.
                slots = schedule(quota)
                end = min(slots[s][n] for s, n in left.items() if quota[s] > n)
                quota = {s: bisect_left(slots[s], end) for s in left}
            yield start, end, parts
            for s in left:
                used[s] += quota[s]
                left[s] -= quota[s]
            start += end
        left = {s: n for s, n in left.items() if n}


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[tuple]:
    """``(source, first block, end block, start slot, period, slots)``: where a source's blocks go.

    Block b of the source, counted from ``first block``, lies at ``start slot`` plus its entry of ``slots``.
    """
    plan = []
    for start, end, parts in turns(blocks, weights, period):
        slots = schedule({s: q for s, _, q in parts})
        for s, first, _ in parts:
            if n := bisect_left(slots[s], end):
                plan.append((s, first, first + n, start, period, slots[s]))
    return plan


def _slots_of(names: list[str]):
    """Periods to rows of ``names``: share, block, slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, end, parts in zip(batch["start"], batch["end"], batch["parts"]):
                slots = schedule({p["s"]: int(p["quota"]) for p in parts})
                rows = [(p["s"], p["first"] + k, start + at) for p in parts for k, at in enumerate(slots[p["s"]]) if at < end]
                yield pd.DataFrame(rows, columns=names)

    return run


def mixed(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    temperature: float = TEMPERATURE,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its place in the mixture, and the names of the four columns added.

    Added: ``block`` (number of the row's block in its source), ``slot`` (of that block in the
    mixture, gapless from 0), ``in_block`` and ``share`` (name of the source's weight; null for the
    rest of the sources). Where a name is taken it gets underscores. Without ``weights`` they come
    from the row counts and ``temperature``. Every row of ``docs`` comes back once: a source that
    runs dry leaves its share to the others.

    Within a source rows are ordered by a hash of the id, so copies and runs of the input are spread.
    A null source is a source of its own. The ``MAX_SOURCES`` - 1 sources with most rows have weights
    of their own and all others share one; a source without a given weight gets the mean weight.
    Rows with equal ids are ordered arbitrarily among themselves. A hot source is numbered in many
    buckets at once. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    spark, n = docs.sparkSession, {c: free_name(docs, c) for c in ("block", "slot", "in_block", "share")}
    inner = ("hash", "bucket", "rank", "before", "source", "share", "plan_share", "plan_block", "plan_slot")
    own = {f"mix_{c}": free_name(docs, f"mix_{c}") for c in inner}
    planned = [own[f"mix_plan_{c}"] for c in ("share", "block", "slot")]
    source = F.concat(F.lit("s"), F.col(source_col).cast("string"))
    source = F.coalesce(source, F.lit("null"))
    largest = docs.groupBy(source.alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "s").limit(MAX_SOURCES)
    top = [(r["s"], r["n"]) for r in largest.collect()]
    total = docs.count() if len(top) == MAX_SOURCES else sum(c for _, c in top)
    if len(top) == MAX_SOURCES:
        top = top[:-1]
    rows = dict(top)
    rest = total - sum(rows.values())
    names = spark.createDataFrame([(s, s) for s in rows], f"{own['mix_source']} string, {own['mix_share']} string")
    # An order-preserving prefix of the hash: enough buckets that each has about BUCKET_ROWS rows.
    bits = max(8, (total // BUCKET_ROWS).bit_length())
    placed = (
        docs.withColumn(own["mix_source"], source)
        .withColumn(own["mix_hash"], F.xxhash64(F.col(id_col)))
        .withColumn(own["mix_bucket"], F.shiftright(own["mix_hash"], 64 - bits))
        .join(F.broadcast(names), own["mix_source"], "left")
        .withColumn(own["mix_share"], F.coalesce(own["mix_share"], F.lit("rest")))
    )
    if rest:
        rows["rest"] = rest
    given = temperature_weights(rows, temperature) if weights is None else _given(weights, rows)
    blocks = {s: -(-c // block_rows) for s, c in rows.items()}
    dealt = spark.createDataFrame(
        list(turns(blocks, given, period)), "start long, end int, parts array<struct<s: string, first: long, quota: int>>"
    )
    kinds = ", ".join(f"{c} {t}" for c, t in zip(planned, ("string", "long", "long")))
    plan = scratch.keep(dealt.mapInPandas(_slots_of(planned), kinds))
    keys = [own["mix_share"], own["mix_bucket"]]
    counts = scratch.keep(placed.groupBy(*keys).agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy(keys[0]).orderBy(keys[1]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*keys, F.coalesce(before, F.lit(0)).alias(own["mix_before"]))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(own["mix_hash"], F.col(id_col)))
    ranked = placed.withColumn(own["mix_rank"], rank).join(offsets, keys)
    number = F.col(own["mix_before"]) + F.col(own["mix_rank"]) - 1
    ranked = ranked.withColumn(n["block"], F.floor(number / block_rows)).withColumn(n["in_block"], (number % block_rows).cast("int"))
    at = (F.col(own["mix_share"]) == F.col(planned[0])) & (F.col(n["block"]) == F.col(planned[1]))
    slotted = ranked.join(plan, at).withColumn(n["slot"], F.col(planned[2]))
    share = F.when(F.col(own["mix_share"]) != "rest", F.expr(f"substr({own['mix_share']}, 2)"))
    share = F.when(F.col(own["mix_share"]) == "null", F.lit(None)).otherwise(share)
    slotted = slotted.withColumn(n["share"], share)
    columns = [*(f"`{c}`" for c in docs.columns), n["share"], n["block"], n["slot"], n["in_block"]]
    return slotted.select(*columns), n


def _given(weights: dict[str | None, float], rows: dict[str, int]) -> dict[str, float]:
    named = {("null" if s is None else f"s{s}"): w for s, w in weights.items() if w > 0}
    mean = sum(named.values()) / len(named) if named else 1.0
    return {s: named.get(s, mean) for s in rows}


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The rows and columns of ``docs``, laid out in the order of the mixture.

    Partitions hold consecutive slots, in order, so files written from the result and read one
    after another give the mixture.
    """
    placed, n = mixed(docs, weights, **options)
    placed = Scratch(docs.sparkSession, "mixture").keep(placed)  # the range partitioner reads it twice
    ordered = placed.repartitionByRange(n["slot"]).sortWithinPartitions(n["slot"], n["in_block"])
    return ordered.select(*[f"`{c}`" for c in docs.columns])
