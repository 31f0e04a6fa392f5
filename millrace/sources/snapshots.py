"""A table's snapshot taken in chunks while its changes arrive.

The table is read in ranges of its key, each in a job of its own, between two marks of the change
log: how far the log was before the range was read and how far after. What a range says of a key is
as old as its low mark at least. If the log holds a change of that key between the two marks, nobody
can tell whether the read saw it, so the row goes and the change speaks for the key; every other row
is the key's state at the low mark. Rows that stay and changes then make one feed with positions, in
which the last write of each key is the table's state, with no lock and no pause of the source.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut_lineage


@dataclass(frozen=True)
class KeyRange:
    """Keys above ``low`` up to ``high``; None is open. The first range holds rows without a key too."""

    number: int
    low: object
    high: object

    def condition(self, key: Column) -> Column:
        above = F.lit(True) if self.low is None else key > F.lit(self.low)
        below = F.lit(True) if self.high is None else key <= F.lit(self.high)
        return above & below if self.low is not None else F.coalesce(above & below, F.lit(True))

    def predicate(self, column: str) -> str:
        """The same as SQL text for a database's reader; keys are numbers or texts."""

        def literal(value) -> str:
            return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

        parts = [f"{column} > {literal(self.low)}"] if self.low is not None else []
        parts += [f"{column} <= {literal(self.high)}"] if self.high is not None else []
        text = " AND ".join(parts) or "1 = 1"
        return text if self.low is not None else f"({text}) OR {column} IS NULL"


def key_ranges(rows: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list[KeyRange]:
    """Ranges of near-equal row counts, cut at quantiles of a numeric key, in one pass.

    A key that many rows share stays in one range, so there may be fewer than ``parts``.
    """
    shares = [F.lit(i / parts) for i in range(1, parts)]
    cuts = []
    if shares:
        found = rows.agg(F.percentile_approx(key, F.array(*shares), F.lit(accuracy))).first()[0]
        cuts = sorted(set(found or []))
    bounds = [None, *cuts, None]
    return [KeyRange(i, low, high) for i, (low, high) in enumerate(zip(bounds, bounds[1:]))]


def read_chunks(
    spark: SparkSession,
    ranges: list[KeyRange],
    read: Callable[[KeyRange], DataFrame],
    mark: Callable[[], int],
    at_once: int = 1,
) -> DataFrame:
    """``(row, chunk, low_mark, high_mark)`` for all rows of all ranges; ``row`` is a struct.

    Each range is read once and written to the shared folder between its two marks, so that what is
    used later is what was read then. ``at_once`` ranges are read side by side.
    """

    def one(chunk: KeyRange) -> tuple[DataFrame, int, int, int]:
        low = mark()
        held = cut_lineage(read(chunk), "chunk")
        return held, chunk.number, low, mark()

    with ThreadPoolExecutor(at_once) as pool:
        chunks = list(pool.map(one, ranges))
    out = None
    for held, number, low, high in chunks:
        row = F.struct(*[F.col(f"`{c}`") for c in held.columns]).alias("row")
        marks = [F.lit(v).cast("bigint").alias(n) for v, n in ((low, "low_mark"), (high, "high_mark"))]
        some = held.select(row, F.lit(number).alias("chunk"), *marks)
        out = some if out is None else out.unionAll(some)
    return out


def settled_rows(chunks: DataFrame, changes: DataFrame, key: str, position: str = "position") -> DataFrame:
    """Chunk rows of whose key no change lies between the chunk's marks.

    ``changes`` holds ``key`` and ``position`` of every change from the first mark on; the log's places
    between the marks are those after the low one up to the high one. Changes are reduced to the keys
    and places that can matter before they are joined.
    """
    low, high = chunks.agg(F.min("low_mark"), F.max("high_mark")).first()
    if low is None:
        return chunks
    during = changes.filter((F.col(position) > low) & (F.col(position) <= high))
    during = during.select(F.col(key).alias("_key"), F.col(position).alias("_at")).distinct()
    overtaken = (
        F.col(f"row.`{key}`").eqNullSafe(F.col("_key"))
        & (F.col("_at") > F.col("low_mark"))
        & (F.col("_at") <= F.col("high_mark"))
    )
    return chunks.join(during, overtaken, "left_anti")


def handover(chunks: DataFrame, changes: DataFrame, key: str, position: str = "position") -> DataFrame:
    """One feed of a snapshot and the changes: ``(key, position, from_change, row, gone)``.

    ``changes`` is ``(key, position, row, gone)``; ``row`` is null where a change deletes. A snapshot's
    row stands at its low mark, after the change at that place, which it has seen.
    """
    kept = settled_rows(chunks, changes, key, position)
    rows = kept.select(
        F.col(f"row.`{key}`").alias(key),
        F.col("low_mark").alias(position),
        F.lit(False).alias("from_change"),
        "row",
        F.lit(False).alias("gone"),
    )
    kind = dict(rows.dtypes)["row"]
    later = changes.select(key, F.col(position).cast("bigint").alias(position), F.lit(True).alias("from_change"), F.col("row").cast(kind).alias("row"), "gone")
    return rows.unionByName(later)


def state_of(feed: DataFrame, key: str, position: str = "position") -> DataFrame:
    """The table that a feed leaves: the last write of each key, without deleted ones.

    A snapshot's row counts as later than the change at its own place. Writes meet per key in partial
    aggregates first, so a key with very many changes costs a row per task.
    """
    order = F.struct(F.col(position), (~F.col("from_change")).alias("seen"))
    last = F.max_by(F.struct("row", "gone"), order).alias("last")
    return feed.groupBy(key).agg(last).filter("not last.gone").select("last.row.*")
