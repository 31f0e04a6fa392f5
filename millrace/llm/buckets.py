"""Links among items that share bucket keys, without all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.llm.components import components

Near = Callable[[Column, Column], Column]
# The same with the key that two items share.
NearBy = Callable[[Column, Column, Column], Column]
# Items of a bucket beyond which they first meet some of it, how many at a time, and how often.
WIDE, PIVOTS, TURNS = 64, 12, 2


def firsts(keyed: DataFrame, near: Near) -> DataFrame:
    """``(key, item, first, n)``: rows of buckets with the smallest of their items and the count.

    Of a bucket of two, most of which meet by chance, there is one row if they are near; of a larger
    one there are all. Buckets are counted before the shuffle and meet their items by a join, which
    Spark splits where a bucket is hot.
    """
    least = keyed.groupBy("key").agg(F.min("item").alias("first"), F.count("*").alias("n")).filter("n > 1")
    least = least.withColumnRenamed("key", "bucket")
    pair = (F.col("item") != F.col("first")) & near(F.col("first"), F.col("item"))
    met = keyed.join(least, (F.col("key") == F.col("bucket")) & ((F.col("n") > 2) | pair))
    return met.select("key", "item", "first", "n")


class Runs:
    """Rows sorted by key as they pass by: which is the first of its key, and whether a key has two rows or more.

    Rows are numpy columns, the key first. Of a key of one row nothing comes out, of a key of two its
    second row, of a larger one all. At most two rows of a key that may go on are held back.
    """

    def __init__(self) -> None:
        self.held: list[np.ndarray] | None = None
        self.first: list | None = None  # of a key known to have three rows or more

    def add(self, columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        """Columns, those of each row's first, and the count (3 for three or more) of rows now settled."""
        if self.first is not None:
            other = np.flatnonzero(columns[0] != self.first[0])
            n = int(other[0]) if len(other) else len(columns[0])
            if n:
                yield self._shown([c[:n] for c in columns], [np.full(n, f, c.dtype) for f, c in zip(self.first, columns)], np.full(n, 3))
            if n == len(columns[0]):
                return
            columns, self.first = [c[n:] for c in columns], None
        elif self.held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(self.held, columns)]
        key = columns[0]
        starts = np.append(0, 1 + np.flatnonzero(key[1:] != key[:-1]))
        counts = np.diff(np.append(starts, len(key)))
        if counts[-1] <= 2:
            self.held = [c[starts[-1] :] for c in columns]
            columns, counts, starts = [c[: starts[-1]] for c in columns], counts[:-1], starts[:-1]
        else:
            self.held, self.first = None, [c[starts[-1]] for c in columns]
        yield from self._settled(columns, starts, counts)

    def end(self) -> Iterator[list[np.ndarray]]:
        if self.held is not None:
            yield from self._settled(self.held, np.zeros(1, np.int64), np.array([len(self.held[0])]))

    def _settled(self, columns: list[np.ndarray], starts: np.ndarray, counts: np.ndarray) -> Iterator[list[np.ndarray]]:
        lead, many = np.repeat(starts, counts), np.minimum(np.repeat(counts, counts), 3)
        at = np.flatnonzero((many == 3) | ((many == 2) & (np.arange(len(lead)) > lead)))
        if len(at):
            yield self._shown([c[at] for c in columns], [c[lead[at]] for c in columns], many[at])

    def _shown(self, rows: list, firsts: list, counts: np.ndarray) -> list[np.ndarray]:
        return [*rows, *firsts[1:], counts.astype(np.int32)]


def sorted_firsts(keyed: DataFrame, near: NearBy) -> DataFrame:
    """The same as ``firsts`` from flat longs ``(key, ...)``, whose items are structs of the rest; ``near`` sees the key.

    Rows are shuffled once, sorted by key and item, and read as a stream, so that a bucket of any size
    takes no memory.
    """
    fields = keyed.columns[1:]
    names = ["key", *fields, *(f"first_{c}" for c in fields), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs()
        for batch in batches:
            if batch.num_rows:
                for found in runs.add([batch.column(c).to_numpy() for c in ("key", *fields)]):
                    yield pa.record_batch([pa.array(c) for c in found], names=names)
        for found in runs.end():
            yield pa.record_batch([pa.array(c) for c in found], names=names)

    ordered = keyed.repartition("key").sortWithinPartitions("key", *fields)
    found = ordered.mapInArrow(run, ", ".join(f"{c} long" for c in names[:-1]) + ", n int")
    item = F.struct(*fields).alias("item")
    first = F.struct(*(F.col(f"first_{c}").alias(c) for c in fields)).alias("first")
    return found.select("key", item, first, "n").filter(
        (F.col("n") > 2) | near(F.col("first"), F.col("item"), F.col("key"))
    )


def labels(star: DataFrame) -> DataFrame:
    """``(item, label)`` from links ``(a, b)``, a < b: a smaller item two links away, or one.

    Items of one label are connected, which is all a label says.
    """
    one = star.groupBy(F.col("b").alias("item")).agg(F.min("a").alias("near"))
    two = one.join(one.toDF("middle", "far"), F.col("near") == F.col("middle"), "left")
    return two.select("item", F.coalesce("far", "near").alias("label"))


def _relabelled(rows: DataFrame, column: str, joined: DataFrame) -> DataFrame:
    """``rows`` whose label is that of the component, if it has one in ``joined``."""
    new = joined.toDF("node", "joined")
    met = rows.join(new, F.col(column) == F.col("node"), "left")
    return met.withColumn(column, F.coalesce("joined", column)).drop("node", "joined")


def _met_at_pivots(open_rows: DataFrame, close: NearBy, verify: Callable, tried: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """``open_rows`` with fewer labels, the links that joined them, and the pairs tried, as far as buckets are wide.

    In each of the ``TURNS`` an item takes part in one of its wide buckets, where it is tried with ``PIVOTS`` items of it. What one pivot misses another finds, so a large group of near copies comes to a few labels
    at so many pairs per item. All pairs whose labels still differ are left to the caller.
    """
    scratch = Scratch(open_rows.sparkSession, "pivots")
    wide = open_rows.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    wide = scratch.keep(wide.filter((F.col("n") > WIDE) & (F.col("low") < F.col("high"))).select(F.col("key").alias("bucket"), "n"))
    if wide.isEmpty():
        scratch.drop(wide)
        return open_rows, None, None
    rows = open_rows.join(wide, F.col("key") == F.col("bucket")).select("key", "n", "item", "label")
    rows, links = scratch.keep(rows), None
    for turn in range(TURNS):
        # First the widest bucket of each item; then that of smallest hash, in which items with many keys in common meet.
        at = F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("place"), "key")) if turn else F.max(F.struct("n", "key"))
        dealt = scratch.keep(rows.groupBy("item", "label").agg(at.alias("at")).select("at.key", "item", "label"))
        picked = [F.min(F.struct(F.xxhash64("item", F.lit(turn * PIVOTS + i)).alias("place"), F.col("item").alias("y"), F.col("label").alias("y_label"))) for i in range(PIVOTS)]
        # By the complement, so that the join shuffles both sides and a hot bucket can be split.
        pivots = dealt.groupBy(F.bitwise_not("key").alias("k")).agg(F.array(*picked).alias("pivots"))
        pivots = pivots.select(F.bitwise_not("k").alias("bucket"), F.explode("pivots").alias("pivot")).select("bucket", "pivot.y", "pivot.y_label")
        apart = (F.col("key") == F.col("bucket")) & (F.col("label") != F.col("y_label")) & close(F.col("item"), F.col("y"), F.col("key"))
        met = dealt.join(pivots, apart).select(F.least("item", "y").alias("a"), F.greatest("item", "y").alias("b"), "label", "y_label")
        met = scratch.keep(met.dropDuplicates(["a", "b"]).join(tried, ["a", "b"], "left_anti"))
        held = scratch.keep(verify(met.select("a", "b")).select("a", "b"))
        joined = components(held.join(met, ["a", "b"]), "label", "y_label")
        after = scratch.keep(_relabelled(rows, "label", joined))
        scratch.drop(dealt)
        scratch.drop(rows)
        rows, open_rows, tried = after, _relabelled(open_rows, "label", joined), tried.union(met.select("a", "b"))
        links = held if links is None else links.union(held)
    scratch.drop(wide)
    scratch.drop(rows)
    return open_rows, links, tried


def _still_apart(across: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of ``across`` whose labels differ after each two labels of ``held`` became one."""
    joined = components(held, "x_label", "y_label")
    for end in ("x_label", "y_label"):
        across = _relabelled(across, end, joined)
    return across.filter("x_label != y_label").select("a", "b")


def bucket_links(
    keyed: DataFrame,
    near: Near | None,
    verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
    near_by: NearBy | None = None,
    order: Near | None = None,
    once: NearBy | None = None,
) -> DataFrame:
    """``(a, b)``, a < b: verified links whose connected components are those of all verified pairs.

    ``keyed`` is ``(key, item)``; two items may be linked if they share a key, are ``near`` and pass
    ``verify`` (a frame of pairs to the frame of those that hold). In each bucket the items near its
    smallest one are hung on that. Then only pairs are looked at of which one was not hung there and
    whose labels differ, so a bucket of copies costs a link per member, while no two items that some
    pair joins stay apart.

    With ``near_by`` nearness may depend on the key as well, ``keyed`` is flat with an ``id`` of its own for each
    item (see ``sorted_firsts``), and a label is the component of what was hung, not only two links of it. Items of
    wide buckets then meet at pivots before all pairs across labels (see ``_met_at_pivots``).
    With ``once`` pairs across labels are met where it holds, which must be so at one key at least of those that
    two items share and are near by.
    With ``order`` the first pair by it across each two labels is verified ahead of the others, and what holds joins
    the labels. All pairs whose labels still differ follow, so a group of near copies costs about a pair per label
    that it joins, not one per member.
    """
    scratch = Scratch(keyed.sparkSession, "buckets")
    close = near_by or (lambda a, b, _: near(a, b))
    rows = scratch.keep(sorted_firsts(keyed, near_by) if near_by else firsts(keyed, near))
    hung = rows.filter((F.col("item") != F.col("first")) & close(F.col("first"), F.col("item"), F.col("key")))
    tried = scratch.keep(hung.select(F.col("first").alias("a"), F.col("item").alias("b")).distinct())
    star = scratch.keep(verify(tried).select("a", "b"))
    # A bucket of two has been tried.
    open_rows = rows.filter("n > 2")
    if near_by:
        joined = components(star.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")), "a", "b")
        joined = joined.select(F.col("node").alias("label_of"), F.col("component").alias("label"))
        open_rows = open_rows.join(joined, F.col("item.id") == F.col("label_of"), "left").drop("label_of")
        alone = F.col("item.id")
    else:
        open_rows, alone = open_rows.join(labels(star), "item", "left"), F.col("item")
    held = star.select(F.col("a").alias("first"), F.col("b").alias("item"), F.lit(True).alias("hung"))
    open_rows = open_rows.join(held, ["first", "item"], "left").select(
        "key",
        "item",
        F.coalesce("label", alone).alias("label"),
        F.coalesce("hung", F.col("item") == F.col("first")).alias("hung"),
    )
    open_rows = scratch.keep(open_rows)
    scratch.drop(rows)
    found, seen, apart_rows = star, tried, open_rows
    if near_by:
        apart_rows, more, also = _met_at_pivots(open_rows, near_by, verify, tried)
        if more is not None:
            found, seen, apart_rows = found.union(more), also, scratch.keep(apart_rows)
    left, right = apart_rows.toDF("key", "x", "x_label", "x_hung"), apart_rows.toDF("key", "y", "y_label", "y_hung")
    apart = (
        (left["key"] == right["key"])
        & (F.col("x_label") < F.col("y_label"))
        & ~(F.col("x_hung") & F.col("y_hung"))
        & close(F.col("x"), F.col("y"), left["key"])
    )
    if once:
        apart = apart & once(F.col("x"), F.col("y"), left["key"])
    across = left.join(right, apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "x_label", "y_label")
    # Labels follow from the pair: dealt by it alone, pairs need no other shuffle to meet those tried.
    across = scratch.keep(across.dropDuplicates(["a", "b"]).join(seen, ["a", "b"], "left_anti"))
    scratch.drop(tried)
    scratch.drop(open_rows)
    if apart_rows is not open_rows:
        scratch.drop(apart_rows)
    if order:
        ranked = F.min(F.struct(order(F.col("a"), F.col("b")).alias("place"), "a", "b")).alias("pair")
        tried = scratch.keep(across.groupBy("x_label", "y_label").agg(ranked).select("x_label", "y_label", "pair.a", "pair.b"))
        held = scratch.keep(verify(tried.select("a", "b")).select("a", "b"))
        found = found.union(held)
        after = _still_apart(across, held.join(tried, ["a", "b"]))
        after = scratch.keep(after.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        scratch.drop(tried)
        scratch.drop(across)
        across = after
    rest = scratch.keep(verify(across.select("a", "b")).select("a", "b"))
    scratch.drop(across)
    return found.union(rest)
