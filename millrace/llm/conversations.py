"""Repair of conversations whose rows do not follow one another as they should.

A repair is a path through a graph without circles: a node is a place between two rows and what the
result ends with there; an edge keeps, reroles or deletes the next row or inserts one. A path's
weight is **one integer**: its high digits are the cost, its low octal digits are the letters of its
edits, first letter first, in a field of fixed width that ends in zeros. The smallest integer is then
the cheapest path and, among those, the one whose letters come first in ASCII, so the ordinary
minimum of integers is the only decision anywhere. Nodes are taken from the last row backwards, so
that an edge puts its letter before a path that is already the best of its node.

Rows are cut into blocks of at most ``BLOCK_ROWS`` that may hold parts of many conversations. A part
gives a matrix of weights (from each state before it to each state after it), made in parallel; the
parts of a conversation are then multiplied pair by pair with minimum for sum. So a conversation
of very many rows is solved in many tasks, and only its letters, which are one value of the result,
come together. Its repaired text is hashed row by row in order, which SHA-256 requires; no task ever
holds more than a batch of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

BLOCK_BITS = 11
BLOCK_ROWS = 1 << BLOCK_BITS

# What the repaired rows so far end with: nothing, a system row, a user row, an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
# Octal digits of the letters, in ASCII order; zero is the padding.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {str(d): letter for letter, d in DIGITS.items()}
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
# State after a row of this initial, by the state before it.
AFTER = {
    "s": {EMPTY: SYSTEM},
    "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
# The one role that an inserted or reroled row can have after each state.
FREE = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
ENDS = (EMPTY, ASSISTANT)
# Faults, by a row's first.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

Paths = list[list[int | None]]


def _led_by(edge: int, letter: str, path: int | None, width: int) -> int | None:
    """The weight of an edge and then a path: costs add up, the letter moves the path's one place on."""
    if path is None:
        return None
    field = 3 * width
    low = path & ((1 << field) - 1)
    return (edge + (path >> field) << field) | DIGITS[letter] << field - 3 | low >> 3


def _least(weights: list[int | None]) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _with_inserts(after: list[int | None], width: int) -> list[int | None]:
    """Best paths when rows may be inserted first; more than two in a row would meet a state again."""
    for _ in range(2):
        after = [_least([after[s], _led_by(INSERT, "I", after[FREE[s]], width)]) for s in STATES]
    return after


def part_weights(rows: list[tuple[str, int, int]]) -> tuple[Paths, int]:
    """``weights[end][start]`` of a part of a conversation, and the width of their letter fields.

    A row is ``(initial, fault, copies)``; all copies but the first are repeats.
    """
    width = sum(copies + 2 for *_, copies in rows) + 2
    out: Paths = []
    for end in STATES:
        best = _with_inserts([0 if s == end else None for s in STATES], width)
        for initial, fault, copies in reversed(rows):
            for copy in reversed(range(copies)):
                own = DUPLICATE if copy and fault != BLANK else fault
                extra = CUT_SHORT if own == TRUNCATED else 0
                step = []
                for state in STATES:
                    ways = [_led_by(DELETE, "D", best[state], width)]
                    if own not in (BLANK, DUPLICATE):
                        to = AFTER.get(initial, {}).get(state)
                        if to is not None:
                            ways.append(_led_by(KEEP + extra, "K", best[to], width))
                        ways.append(_led_by(REROLE + extra, "R", best[FREE[state]], width))
                    step.append(_least(ways))
                best = step
            best = _with_inserts(best, width)
        out.append(best)
    return out, width


def letters_of(weight: int, width: int) -> str:
    """The letters in a weight's low digits."""
    low = weight & ((1 << 3 * width) - 1)
    return "".join(LETTERS[d] for d in f"{low:0{width}o}".rstrip("0")) if low else ""


def _joined(a: int | None, a_width: int, b: int | None, b_width: int) -> int | None:
    """The weight of a path and then another: the second's letters follow the first's."""
    if a is None or b is None:
        return None
    low = a & ((1 << 3 * a_width) - 1)
    free = ((low & -low).bit_length() - 1) // 3 if low else a_width
    width = a_width + b_width
    b_low = b & ((1 << 3 * b_width) - 1)
    return (a << 3 * b_width) + (b >> 3 * b_width << 3 * width) + (b_low << 3 * free)


def _times(a: tuple[Paths, int], b: tuple[Paths, int]) -> tuple[Paths, int]:
    """Matrix of two parts in a row: over the states between them, the least."""
    (left, a_width), (right, b_width) = a, b
    out = [[_least([_joined(left[m][s], a_width, right[e][m], b_width) for m in STATES]) for s in STATES] for e in STATES]
    return out, a_width + b_width


def whole_path(parts: list[tuple[Paths, int]]) -> tuple[int, str]:
    """Cost and letters of the best repair of all parts, which are multiplied in a tree."""
    while len(parts) > 1:
        pairs = [_times(parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[2 * len(pairs) :]
    weights, width = parts[0]
    best = _least([weights[end][EMPTY] for end in ENDS])
    return best >> 3 * width, letters_of(best, width)


def _packed(weights: Paths) -> list[bytes]:
    """Weights as bytes, no path as none; one byte more than the digits take, so none is empty."""
    return [b"" if w is None else w.to_bytes(w.bit_length() // 8 + 1, "little") for row in weights for w in row]


def _unpacked(held: list[bytes]) -> Paths:
    flat = [int.from_bytes(h, "little") if h else None for h in held]
    return [flat[4 * end : 4 * end + 4] for end in STATES]


def _partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _visible(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+$", "")


def numbered_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, keep: Column) -> DataFrame:
    """``(conv, place, turn, role, text, n, fault)``: distinct rows in order, with their faults.

    Equal rows of a turn are one row with a count, taken before the shuffle. ``place`` rises with
    conversation, turn (nulls first), role and text over all tasks: rows are dealt by ranges, so a large
    conversation spreads over several. A conversation whose rows all go keeps one row of count zero.
    """
    scratch = Scratch(rows.sparkSession, "conversations")
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.when(keep, F.col(f"`{turn}`").cast("long")).alias("turn"),
        F.when(keep, F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" "))).otherwise("").alias("role"),
        F.when(keep, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))).otherwise("").alias("text"),
        F.coalesce(keep.cast("long"), F.lit(0).cast("long")).alias("n"),
    )
    once = scratch.keep(plain.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")))
    # The complement of the key lets the join shuffle both sides, and so split a hot one.
    same = F.sha2(F.to_json(F.struct("conv", "role", "text")), 256)
    known = once.filter("n > 0").select(F.reverse(same).alias("k"), "turn")
    # A turn of null is the earliest.
    first = F.when(~F.bool_or(F.col("turn").isNull()), F.min("turn"))
    several = known.groupBy("k").agg(F.count("*").alias("turns"), first.alias("first"))
    several = several.filter("turns > 1").select(F.reverse("k").alias("same"), "first", F.lit(True).alias("again"))
    keyed = once.withColumn("key", same)
    met = keyed.join(several, keyed["key"] == several["same"], "left")
    end = _visible(F.col("text"))
    fault = (
        F.when(end == "", BLANK)
        .when(F.col("again") & ~F.col("turn").eqNullSafe(F.col("first")), DUPLICATE)
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(NONE)
    )
    judged = met.select("conv", "turn", "role", "text", "n", fault.alias("fault"))
    order = ["conv", "turn", "role", "text"]
    ordered = judged.repartitionByRange(_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return scratch.keep(ordered.withColumn("place", F.monotonically_increasing_id()))


def _block_weights(numbered: DataFrame) -> DataFrame:
    """``(conv, block, weights, width)`` per part of a conversation."""
    kind = dict(numbered.dtypes)["conv"]

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        columns = [group.column(c).to_pylist() for c in ("conv", "initial", "fault", "n")]
        parts: dict[object, list] = {}
        for conv, initial, fault, n in zip(*columns):
            parts.setdefault(conv, []).append((initial, fault, n))
        solved = [(conv, *part_weights(rows)) for conv, rows in parts.items()]
        block = group.column("block")[0]
        return pa.table(
            {
                "conv": pa.array([c for c, _, _ in solved], group.schema.field("conv").type),
                "block": pa.array([block.as_py()] * len(solved), pa.int64()),
                "weights": pa.array([_packed(w) for _, w, _ in solved], pa.list_(pa.binary())),
                "width": pa.array([w for _, _, w in solved], pa.int64()),
            }
        )

    block = F.shiftright("place", BLOCK_BITS).alias("block")
    light = numbered.select("conv", "place", block, F.left("role", F.lit(1)).alias("initial"), "fault", "n")
    # Few bytes but much work: a given number of partitions is not merged into one.
    light = light.repartition(_partitions(numbered.sparkSession), "block")
    return light.groupBy("block").applyInArrow(run, f"conv {kind}, block long, weights array<binary>, width long")


def _in_order(rows: DataFrame, by: str) -> DataFrame:
    """All rows of a conversation in one task, in order, read as a stream."""
    return rows.repartition(F.col("conv")).sortWithinPartitions("conv", by)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """``(first of its conversation, conv, values...)`` per row."""
    before, started = None, False
    for batch in batches:
        for conv, *values in zip(*(batch.column(c).to_pylist() for c in ("conv", *names))):
            yield (not started or conv != before, conv, *values)
            before, started = conv, True


def best_paths(numbered: DataFrame) -> DataFrame:
    """``(conv, cost, audit)``."""
    parts = _block_weights(numbered)
    kind = dict(numbered.dtypes)["conv"]
    arrow = {f.name: f.type for f in _arrow_fields(numbered)}["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, owner = [], [], None
        for new, conv, weights, width in _runs(batches, ["weights", "width"]):
            if new and held:
                done.append((owner, *whole_path(held)))
                held = []
                if len(done) >= 1000:
                    yield _records(done, [("conv", arrow), ("cost", pa.int64()), ("audit", pa.string())])
                    done = []
            owner = conv
            held.append((_unpacked(weights), width))
        if held:
            done.append((owner, *whole_path(held)))
        yield _records(done, [("conv", arrow), ("cost", pa.int64()), ("audit", pa.string())])

    return _in_order(parts, "block").mapInArrow(run, f"conv {kind}, cost long, audit string")


def _arrow_fields(df: DataFrame) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(df.schema))


def _records(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


class _Repair:
    """One conversation as its rows pass by: counts, and the hash of what the audit leaves of them."""

    def __init__(self, cost: int, audit: str):
        self.cost, self.audit, self.at, self.state = cost, audit, 0, EMPTY
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.lowest = self.highest = self.last_turn = self.last_role = None
        self.hash, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"\n{role}:{text}".encode() if self.lines else f"{role}:{text}".encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state, self.at = FREE[self.state], self.at + 1
            self._line(ROLE_OF[self.state], "")

    def add(self, turn: int | None, role: str, text: str, n: int, fault: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.lowest, self.highest, self.last_turn = turn if self.turns == 0 else self.lowest, turn, turn
            self.turns += 1
        initial = role[:1]
        self.faults[fault] += 1
        self.faults[BLANK if fault == BLANK else DUPLICATE] += n - 1
        if self.last_role is not None:
            self.illegal += self.last_role + initial not in ("su", "ua", "au")
        self.illegal += (n - 1) * (initial + initial not in ("su", "ua", "au"))
        self.last_role = initial
        for _ in range(n):
            self._inserted()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit == "K":
                self.state = AFTER[initial][self.state]
                self._line(role, text)
            elif edit == "R":
                self.state = FREE[self.state]
                self._line(ROLE_OF[self.state], text)

    def row(self) -> tuple:
        self._inserted()
        gaps = self.highest - self.lowest + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults[BLANK:], self.illegal, self.cost, self.audit, self.hash.hexdigest())


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", keep: Column | None = None
) -> DataFrame:
    """One row per conversation: faults, the cheapest repair's cost and letters, and its text's hash.

    Columns: ``conv``, then ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``
    (longs), ``audit`` and ``repaired_sha256``. Rows for which ``keep`` is not true are as if they did
    not exist, but their conversations are reported: zeros, no letters, the hash of nothing.

    Rows are ordered by turn (nulls first), then role and text, so repeated rows are adjacent and ties
    have one order whatever the order of the input. Null roles and texts are one space; a null
    conversation id is a conversation of its own. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    given = rows.select(*(F.col(f"`{c}`").alias(c) for c in dict.fromkeys((conv, turn, role, text))), (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias("stays"))
    numbered = numbered_rows(given, conv, turn, role, text, F.col("stays"))
    kind = dict(numbered.dtypes)["conv"]
    arrow = {f.name: f.type for f in _arrow_fields(numbered)}["conv"]
    longs = [(c, pa.int64()) for c in RESULT[:6]]
    fields = [("conv", arrow), *longs, ("audit", pa.string()), ("repaired_sha256", pa.string())]
    names = ["turn", "role", "text", "n", "fault", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, owner, done = None, None, []
        for new, conv_id, turn_no, role_of, body, n, fault, cost, audit in _runs(batches, names):
            if new:
                if current:
                    done.append((owner, *current.row()))
                if len(done) >= 1000:
                    yield _records(done, fields)
                    done = []
                # The path sorts before the rows.
                current, owner = _Repair(cost, audit), conv_id
            elif n:
                current.add(turn_no, role_of, body, n, fault)
        if current:
            done.append((owner, *current.row()))
        yield _records(done, fields)

    empty = {c: F.lit(None).cast(t) for c, t in (("cost", "long"), ("audit", "string"))}
    texts = numbered.select("conv", "place", "turn", "role", "text", "n", "fault").withColumns(empty)
    own = {"place": -1, "turn": None, "role": "", "text": "", "n": 0, "fault": 0}
    paths = best_paths(numbered).withColumns({c: F.lit(v).cast(dict(texts.dtypes)[c]) for c, v in own.items()})
    together = texts.unionByName(paths)
    schema = f"conv {kind}, " + ", ".join(f"{c} long" for c in RESULT[:6]) + ", audit string, repaired_sha256 string"
    found = _in_order(together, "place").mapInArrow(run, schema)
    return found.withColumnRenamed("conv", conv)


def damaged(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, str]:
    """Rows with planted faults, by the checksum of ``<conv>:<turn>`` modulo 20; and the column that says which stay.

    0 drops a row, 1 empties its text, 2 takes out its full stops, question and exclamation marks, 3
    repeats it, 4 makes it the user's. Nulls of any of the four columns are one space before that.
    """
    spaced = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn, role, text)}
    which = F.crc32(F.encode(F.concat(spaced[conv], F.lit(":"), spaced[turn]), "UTF-8")) % 20
    body = F.when(which == 1, "").when(which == 2, F.regexp_replace(spaced[text], "[.!?]", "")).otherwise(spaced[text])
    copies = F.when(which == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = rows.select(
        F.col(f"`{conv}`"),
        F.col(f"`{turn}`"),
        F.when(which == 4, "user").otherwise(spaced[role]).alias(role),
        body.alias(text),
        (which != 0).alias("stays"),
        F.explode(copies).alias("copy"),
    )
    return out.drop("copy"), "stays"
