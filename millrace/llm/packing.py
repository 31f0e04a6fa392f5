"""Packing documents into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut at every full window; full pieces are windows of their own. The rest pieces
(halved once where longer than half a window, which evens the sums out) are dealt in runs of
neighbouring rows to groups, and each group is partitioned into
``ceil(tokens / window)`` windows of near-equal sums: the differencing method starts with one partial
partition per piece, and again and again merges the two partial partitions with the largest
imbalance, laying the heaviest bin of one on the lightest bin of the other. If a window comes out
over its capacity the number of windows rises by one and the group is done again.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, small_batches

TOKENIZER = "byte_bpe_50k.json"
WINDOW = 1024
# Pieces in a group: bounds a task's work and keeps the one open window of a group small beside it.
GROUP_PIECES = 512
# A word takes about 200 bytes: the memory of a Python worker is bounded by this.
CACHE_WORDS = 800_000

PIECES = "doc_id long, start long, length long, doc_tokens long, checksum long, part int, run int, row long, rest_row long, file string, block long"
# Punctuation that no rule of byte-level tokenizers joins with letters.
PUNCTUATION = ".,;:!?*#$%&|()"
_CUT = re.compile(r" (?=\S)")
_SPACE_RUN = re.compile(r" (?:\s|$)")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file lies on this machine, and on every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself where it is printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class WordIds(dict):
    """Ids of words after a space, as little-endian 32-bit bytes, remembered for the commonest words.

    A byte-level tokenizer cuts before a space that a word follows, around a line break between two
    words, and between a word of letters and punctuation after it, so the ids of the parts joined
    are the ids of the whole text. Other tokenizers, and texts that hold one of its special tokens,
    are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split = rules["pre_tokenizer"] or {}
        self.byte_level = (
            not rules["normalizer"] and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space")
        )
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.letters = dict(enumerate(_byte_letters()))
        self.space = self.letters[32]
        self.tokenize = self.tokenizer.model.tokenize
        self.tail = lru_cache(4096)(self.one)
        self.first = lru_cache(100_000)(self.bare)
        self.line_break = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def one(self, word: str) -> bytes:
        """Ids of what the tokenizer never cuts: a word of letters or a run of punctuation."""
        if word.isascii():
            letters = self.space + word[1:] if word[0] == " " else word
        else:
            letters = word.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def bare(self, word: str) -> bytes:
        """Ids of a word that no space precedes."""
        stem = word.rstrip(PUNCTUATION)
        if not stem.isalpha():
            return self.whole(word)
        tail = word[len(stem) :]
        return self.one(stem) + (self.tail(tail) if tail else b"")

    def __missing__(self, word: str) -> bytes:
        if "\n" in word:
            first, *rest = parts = word.split("\n")
            if all(p and not p[0].isspace() and not p[-1].isspace() for p in parts):
                return b"".join([self[first], *(self.line_break + self.first(p) for p in rest)])
        stem = word.rstrip(PUNCTUATION)
        if stem.isalpha():
            tail = word[len(stem) :]
            ids = self[stem] + self.tail(tail) if tail else self.one(f" {stem}")
        else:
            ids = self.whole(f" {word}")
        if len(self) < CACHE_WORDS and len(word) < 64:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.byte_level or any(s in text for s in self.special):
            return self.whole(text)
        first, *rest = _CUT.split(text) if _SPACE_RUN.search(text) else text.split(" ")
        return b"".join([self.whole(first) if first else b"", *map(self.__getitem__, rest)])


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    """One memory per Python worker, whatever the number of tasks it runs."""
    return WordIds(path)


def piece_lengths(total: int, window: int) -> list[int]:
    """Full windows, then the rest, of which at most half a window stays in one piece."""
    half, rest = max(1, window // 2), total % window
    return [window] * (total // window) + [half] * (rest > half) + [rest - half * (rest > half)] * (rest > 0)


def _with_place(picked: DataFrame) -> DataFrame:
    """Adds ``file`` and ``block``: the file a row was read from, so that names sort like parts, and its split.

    Rows that come from no file, or from several joined, have an empty name.
    """
    try:
        named = picked.select("*", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"))
    except AnalysisException:
        return picked.select("*", F.lit("").alias("file"), F.lit(-1).cast("long").alias("block"))
    folder = F.regexp_replace("file", "[^/]*$", "")
    number = F.lpad(F.regexp_extract("file", "part-([0-9]+)[^/]*$", 1), 12, "0")
    return named.withColumn("file", F.when(F.col("file") == "", "").otherwise(F.concat(folder, number, F.lit(" "), "file")))


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int, end_id: int, keep_ids: bool) -> DataFrame:
    """One row per piece: its span, its ids' checksum and, if asked for, the ids.

    ``part`` is the task and ``run`` numbers the file splits it read; ``row`` numbers the pieces of a
    run, and ``rest_row`` those before it that fill no window. A run's first piece has its file and
    the split's start there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids = word_ids(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, own, place, row, rest_row = TaskContext.get().partitionId(), -1, None, 0, 0
        for batch in small_batches(batches, 256):
            out = []
            for doc_id, text, *at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "file", "block"))):
                if at != place:
                    own, place, row, rest_row = own + 1, at, 0, 0
                all_ids = ids.of(text or "") + end
                total, start = len(all_ids) // 4, 0
                for length in piece_lengths(total, window):
                    piece = all_ids[4 * start : 4 * (start + length)]
                    named = (None, None) if row else place
                    fields = (doc_id, start, length, total, zlib.crc32(piece), part, own, row, rest_row, *named)
                    out.append((*fields, piece) if keep_ids else fields)
                    start, row, rest_row = start + length, row + 1, rest_row + (length < window)
            columns = list(zip(*out)) if out else [[]] * (12 if keep_ids else 11)
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.string(), pa.int64()] + [pa.binary()] * keep_ids
            names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * keep_ids
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _with_place(picked).mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


def differencing(sizes: list[int], bins: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``bins`` sets of near-equal sums, by the largest-differencing method."""
    if bins <= 1:
        return [list(range(len(sizes)))]
    # A partial partition: its non-empty bins as (sum, indices), heaviest first; the other bins are empty.
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        merged = a + b
        if len(merged) > bins:
            # Bin k of one meets bin (bins - 1 - k) of the other; empty bins take the rest.
            over = len(merged) - bins
            whole_a, pair_a = a[: len(a) - over], a[len(a) - over :]
            whole_b, pair_b = b[: len(b) - over], b[len(b) - over :]
            joined = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(pair_a, reversed(pair_b))]
            merged = whole_a + whole_b + joined
        merged.sort(key=itemgetter(0), reverse=True)
        low = merged[-1][0] if len(merged) == bins else 0
        heapq.heappush(heap, (low - merged[0][0], tie, merged))
        tie += 1
    return [indices for _, indices in heap[0][2]] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Sets of indices whose sums are at most ``capacity``, as few as differencing gets by."""
    if not sizes:
        return []
    bins = -(-sum(sizes) // capacity)
    while True:
        sets = differencing(sizes, bins)
        if all(sum(sizes[i] for i in s) <= capacity for s in sets):
            return sets
        bins += 1


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    window: int = WINDOW,
    end_id: int = 0,
    group_pieces: int = GROUP_PIECES,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with the window each lies in.

    Columns: ``doc_id``, ``start`` and ``length`` (the piece's span among the document's ids),
    ``doc_tokens`` (with the closing ``end_id``), ``checksum`` (CRC-32 of the piece's ids as
    little-endian 32-bit numbers), ``sequence_id`` (a long, the same for pieces of one window: the
    place of the window's first piece among all pieces in input order),
    ``offset`` (the piece's place there, gapless from 0) and, with ``keep_ids``, ``ids`` (those bytes).

    Texts are tokenized whole and once, then written to the shared folder; only spans move
    afterwards. Input order is that of files by name and rows within them, whichever way the reader
    deals them to tasks; rows that come from no file count in the order of their partitions. Groups are runs of ``group_pieces`` neighbouring rest pieces in input order, so any
    mixture of the input is that of the windows, a group never grows with the data, and neither a
    hot document nor many copies can fill one. Null or empty text: the closing id alone. A null
    ``doc_id`` is kept; repeated rows are packed as often as they occur; other columns are ignored;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(cut_pieces(docs, tokenizer_path, window, end_id, keep_ids))
    rest = pieces.filter(F.col("length") < window)
    starts = F.broadcast(_starts(scratch, pieces, window))
    placed_at = (F.col("before") + F.col("row")).alias("position")
    number = F.col("rest_before") + F.col("rest_row")
    dealt = rest.join(starts, ["part", "run"]).select(placed_at, "length", F.floor(number / group_pieces).alias("unit"))

    def assign(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position")
        sizes, positions = group["length"].tolist(), group["position"].to_numpy()
        window_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for members in windows_of(sizes, window):
            at = 0
            for i in sorted(members):
                window_of[i], offset[i] = positions[min(members)], at
                at += sizes[i]
        return pd.DataFrame({"position": positions, "sequence_id": window_of, "offset": offset})

    placed = scratch.keep(dealt.groupBy("unit").applyInPandas(assign, "position long, sequence_id long, offset long"))
    own = [f"`{c}`" for c in pieces.columns if c not in ("part", "run", "row", "rest_row", "file", "block")]
    numbered = pieces.join(starts, ["part", "run"]).select(*own, placed_at)
    full = numbered.filter(F.col("length") >= window).select(*own, F.col("position").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = numbered.filter(F.col("length") < window).join(placed, "position").select(full.columns)
    return full.unionByName(shared)


def _starts(scratch: Scratch, pieces: DataFrame, window: int) -> DataFrame:
    """``(part, run, before, rest_before)``: pieces, and pieces that fill no window, before each run; a row per file split."""
    short = F.count_if(F.col("length") < window).alias("short")
    runs = scratch.keep(pieces.groupBy("part", "run").agg(F.max("file").alias("file"), F.max("block").alias("block"), F.count("*").alias("n"), short))
    earlier = Window.orderBy("file", "block", "part", "run").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(name) for c, name in (("n", "before"), ("short", "rest_before"))]
    return scratch.keep(runs.select("part", "run", *before))
