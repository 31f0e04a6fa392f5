"""Spelling variants: words one edit apart, and the frequent form a rare one stands for.

A word's letters are a multiset, and a multiset is a binary vector with one place for each letter's
first, second, ... occurrence. One inserted or deleted letter changes one place and one replaced
letter two, so near words lie at Hamming distance at most two. PartEnum finds all such vectors by
equal keys: places are dealt to ``PARTS`` parts, and a signature is what a vector holds in all parts
but two. Two vectors at distance two or less differ in at most two parts, so they agree in the
signature that leaves those out. Vectors that share a signature are joined on it, checked by their
distance, and their words by the edit itself; no pair is lost and none is added.

Words of equal letters are never one edit apart, so signatures are taken once per multiset. Every table
here grows with the vocabulary, so all joins shuffle both sides and none goes through the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, shuffled, small_batches

PARTS = 8
DISTANCE = 2
KEPT_PARTS = tuple(combinations(range(PARTS), PARTS - DISTANCE))
RUN = re.compile("[a-zÀ-ÿ]+")
# Distinct words that a task counts before it hands them on.
COUNTED_AT_ONCE = 200_000
MAX_ROUNDS = 64


def lowered(text: str) -> str:
    """The text with A-Z in lower case, all else as it is."""
    return text.encode().lower().decode()


def with_slip(run: str, doc: bytes, every: int) -> str:
    """The run, or what is left of it where its checksum within the document makes it lose a letter."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc + b":"))
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, slips: int | None = None
) -> DataFrame:
    """``(word, n)`` of all runs of letters with at least ``min_length`` code points.

    ``slips``: about one run in so many loses a letter, by the checksum of ``<id>:<run>``, which plants
    misspellings to be found. Null texts have no words; a null id counts as empty text. Each task
    counts before the shuffle, so a word in every document costs a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words, n = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
            return pa.record_batch([words, n], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                of_text = Counter(m.group() for m in RUN.finditer(lowered(text.as_py())))
                doc = doc.encode()
                for word, n in of_text.items():
                    if len(word) < min_length:
                        continue
                    word = with_slip(word, doc, slips) if slips else word
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= COUNTED_AT_ONCE:
                    yield out()
                    counts.clear()
        yield out()

    text = F.col(f"`{text_col}`").cast("string")
    picked = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc"), text.alias("text"))
    counted = picked.filter("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _place(letter: str, nth: int) -> int:
    """A fixed 64-bit number for the nth occurrence of a letter."""
    text = f"{letter}{nth}".encode()
    return zlib.crc32(text) << 32 | zlib.crc32(text, 0x5EED)


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64))


def signatures(letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each sorted text: a mask that flips one bit per place, and its signatures.

    Two vectors at distance ``d`` have masks that differ in at most ``d`` bits. A part's content is the
    sum of its places' numbers; a signature is a polynomial in the contents of the parts it keeps.
    """
    places: dict[tuple[str, int], tuple[int, int, int]] = {}
    masks, parts = np.zeros(len(letters), np.uint64), np.zeros((len(letters), PARTS), np.uint64)
    for row, text in enumerate(letters):
        mask, held = 0, [0] * PARTS
        before, nth = "", 0
        for letter in text:
            nth = nth + 1 if letter == before else 1
            before = letter
            known = places.get((letter, nth))
            if known is None:
                number = _place(letter, nth)
                # Part from the checksum's low end, bit and content from the rest.
                known = places[letter, nth] = ((number >> 32) % PARTS, 1 << (number & 63), number)
            part, bit, number = known
            mask ^= bit
            held[part] = held[part] + number & 0xFFFFFFFFFFFFFFFF
        masks[row], parts[row] = mask, held
    out = np.zeros((len(letters), len(KEPT_PARTS)), np.uint64)
    for which, kept in enumerate(KEPT_PARTS):
        key = np.full(len(letters), which + 1, np.uint64)
        for part in kept:
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + parts[:, part]
        out[:, which] = key
    return masks, out


def _signed_vectors(vectors: DataFrame) -> DataFrame:
    """``(letters, size)`` to ``(key, letters, size, mask)``, a row per signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches([batch], 4096):
                masks, keys = signatures(some.column("letters").to_pylist())
                offsets = pa.array(np.arange(0, keys.size + 1, len(KEPT_PARTS), dtype=np.int32))
                rows = pa.ListArray.from_arrays(offsets, _signed(keys.ravel()))
                arrays = [some.column("letters"), some.column("size"), _signed(masks), rows]
                yield pa.record_batch(arrays, names=["letters", "size", "mask", "keys"])

    signed = vectors.mapInArrow(run, "letters string, size int, mask long, keys array<long>")
    return signed.select(F.explode("keys").alias("key"), "letters", "size", "mask")


def near_vectors(classes: DataFrame) -> DataFrame:
    """``(few, many)``: pairs of letter multisets at distance one or two, each pair once.

    ``classes`` is ``(letters, size, words)``; the one of each pair with fewer words comes first.
    """
    keyed = _signed_vectors(classes.select("letters", "size"))
    left = keyed.toDF("key", "a", "a_size", "a_mask")
    right = keyed.toDF("key", "b", "b_size", "b_mask")
    apart = F.bit_count(F.col("a_mask").bitwiseXOR(F.col("b_mask"))) <= DISTANCE
    close = (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.abs(F.col("a_size") - F.col("b_size")) <= 1)
    met = left.join(shuffled(right), close & apart).select("a", "b").distinct()
    words = classes.select("letters", "words")
    sized = met.join(shuffled(words.toDF("a", "a_words")), "a").join(shuffled(words.toDF("b", "b_words")), "b")
    first = F.struct("a_words", "a") <= F.struct("b_words", "b")
    return sized.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("few"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("many"))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``, both ways round: distinct words one edit apart.

    ``words`` is ``(word, n)``. Every pair found by a signature is checked by edit distance; pairs of
    multisets are joined to words on the smaller side first.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    known = scratch.keep(words.select("word", "n", letters.alias("letters")))
    classes = known.groupBy("letters").agg(F.count("*").alias("words"))
    classes = scratch.keep(classes.withColumn("size", F.char_length("letters")))
    pairs = scratch.keep(near_vectors(classes))
    small = pairs.join(shuffled(known.toDF("word", "n", "few")), "few").select("many", "word", "n")
    large = known.toDF("other", "other_n", "many")
    one_edit = (F.levenshtein("word", "other", 1) == 1) & (small["many"] == large["many"])
    met = scratch.keep(small.join(shuffled(large), one_edit).select("word", "n", "other", "other_n"))
    return met.union(met.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the last word on the way from form to form.

    Each round doubles the way gone, so chains of any length take few joins; forms rise in frequency, so
    there is no circle.
    """
    scratch = Scratch(forms.sparkSession, "roots")
    current = scratch.keep(forms.select("word", F.col("form").alias("root")))
    for _ in range(MAX_ROUNDS):
        further = shuffled(current.toDF("middle", "further"))
        after = current.join(further, F.col("root") == F.col("middle"), "left")
        after = scratch.keep(after.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        scratch.drop(current)
        current = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return current
        scratch.paths[id(current)] = scratch.paths.pop(id(after))
    raise RuntimeError(f"forms still lead on after {MAX_ROUNDS} rounds")


def variants(counts: DataFrame, *, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all words seen at least ``min_count`` times.

    ``counts`` is ``(word, n)``, a word once. A word's form is its near word of largest ``n`` (ties: the
    smallest in code-point order), if it is seen at least ``ratio`` times as often; its root is where
    forms lead in the end, itself if it has none. An empty table gives no rows.
    """
    scratch = Scratch(counts.sparkSession, "variants")
    words = scratch.keep(counts.filter((F.col("n") >= min_count) & (F.col("word") != "")).select("word", "n"))
    # The largest count and then the smallest word: the least of the negated count and the word.
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(shuffled(near), "word", "left")
    often = -F.col("best.n") >= ratio * F.col("n")
    formed = scratch.keep(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(often, F.col("best.word")).alias("form"),
            F.when(often, -F.col("best.n")).alias("form_n"),
        )
    )
    ends = roots(formed.filter("form IS NOT NULL"))
    rooted = formed.join(shuffled(ends), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
