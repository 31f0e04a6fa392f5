"""SimHash near-duplicate groups, with candidates from Golay-code keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. If two fingerprints differ in
at most four bits, two of the three segments differ in at most two bits each (three and three would
be six). The binary Golay code of length 23 is perfect: every word has exactly one codeword within
three bits. A segment's keys are the codewords nearest to it and to each word one bit away, which
are one or six. Two segments within two bits have a word within one bit of both, so they share a
key. Candidates are therefore all pairs that share a key in two segments, and every pair within four
bits is among them: the join loses nothing, and the bit distance is then checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.buckets import firsts, labels
from millrace.llm.common import Scratch, free_name, small_batches
from millrace.llm.components import components

MAX_BITS = 4
SEED = 42
# Up to so many kept ids are broadcast to the documents; beyond that texts are shuffled.
BROADCAST_IDS = 1_000_000
# The generator polynomial of the (23, 12) Golay code, and the segments as (shift, bits).
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper twelve bits, and the error of at most three bits per remainder."""
    upper = np.array([_syndrome(w << 11) for w in range(1 << 12)], dtype=np.int64)
    errors = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(1, 4):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            errors[_syndrome(error)] = error
    return upper, errors


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword within three bits of each 23-bit word."""
    upper, errors = golay_tables()
    return (words ^ errors[(words & 0x7FF) ^ upper[words >> 11]]) >> 11


def segment_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and its one-bit neighbours, sorted, and a mask of the distinct."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    found = np.sort(nearest_codeword(words[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, first


def fingerprint(text: str | None, words: int) -> int:
    """Fingerprint of one text, unsigned: a bit is set if more than half of the shingles set it."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    cuts = zip(starts[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in cuts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 4096):  # a long text needs no more memory than a short one
        block = hashes[i : i + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(id, fp)`` per row; ``fp`` holds the 64 bits as a signed long. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            values = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(signed)], names=["id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "id long, fp long")


def golay_keys(prints: DataFrame) -> DataFrame:
    """``(key, item, label, lead)``: the keys of each ``(fp, label)``, at most 36 per pair of segments.

    ``lead`` tells whether the key is the first of the left (1) and of the right segment (2).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2048):
            fp, label = batch.column("fp").to_numpy(), batch.column("label").to_numpy()
            bits = fp.view(np.uint64)
            parts = [
                segment_keys(((bits >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64), n)
                for s, n in SEGMENTS
            ]
            for which, (left, right) in enumerate(combinations(range(3), 2)):
                rows, i = np.nonzero(parts[left][1])
                at, j = np.nonzero(parts[right][1][rows])
                row, i = rows[at], i[at]
                key = (which << 24) | (parts[left][0][row, i] << 12) | parts[right][0][row, j]
                lead = (i == 0) + 2 * (j == 0)
                arrays = [pa.array(key.astype(np.int32)), pa.array(fp[row]), pa.array(label[row]), pa.array(lead.astype(np.int8))]
                yield pa.record_batch(arrays, names=["key", "item", "label", "lead"])

    return prints.select("fp", "label").mapInArrow(run, "key int, item long, label long, lead byte")


def _segment(item: Column, segment: int) -> Column:
    shift, bits = SEGMENTS[segment]
    return F.shiftrightunsigned(item, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _equal_segments(prints: DataFrame) -> DataFrame:
    """``(key, item)``: a key for each two segments of a fingerprint."""
    keys = [
        F.xxhash64(F.lit(which), _segment(F.col("fp"), i), _segment(F.col("fp"), j))
        for which, (i, j) in enumerate(combinations(range(3), 2))
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), F.col("fp").alias("item"))


def close_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links at ``max_bits`` or fewer bits that connect whatever such links connect.

    Fingerprints with two equal segments come first: each is hung on the smallest of its buckets, if
    that is near, which joins most of a large group of near copies at one link each. The Golay keys
    then find every near pair with different labels. A pair that shares several keys is made by one
    of them: the first pair of segments that fits and, of a segment that is equal, the first key.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys hold for 0 to {MAX_BITS} bits")

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= max_bits

    scratch = Scratch(prints.sparkSession, "links")
    same = firsts(_equal_segments(prints), near).filter((F.col("item") != F.col("first")) & near(F.col("first"), F.col("item")))
    hung = labels(same.select(F.col("first").alias("a"), F.col("item").alias("b")))
    labelled = prints.join(hung, F.col("fp") == F.col("item"), "left")
    labelled = scratch.keep(labelled.select("fp", F.coalesce("label", "fp").alias("label")))
    keys = scratch.keep(golay_keys(labelled))
    # Read from one table with the same columns on both sides, so that the keys are made and shuffled once. Where a segment is equal so are its
    # keys, and a key is the first of both or of neither.
    left, right = keys.toDF("key", "a", "a_label", "a_lead"), keys.toDF("key", "b", "b_label", "b_lead")
    lead = F.col("a_lead").bitwiseAND(F.col("b_lead"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    bits = [F.bit_count(_segment(differ, s)) for s in range(3)]
    fits = [(bits[i] <= 2) & (bits[j] <= 2) for i, j in combinations(range(3), 2)]
    leads = [
        ((bits[i] > 0) | (lead.bitwiseAND(F.lit(1).cast("byte")) > 0))
        & ((bits[j] > 0) | (lead.bitwiseAND(F.lit(2).cast("byte")) > 0))
        for i, j in combinations(range(3), 2)
    ]
    which = F.shiftright(left["key"], 24)
    first = F.when(fits[0], (which == 0) & leads[0]).when(fits[1], (which == 1) & leads[1]).otherwise((which == 2) & leads[2])
    apart = (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label"))
    across = scratch.keep(left.join(right, apart & near(F.col("a"), F.col("b")) & first).select("a", "b").distinct())
    scratch.drop(keys)
    return labelled.filter("label < fp").select(F.col("label").alias("a"), F.col("fp").alias("b")).union(across)


def simhash_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(id, fp, component)`` per row of ``docs``: the fingerprint and the smallest id of its group.

    Rows of one fingerprint are one vertex, so copies are never paired; links run between
    fingerprints at ``max_bits`` or fewer differing bits, and groups are their connected components.
    Links that would only repeat a connection are not made.
    Texts are read whole and once. Null and empty texts have fingerprint zero and are linked like any
    other. Repeated rows and ids come back as often as they came in. A null id is kept and is never
    a component's name, unless the whole group has null ids (then the component is null). An empty
    table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.keep(fingerprints(docs, id_col, text_col, words))
    prints = scratch.keep(marked.groupBy("fp").agg(F.min("id").alias("least")))
    links = components(close_links(prints, max_bits), "a", "b")
    rooted = prints.join(links, prints["fp"] == links["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    rooted = scratch.keep(rooted)
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = rooted.join(names, "root").select("fp", "component")
    return marked.join(classes, "fp").select("id", "fp", "component")


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one whose id names the group.

    An id is one document: of rows that repeat the kept id one stays, any of them. Rows with a null
    id are kept, since nothing names them. The columns are those of ``docs``.
    """
    groups = simhash_groups(docs, id_col=id_col, text_col=text_col, words=words, max_bits=max_bits)
    kept = groups.filter("id = component").groupBy("id").agg(F.count("*").alias("n"))
    kept = Scratch(docs.sparkSession, "kept").keep(kept)
    own, few = F.col(f"`{id_col}`"), kept.count() <= BROADCAST_IDS

    def named(ids: DataFrame) -> DataFrame:
        key = ids.select(F.col("id").alias(free_name(docs, "kept_id")))
        return docs.join(F.broadcast(key) if few else key, own.cast("long") == F.col(key.columns[0]), "left_semi")

    out = named(kept)
    if not kept.filter("n > 1").isEmpty():
        out = named(kept.filter("n = 1")).unionByName(named(kept.filter("n > 1")).dropDuplicates([id_col]))
    return out.unionByName(docs.filter(own.isNull()))
