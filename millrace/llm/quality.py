"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of terms: its words (a run of over ``PIECE`` characters is cut), the shape of each word (``Word,`` has the shape ``Aa,``), and a
term for each word that repeats the one before. Terms are hashed to ``TERMS`` columns, weighted by
the root of their share and by how rare they are, and projected on the leading singular vectors of
the labelled texts. A document's score is the vote of its nearest labelled vectors, each weighted by
its cosine. Cosines with all labelled vectors are computed exactly, one block of documents at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, small_batches

TERMS = 1024
TOPICS = 48
NEIGHBOURS = 25
# The classifier is fitted on at most so many labelled rows, half of them for each label.
MAX_LABELLED = 3000
# Cosines are raised to this power before they vote, so that near neighbours count most.
SHARPNESS = 8
CACHE_WORDS = 200_000

# Longer runs without a space (scripts that write none, encoded data) count as successive pieces of this length.
PIECE = 64

_RUNS = re.compile(r"(.)\1+", re.S)


def words_of(text: str | None) -> list[str]:
    """Words of a whole text, long ones in pieces."""
    words = (text or "").split()
    if any(len(w) > PIECE for w in words):
        return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def shape(word: str) -> str:
    """Case and punctuation of a word: letters as ``A`` or ``a``, digits as ``0``, runs as one."""
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", "".join(kinds))


class WordTerms(dict):
    """The two columns of a word, remembered for the commonest words."""

    def __missing__(self, word: str) -> tuple[int, int]:
        bare = "".join(c for c in word.lower() if c.isalpha())
        half = TERMS // 2
        pair = (
            zlib.crc32(f"w {bare}".encode("utf-8", "replace")) % half,
            half + zlib.crc32(f"s {shape(word)}".encode("utf-8", "replace")) % (half - 1),
        )
        if len(self) < CACHE_WORDS:
            self[word] = pair
        return pair


def term_vector(text: str | None, columns: WordTerms) -> np.ndarray:
    """Root of each term's share in a whole text; the last column is for repeated words."""
    words = words_of(text)
    out = np.zeros(TERMS, dtype=np.float32)
    if not words:
        return out
    counts = Counter(words)
    pairs = np.array([columns[w] for w in counts], dtype=np.int64)
    n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
    out += np.bincount(pairs.ravel(), weights=np.repeat(n, 2), minlength=TERMS).astype(np.float32)
    out[TERMS - 1] = sum(map(eq, words, words[1:]))
    return np.sqrt(out / len(words))


@dataclass
class Voters:
    """What a task needs to score: at most ``MAX_LABELLED`` short vectors and one small matrix."""

    project: np.ndarray  # terms to topics, with the terms' weights
    vectors: np.ndarray  # labelled vectors of length one
    votes: np.ndarray  # weight of each labelled vector
    good: np.ndarray  # 1 for label 1
    prior: float  # share of label 1

    def latent(self, terms: np.ndarray) -> np.ndarray:
        found = terms @ self.project
        length = np.linalg.norm(found, axis=1, keepdims=True)
        return found / np.where(length > 0, length, 1)

    def score(self, terms: np.ndarray, block: int = 256) -> np.ndarray:
        """Vote for each row, computed block by block; a row without terms gets the prior."""
        out = np.full(len(terms), self.prior)
        if not len(self.vectors):
            return out
        k = min(NEIGHBOURS, len(self.vectors))
        for start in range(0, len(terms), block):
            rows = terms[start : start + block]
            cosines = self.latent(rows) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cosines, near, axis=1), 0, 1) ** SHARPNESS * self.votes[near]
            total = weight.sum(axis=1)
            vote = (weight * self.good[near]).sum(axis=1) / np.where(total > 0, total, 1)
            known = (total > 0) & rows.any(axis=1)
            out[start : start + block] = np.where(known, vote, self.prior)
        return np.clip(out, 0, 1)


def fit_voters(terms: np.ndarray, labels: np.ndarray, shares: dict[int, float]) -> Voters:
    """Latent vectors of the labelled rows. ``shares`` are the labels' shares before sampling."""
    if not len(terms):
        return Voters(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), 0.5)
    rarity = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))) + 1
    weighted = terms.astype(np.float64) * rarity
    _, vectors = np.linalg.eigh(weighted.T @ weighted)  # right singular vectors, weakest first
    project = (rarity[:, None] * vectors[:, ::-1][:, :TOPICS]).astype(np.float32)
    good = (labels == 1).astype(np.float64)
    sampled = {1: good.mean(), 0: 1 - good.mean()}
    votes = np.array([shares.get(int(y), 0.0) / max(sampled[int(y)], 1e-9) for y in labels])
    voters = Voters(project, np.zeros((0, 1), np.float32), votes, good, shares.get(1, 0.0))
    voters.vectors = voters.latent(terms)
    return voters


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> Voters:
    """Voters from the labelled documents outside the held-out fold.

    Held out are ids whose text has a CRC-32 with remainder 1 modulo 3. A label given twice counts
    by majority, and not at all on a tie; null labels and ids are ignored. Per label the
    ``max_labelled / 2`` rows with the smallest hash are used, so at most ``max_labelled`` short
    vectors reach the driver. Without any label every document scores 0.5.
    """
    one = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y"))
    one = one.filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    one = one.groupBy("id").agg(F.avg("y").alias("y")).filter("y != 0.5")
    one = one.select("id", (F.col("y") > 0.5).cast("int").alias("y"))
    shares = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    total = sum(shares.values())
    shares = {y: n / total for y, n in shares.items()}
    chosen = []
    for y in sorted(shares):
        ranked = one.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_labelled // 2)
        chosen += [(r["id"], r["y"]) for r in ranked.collect()]
    picked = docs.sparkSession.createDataFrame(chosen, "id long, y int")
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = named.join(F.broadcast(picked), "id").dropDuplicates(["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = WordTerms()
        for batch in small_batches(batches, 256):
            rows = [term_vector(t, columns).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), batch.column("y"), pa.array(rows, pa.binary())], names=["id", "y", "terms"])

    rows = sorted(found.mapInArrow(run, "id long, y int, terms binary").collect())
    terms = np.array([np.frombuffer(r["terms"], np.float32) for r in rows]).reshape(len(rows), TERMS)
    return fit_voters(terms, np.array([r["y"] for r in rows]), shares)


def held_out(id_col):
    """Whether an id is in the fold that labels are never learned from; false for null."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, voters: Voters, *, text_col: str = "text", score_col: str = "score") -> tuple[DataFrame, str]:
    """``docs`` with a score between 0 and 1 added, and the name of that column.

    All columns of ``docs`` pass through; where the name is taken the score gets another one. Null
    and empty texts get the share of label 1 among the labels. Rows come back as often as they came.
    """
    name = free_name(docs, score_col)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, model = WordTerms(), shared.value
        for batch in small_batches(batches, 256):
            rows = np.array([term_vector(t, columns) for t in batch.column(at).to_pylist()])
            scores = pa.array(model.score(rows.reshape(-1, TERMS)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, schema), name


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, **columns: str) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with the columns of ``docs``."""
    voters = train(docs, labels, **columns)
    text = {"text_col": columns["text_col"]} if "text_col" in columns else {}
    rated, name = scored(docs, voters, **text)
    return rated.filter(F.col(f"`{name}`") >= threshold).select(*[rated[f"`{c}`"] for c in docs.columns])
