"""Quality rules by divergence: documents whose histograms are far from those of any language.

Two histograms of a text are compared with those of each language by Jensen-Shannon distance (base
two, so from 0 to 1): the classes of its characters, and how often the ``COMMON`` most frequent
words of the language occur, all other words in one bin. The references are counted over all
documents of a language that pass the base rules. A short text has a rough histogram, so it is only
compared where it is long enough.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30

COMMON = 64
SENTENCE = b".,;:!?'\"()-"
TRIMMED = b".,;:!?"
CLASSES = ("lower", "upper", "digit", "space", "newline", "sentence", "other", "beyond")
# Farther than this from every language and the text goes; texts shorter than the guard are not compared.
MAX_CHAR_DISTANCE, MIN_CHARS = 0.26, 300
MAX_WORD_DISTANCE, MIN_COMPARED_WORDS = 0.45, 50
# A language with a smaller share of all counted words has no reference, so there are at most 1,000.
MIN_SHARE = 1 / 1000
# Distinct words that a task counts before it hands them on.
COUNTED_AT_ONCE = 200_000


def _class_of_byte() -> np.ndarray:
    """Class of each byte; bytes that continue a character have none (-1)."""
    out = np.full(256, CLASSES.index("other"))
    out[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    out[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    out[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    out[list(SPACES)] = CLASSES.index("space")
    out[ord("\n")] = CLASSES.index("newline")
    out[list(SENTENCE)] = CLASSES.index("sentence")
    out[0x80:0xC0], out[0xC0:] = -1, CLASSES.index("beyond")
    return out


CLASS_OF_BYTE = _class_of_byte()


@dataclass
class Measured:
    """What the rules need of one text; words are bytes of UTF-8."""

    words: list[bytes]
    classes: np.ndarray
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * n


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a run of ``window`` words found twice or more; ``window`` is a power of two.

    Runs are numbered by doubling: a run of eight is a pair of runs of four, so equal numbers are
    equal words, without hashes.
    """
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    runs = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    span = 1
    while span < window:
        if len(runs) <= span:
            return 0
        pairs = runs[:-span] * (int(runs.max()) + 1) + runs[span:]
        first, runs, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(first) == len(pairs):
            return 0  # no run of this length comes twice, so none that is longer
        span *= 2
    starts = np.flatnonzero(counts[runs] > 1)
    change = np.zeros(len(words) + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    return int(np.count_nonzero(np.cumsum(change)))


def measured(text: str | None) -> Measured:
    """Counts of a whole text; a null text has none."""
    data = (text or "").encode()
    words = data.split()  # bytes are split at the six ASCII spaces only
    of_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    leads = CLASS_OF_BYTE >= 0
    classes = np.bincount(CLASS_OF_BYTE[leads], weights=of_byte[leads], minlength=len(CLASSES)).astype(np.int64)
    spaces = int(of_byte[list(SPACES)].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    return Measured(
        words,
        classes,
        int(classes.sum()) - spaces,
        int(of_byte[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def plain_words(words: list[bytes]) -> Counter[bytes]:
    """Words in lower case (A-Z only) without sentence marks around them."""
    return Counter(w.lower().strip(TRIMMED) for w in words)


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, base two, of two histograms; 1 if only one of them is empty."""
    if not counts.sum() or not reference.sum():
        return float(counts.sum() != reference.sum())
    p, q = counts / counts.sum(), reference / reference.sum()
    middle = (p + q) / 2

    def gain(x: np.ndarray) -> float:
        held = x > 0
        return float((x[held] * np.log2(x[held] / middle[held])).sum())

    return max(0.0, (gain(p) + gain(q)) / 2) ** 0.5


@dataclass
class Reference:
    """A language: character classes, its common words and their counts, all other words last."""

    classes: np.ndarray
    common: dict[bytes, int]
    counts: np.ndarray

    def of_words(self, words: Counter[bytes]) -> np.ndarray:
        out = np.zeros(len(self.counts), np.int64)
        for word in words.keys() & self.common.keys():
            out[self.common[word]] = words[word]
        out[-1] = words.total() - out.sum()
        return out


def references(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> dict[str, Reference]:
    """The reference of each language with at least ``MIN_SHARE`` of all counted words.

    Counted over all documents that pass the base rules, by tasks first; a hot language costs a row per
    task and word. What reaches the driver are ``COMMON`` words and eight classes for at most 1,000
    languages. Documents without a language, and empty words, are not counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter[bytes]] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))

        def out() -> pa.RecordBatch:
            rows = [(lang, w.decode(), None, n) for lang, counted in words.items() for w, n in counted.items()]
            rows += [(lang, None, c, int(n)) for lang, held in classes.items() for c, n in enumerate(held)]
            columns = list(zip(*rows)) if rows else [[]] * 4
            types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "word", "class", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found = measured(text.as_py())
                if not found.base_failed:
                    words[lang].update(plain_words(found.words))
                    classes[lang] += found.classes
                if sum(map(len, words.values())) >= COUNTED_AT_ONCE:
                    yield out()
                    words.clear()
                    classes.clear()
        yield out()

    picked = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = picked.filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "lang string, word string, class int, n long")
    counted = Scratch(docs.sparkSession, "divergence").keep(counted.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")))
    sizes = counted.filter("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("words"))
    total = sizes.agg(F.sum("words")).first()[0] or 0
    large = sizes.filter(F.col("words") >= F.lit(total * MIN_SHARE))
    known = {r.lang: r.words for r in large.collect()}
    often = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    ranked = counted.filter("word IS NOT NULL AND word != ''").withColumn("rank", F.row_number().over(often))
    common, classes = defaultdict(list), defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
    wanted = F.col("lang").isin(*known)
    for r in ranked.filter(F.col("rank") <= COMMON).filter(wanted).orderBy("lang", "rank").collect():
        common[r.lang].append((r.word.encode(), r.n))
    for r in counted.filter("word IS NULL").filter(wanted).collect():
        classes[r.lang][r["class"]] = r.n
    out = {}
    for lang, words in known.items():
        counts = [n for _, n in common[lang]]
        rest = words - sum(counts)
        out[lang] = Reference(classes[lang], {w: i for i, (w, _) in enumerate(common[lang])}, np.array([*counts, rest]))
    return out


def near(found: Measured, words: Counter[bytes], reference: Reference) -> bool:
    """Whether both histograms of a text are close to a language's, as far as it is long enough."""
    short = found.classes.sum() < MIN_CHARS, len(found.words) < MIN_COMPARED_WORDS
    return (short[0] or distance(found.classes, reference.classes) <= MAX_CHAR_DISTANCE) and (
        short[1] or distance(reference.of_words(words), reference.counts) <= MAX_WORD_DISTANCE
    )


def passes(found: Measured, lang: str | None, known: dict[str, Reference]) -> bool:
    """The verdict on a text that passes the base rules: some language is near.

    A text marked with a language that has no reference cannot be judged and passes. Its own language
    is tried first, so most texts are compared with one.
    """
    if not known or (lang is not None and lang not in known):
        return True
    words = plain_words(found.words)
    own = [known[lang]] if lang is not None else []
    return any(near(found, words, r) for r in [*own, *(r for name, r in known.items() if name != lang)])


RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(
    docs: DataFrame,
    known: dict[str, Reference] | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` per row.

    ``known`` are the references to compare with, by default those of ``docs`` itself. Null and empty
    texts have no words, so they fail the base rules. Repeated rows come back as often; other columns
    are ignored, whatever their names. An empty table gives no rows.
    """
    known = references(docs, text_col=text_col, lang_col=lang_col) if known is None else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found = measured(text.as_py())
                failed = found.base_failed
                counts = [found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words]
                rows.append((len(found.words), *counts, failed, not failed and passes(found, lang, known)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64()] * len(RULES) + [pa.bool_()] * 2
            arrays = [batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.record_batch(arrays, names=["id", *RULES, "base_failed", "kept"])

    text = F.col(f"`{text_col}`").cast("string").alias("text")
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), text)
    kind = dict(picked.dtypes)["id"]
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in RULES) + ", base_failed boolean, kept boolean"
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
