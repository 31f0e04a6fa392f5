"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import split_lines
from millrace.operators.projections import tokens


def text_lines(df: DataFrame, text: str, out: str = "line") -> DataFrame:
    """One row per line of every text."""
    return df.select(F.explode(split_lines(F.col(text))).alias(out))


def word_count(lines: DataFrame, line: str, delimiter: str = " ") -> DataFrame:
    """``(word, n)`` over all lines; counts are combined before the shuffle."""
    return tokens(lines, line, delimiter).groupBy("word").agg(F.count("*").alias("n"))
