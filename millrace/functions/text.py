"""Text splitting and blank tests as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_LINE_END = r"\r\n|\r|\n"


def split_tokens(text: Column, delimiter: str) -> Column:
    """Split on one character, without trailing empty strings.

    ``""`` gives ``[""]``; text made only of delimiters gives ``[]``; inner and leading empty
    strings stay.
    """
    if len(delimiter) != 1:
        raise ValueError("delimiter must be one character")
    body = F.rtrim(text, F.lit(delimiter))
    only_delimiters = (body == "") & (text != "")
    return F.when(only_delimiters, F.array().cast("array<string>")).otherwise(
        F.split(body, re.escape(delimiter))
    )


def split_lines(text: Column) -> Column:
    """Lines as a text-file scan would return them: a final line end closes the last line."""
    body = F.regexp_replace(text, rf"({_LINE_END})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, _LINE_END))


def is_not_blank(text: Column) -> Column:
    """False for null, empty and all-whitespace text; wide Unicode spaces count as whitespace."""
    return F.coalesce(text.rlike(r"\P{javaWhitespace}"), F.lit(False))
