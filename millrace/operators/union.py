"""Bag union of any number of like-typed inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def union_all(
    inputs: Sequence[DataFrame], spark: SparkSession | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """Every row of every input, duplicates kept; no input gives an empty frame of ``schema``.

    A column that an input lacks is null in its rows.
    """
    if not inputs:
        if spark is None or schema is None:
            raise ValueError("an empty union needs a session and a schema")
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)
