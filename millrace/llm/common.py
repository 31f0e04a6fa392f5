"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import remove_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that go to a Python worker at once: whole texts can be long.
BATCH_ROWS = 1000


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send at most so many rows at once to Python; the session's setting returns."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables written to the shared folder, so that lost executors cost no recomputation.

    ``keep`` writes a frame and reads it back; ``drop`` deletes a table nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        with batches_of(self.spark, BATCH_ROWS):
            df.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = (path, kept)
        return kept

    def drop(self, kept: DataFrame) -> None:
        path, _ = self.paths.pop(id(kept))
        remove_path(self.spark, path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides, whatever Spark takes its size for.

    Spark sizes a table by its compressed files, and rows exploded from it as if each stayed one row, so it
    would broadcast, through the driver, tables many times its threshold.
    """
    return df.hint("merge")


def free_name(df: DataFrame, base: str) -> str:
    """A column name the frame does not use yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def arrays(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column of equal lengths as one matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), width if width is not None else -1)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so working memory does not follow batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v array<double>, norm)`` of the vectors that take part.

    Left out: null ids and vectors, empty vectors, vectors holding null or non-finite components,
    zero vectors, and vectors whose length is not the commonest one (ties: the longer).
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (
        df.select(F.col(id_col).cast("long").alias("id"), vec.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        .filter(~bad)
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
        .filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    )
    length = (
        good.groupBy(F.size("v").alias("n"))
        .agg(F.count("*").alias("c"))
        .orderBy(F.desc("c"), F.desc("n"))
        .first()
    )
    return good.filter(F.size("v") == (length["n"] if length else 0))
