"""Text files: whole scans, log tails, range tables and source lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.geo import parse_ranges


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def tail_lines(spark: SparkSession, pattern: str, max_files: int | None = None) -> DataFrame:
    """Stream of log lines from files matching a pattern.

    Progress is kept in the query's checkpoint, per file and not per line: a file is read once, when
    it appears, and lines appended to it later are lost. So this takes logs that are complete when
    they get their name (rotated or moved in); a log that still grows belongs on a topic.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(pattern)


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(start_ip, end_ip, location)`` from a pipe-delimited UTF-8 file."""
    return parse_ranges(read_lines(spark, path))


def parse_source_list(lines: DataFrame, sep: str = " ", value: str = "value") -> DataFrame:
    """``(ip, port, db, tb, user, pwd)`` from positional lines; a bad port fails the job."""
    parts = F.split(F.col(value), "[" + sep + "]")
    at = lambda i: F.element_at(parts, i + 1)  # noqa: E731 - a missing field is an error
    return lines.select(
        at(0).alias("ip"),
        at(1).cast("int").alias("port"),
        at(2).alias("db"),
        at(3).alias("tb"),
        at(4).alias("user"),
        at(5).alias("pwd"),
    )


def read_source_list(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """Source descriptors of a space- or comma-separated file."""
    return parse_source_list(read_lines(spark, path), sep)
