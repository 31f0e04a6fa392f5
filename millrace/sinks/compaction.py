"""Landed folders rolled into few large files once they are closed.

Every micro-batch lands files of its own (``sinks.files.land_batch``), so a day's folder ends up with
as many small files as batches times tasks. ``compact`` writes the lines of closed table and day
folders anew as files of about a target size, below ``<path>-compacted/run=<id>``, and then publishes
one manifest row per folder: the run that holds it and the last batch in it. ``read_landed`` honours
the manifest, so a reader sees each line once at every moment: batches the manifest does not cover
come from where they landed, all others from their run. A compaction that stops halfway has published
nothing; one that runs again finds nothing to do; a batch that lands late is taken by the next one.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import path_exists, remove_path

TARGET_BYTES = 128 << 20
LANDED_TYPE = "value string, `table` string, dt string, batch_id bigint"
RUN_TYPE = "value string, run string, `table` string, dt string"
MANIFEST_TYPE = "`table` string, dt string, run string, last_batch bigint, published double"


def _side(path: str, name: str) -> str:
    return f"{path.rstrip('/')}-compacted/{name}"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(table, dt, run, last_batch)``: the newest row of each compacted folder."""
    folder = _side(path, "manifest")
    if not path_exists(spark, folder):
        return spark.createDataFrame([], MANIFEST_TYPE).drop("published")
    rows = spark.read.schema(MANIFEST_TYPE).json(folder)
    newest = F.max_by(F.struct("run", "last_batch"), "published").alias("r")
    return rows.groupBy("table", "dt").agg(newest).select("table", "dt", "r.run", "r.last_batch")


def _covered() -> Column:
    return F.col("batch_id") <= F.coalesce(F.col("last_batch"), F.lit(-1))


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed lines that no run covers, and lines of the runs that count."""
    known = manifest(spark, path)
    same = ["table", "dt"]
    file = F.col("_metadata.file_path").alias("file")
    if landed_files(spark, path).isEmpty():  # every batch is covered and deleted: no folder names a batch
        landed = spark.createDataFrame([], f"{LANDED_TYPE}, file string")
    else:
        landed = spark.read.schema(LANDED_TYPE).text(path).select("*", file)
    fresh = landed.join(known.drop("run"), same, "left").filter(~_covered()).select("value", *same, "file")
    runs = _side(path, "runs")
    if not path_exists(spark, runs):
        return fresh, fresh.limit(0)
    old = spark.read.schema(RUN_TYPE).text(runs).select("*", file).join(known.drop("last_batch"), ["run", *same])
    return fresh, old.select("value", *same, "file")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """``(value, table, dt)``: every landed line once, from wherever it lies now."""
    fresh, old = _parts(spark, path)
    return fresh.unionByName(old).drop("file")


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(table, dt, batch_id, folder, bytes)`` per file, from the listing alone: no file is opened."""
    # The content column is pruned, so a row costs a listing entry.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    at = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    name = F.url_decode(F.replace(at("table"), F.lit("+"), F.lit("%2B")))
    return listed.select(
        name.alias("table"),
        at("dt").alias("dt"),
        at("batch_id").cast("bigint").alias("batch_id"),
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.col("length").alias("bytes"),
    )


def closed_folders(spark: SparkSession, path: str, before: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``(table, dt, files, wanted, last_batch)`` of folders of days before ``before`` worth compacting.

    Those are folders with batches no run covers that have more files than their bytes need. Folders of
    one batch in as few files as needed stay as they are.
    """
    known = manifest(spark, path)
    sized = landed_files(spark, path).filter(F.col("dt") < before).join(known, ["table", "dt"], "left")
    found = sized.groupBy("table", "dt").agg(
        F.count("*").alias("files"),
        F.greatest(F.ceil(F.sum("bytes") / target_bytes), F.lit(1)).cast("int").alias("wanted"),
        F.max("batch_id").alias("last_batch"),
        F.bool_or(~_covered()).alias("open"),
    )
    return found.filter("open and files > wanted").drop("open")


def compact(spark: SparkSession, path: str, before: str, target_bytes: int = TARGET_BYTES) -> int:
    """Roll the closed folders of days before ``before`` into files of about ``target_bytes``; how many folders.

    A folder's lines are dealt evenly over as many writers as its bytes need, so a hot table's day is
    written in parallel and a small one's by one task.
    """
    folders = closed_folders(spark, path, before, target_bytes).persist()
    try:
        count, writers = folders.agg(F.count("*"), F.sum("wanted")).first()
        if not count:
            return 0
        run = uuid.uuid4().hex
        fresh, old = _parts(spark, path)
        chosen = fresh.unionByName(old).join(folders.select("table", "dt", "wanted"), ["table", "dt"])
        # From the line and its file, so a task that runs again deals alike; copies in many files spread.
        slot = F.pmod(F.xxhash64("value", "file"), F.col("wanted"))
        dealt = chosen.withColumn("slot", slot).repartition(int(writers), "table", "dt", "slot")
        dealt.select("value", "table", "dt").write.partitionBy("table", "dt").text(_side(path, f"runs/run={run}"))
        rows = folders.select("table", "dt", F.lit(run).alias("run"), "last_batch", F.lit(time.time()).alias("published"))
        rows.coalesce(1).write.mode("append").json(_side(path, "manifest"))
        return count
    finally:
        folders.unpersist()


def expire_covered(spark: SparkSession, path: str, older_than: float) -> int:
    """Delete landed batches that runs published more than ``older_than`` seconds ago cover; how many folders.

    For after every reader that began before that moment has ended. Repeating it is harmless.
    """
    known = spark.read.schema(MANIFEST_TYPE).json(_side(path, "manifest")) if path_exists(spark, _side(path, "manifest")) else None
    if known is None:
        return 0
    old = known.filter(F.col("published") < time.time() - older_than).groupBy("table", "dt").agg(F.max("last_batch").alias("last_batch"))
    gone = landed_files(spark, path).join(old, ["table", "dt"]).filter(_covered())
    removed = 0
    for row in gone.select("folder").distinct().toLocalIterator():
        remove_path(spark, row["folder"])
        removed += 1
    return removed
