"""Session settings and the shared folder every executor can reach."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is written for; a cluster's own values win where it sets them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # State on disk, for dimensions larger than an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Of a repeated JSON key the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **overrides: str) -> SparkSession:
    """Session with the settings above; ``overrides`` is unpacked from a dict of Spark keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="millrace-")  # driver and executors are this process
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store that Spark reaches; a missing one is no error."""
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def newest_text(spark: SparkSession, folder: str) -> str | None:
    """Content of the file of the largest name in a folder of few small files; None if there is none."""
    fs, target = _folder(spark, folder)
    if not fs.exists(target):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(target))
    names = [n for n in names if not n.startswith(".")]
    if not names:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(target, names[-1])
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, folder: str, name: str, text: str, keep: int = 4) -> None:
    """Write a small file that appears as a whole, and delete all but the last ``keep`` of its folder."""
    fs, target = _folder(spark, folder)
    new_path = lambda n: spark._jvm.org.apache.hadoop.fs.Path(target, n)
    hidden = new_path(f".{name}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, new_path(name)):
        raise OSError(f"{name} exists in {folder}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(target))
    for old in [n for n in names if not n.startswith(".")][:-keep]:
        fs.delete(new_path(old), False)


def expire_folders(spark: SparkSession, folder: str, keep: set[str], seconds: float) -> int:
    """Delete sub-folders not named in ``keep`` that were written more than ``seconds`` ago; how many."""
    fs, target = _folder(spark, folder)
    if not fs.exists(target):
        return 0
    oldest = (time.time() - seconds) * 1000
    listed = [s for s in fs.listStatus(target) if s.getPath().getName() not in keep]
    gone = [s.getPath() for s in listed if s.getModificationTime() < oldest]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def expire_scratch(spark: SparkSession, seconds: float) -> int:
    """Delete scratch tables that were written more than ``seconds`` ago; how many there were.

    For a job's end, or a daily clean-up: nothing that still runs may read tables of that age.
    """
    return expire_folders(spark, f"{shared_dir(spark)}/millrace", set(), seconds)


def scratch_path(spark: SparkSession, label: str) -> str:
    """New folder name, unique per call, below the shared folder."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
