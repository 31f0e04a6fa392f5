"""Queries over sources that grow, landed folders that are rolled, and lookups from SQL text; with their SQL."""

from __future__ import annotations

import time
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lookup import save_bucketed
from millrace.operators import envelope as env
from millrace.operators.enrich import enrich
from millrace.operators.geo import parse_ranges
from millrace.operators.sql import register_ip_location, register_ip_number, register_parent_path
from millrace.plans import inputs, oracles
from millrace.plans import registered as base
from millrace.session import cut_lineage, scratch_path
from millrace.sinks import compaction, files, messages, tables
from millrace.sources import snapshots
from millrace.sources.appended import tail_appended
from millrace.sources.changes import snapshot_records
from millrace.sources.messages import read_once
from millrace.streaming import jobs
from millrace.streaming.health import Recorder

# --- lookups from SQL text -------------------------------------------------------------------


def _ips(spark: SparkSession, sf: str) -> None:
    inputs.order_ips(spark, sf).createOrReplaceTempView("millrace_order_ips")


def sql_ip_number(spark: SparkSession, sf: str) -> DataFrame:
    register_ip_number(spark, "ip_number")
    _ips(spark, sf)
    return spark.sql("SELECT o_orderkey, ip, ip_number(ip) AS number FROM millrace_order_ips")


def sql_ip_location(spark: SparkSession, sf: str) -> DataFrame:
    """The scalar function in a query's select list."""
    register_ip_location(spark, parse_ranges(inputs.range_lines(spark, sf)), "ip_location")
    _ips(spark, sf)
    return spark.sql("SELECT o_orderkey, ip, ip_location(ip) AS location FROM millrace_order_ips")


def sql_ip_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The table function in a lateral join: addresses per location, those in no range left out."""
    register_ip_location(spark, parse_ranges(inputs.range_lines(spark, sf)), "ip_location")
    _ips(spark, sf)
    return spark.sql(
        """SELECT l.location, count(*) AS n FROM millrace_order_ips o, LATERAL ip_location_of(o.ip) l
           GROUP BY l.location"""
    )


def sql_parent_path(spark: SparkSession, sf: str) -> DataFrame:
    register_parent_path(spark, inputs.part_edges(spark, sf), "parent_path", "CAT")
    inputs.table(spark, sf, "lineitem").createOrReplaceTempView("millrace_lineitem")
    return spark.sql(
        """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS STRING) AS id, parent_path(CAST(l_partkey AS STRING)) AS path
           FROM millrace_lineitem"""
    )


# --- logs, snapshots and topics --------------------------------------------------------------


def tail_appended_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Logs that grow between three runs of a stream, twice amid a line: each line once."""
    lines = inputs.event_lines(spark, sf, F.col("event_id").alias("line"))
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("logs", "out", "ckpt"))
    for stage in range(inputs.LOG_STAGES):
        inputs.grow_logs(lines, folder, stage)
        stream = tail_appended(spark, f"{folder}/*.log", split_bytes=1 << 20)
        jobs.run(jobs.per_batch(stream, jobs.overwrite_batch(out)), jobs.StreamSettings(checkpoint))
    kept = spark.read.schema("value string").parquet(out)
    return kept.groupBy("value").agg(F.count("*").alias("n"))


def snapshot_handover(spark: SparkSession, sf: str) -> DataFrame:
    """A table read in six ranges while its log runs on: the feed's last writes are the table's state.

    Rows are read at places of the log scattered between a range's two marks, as a reader without a
    lock would see them.
    """
    log, start = inputs.order_log(spark, sf), inputs.order_base(spark, sf)
    old = start.select("id", F.lit(-1).cast("bigint").alias("position"), F.struct("id", "status", "price").cast(inputs.ROW).alias("row"), F.lit(False).alias("gone"))
    every = old.unionByName(log)
    clock = count(0, 700)
    now = []

    def mark() -> int:
        now.append(next(clock))
        return now[-1]

    def read(chunk: snapshots.KeyRange) -> DataFrame:
        seen = F.lit(now[-1]) + F.pmod(F.xxhash64("id"), F.lit(701))
        some = every.filter(chunk.condition(F.col("id"))).filter(F.col("position") <= seen)
        last = some.groupBy("id").agg(F.max_by(F.struct("row", "gone"), "position").alias("last"))
        return last.filter("not last.gone").select("last.row.*")

    ranges = snapshots.key_ranges(start, "id", 6)
    chunks = snapshots.read_chunks(spark, ranges, read, mark)
    return snapshots.state_of(snapshots.handover(chunks, log, "id"), "id")


def topic_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """A writer that fails after writing its second batch, so that it is written twice; the reader drops repeats."""
    lines = inputs.event_lines(spark, sf, "event_id")
    folder = base._in_files(lines, scratch_path(spark, "in"))
    stream = spark.readStream.schema("value string, event_id bigint").option("maxFilesPerTrigger", 2).json(folder)
    topic, out, failed = scratch_path(spark, "topic"), scratch_path(spark, "out"), []

    def write(batch: DataFrame) -> None:
        batch.withColumn("timestamp", F.current_timestamp()).write.mode("append").json(topic)
        if spark.read.schema("id string").json(topic).filter("id like '1-%'").count() and not failed:
            failed.append(True)
            raise RuntimeError("lost after writing")

    jobs.run(messages.identified_batches(stream, write), jobs.StreamSettings(scratch_path(spark, "ckpt"), retries=2))
    sent = spark.readStream.schema("value string, event_id bigint, id string, timestamp timestamp").option("maxFilesPerTrigger", 3)
    once = read_once(sent.json(topic), "1 hour")
    jobs.run(jobs.per_batch(once, jobs.overwrite_batch(out)), jobs.StreamSettings(scratch_path(spark, "ckpt")))
    return spark.read.schema("value string, event_id bigint").parquet(out).drop("batch_id")


def land_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed in several batches, rolled, joined by a late batch and rolled again, old batches deleted."""
    bodies = inputs.event_bodies(spark, sf)
    path = scratch_path(spark, "land")
    rows = base._landing(bodies, F.to_date("ts"))
    of = F.pmod(F.xxhash64("value"), F.lit(4))
    for batch_id in range(3):
        files.land_batch(rows.filter(of == batch_id), path, batch_id)
    compaction.compact(spark, path, before="9999")
    files.land_batch(rows.filter(of == 3), path, 3)
    compaction.compact(spark, path, before="9999")
    if compaction.compact(spark, path, before="9999"):
        raise AssertionError("a compaction that runs again must find nothing to do")
    compaction.expire_covered(spark, path, older_than=-1)
    return base.opened_events(compaction.read_landed(spark, path))


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream of three batches reports of itself, one run of it stopped by a failure."""
    folder = base._in_files(inputs.event_lines(spark, sf, "event_id"), scratch_path(spark, "in"))
    stream = spark.readStream.schema("value string, event_id bigint").option("maxFilesPerTrigger", 2).json(folder)
    write, failed = jobs.overwrite_batch(scratch_path(spark, "out")), []

    def act(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    recorder = Recorder()
    spark.streams.addListener(recorder)
    try:
        settings = jobs.StreamSettings(scratch_path(spark, "ckpt"), batch_timeout=600)
        name = "progress-" + settings.checkpoint.rsplit("-", 1)[1]
        jobs.run(jobs.per_batch(stream, jobs.paced(act, 0.1)).queryName(name), settings)
        # Reports come a moment after their batches.
        for _ in range(200):
            held = [r for r in list(recorder.reports) if r[0] == name and r[2]]
            if len(held) >= 3 and recorder.failures:
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(recorder)
    reports = recorder.table(spark).filter((F.col("query") == name) & (F.col("rows") > 0))
    return reports.agg(F.countDistinct("batch").alias("batches"), F.sum("rows").alias("n"), F.lit(len(recorder.failures)).cast("bigint").alias("failures"))


# --- tables that change their shape, and large dimensions ------------------------------------


def append_evolving(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources appended to a table that knows two columns: new keys come, and whole numbers outgrow theirs."""
    path = scratch_path(spark, "table")
    name = "millrace_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (id INT, name STRING) USING parquet LOCATION '{path}'")
    for source, row in (
        ("customer", ["c_custkey Id", "c_name name"]),
        ("supplier", ["s_suppkey + 10000000000 ID", "s_acctbal Balance", "s_nationkey nation"]),
        ("part", ["p_partkey id", "p_name NAME", "p_size size"]),
    ):
        rows = inputs.table(spark, sf, source).selectExpr(*row)
        changes = snapshot_records(rows, "srv", "shop", f"dbo.{source}")
        flat = env.flat_envelope(env.read_records(changes)).select(objects_without(F.col("envelope"), "database", "type"))
        tables.append_evolving(flat, name)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # the rows stay in the folder
    return spark.read.schema(schema).parquet(path)


def objects_without(envelope: Column, *names: str) -> Column:
    return F.map_filter(envelope, lambda k, _: ~k.isin(*names)).alias("envelope")


def enrich_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The two-key enrichment with a dimension bucketed by its key, which no batch moves."""
    path = scratch_path(spark, "dims")
    name = "millrace_" + path.rsplit("-", 1)[1]
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    save_bucketed(base._customer_dims(spark, sf), name, "database", buckets, path)
    facts = env.parse_envelope(inputs.order_envelopes(spark, sf)).select("envelope")
    out = cut_lineage(enrich(facts, spark.table(name), bucketed=True).select("envelope"), "enriched")
    spark.sql(f"DROP TABLE {name}")
    return base._opened(out, base._ORDER_OUT).withColumnRenamed("Id", "order_id")


ALL = {
    f.__name__: f
    for f in (
        sql_ip_number, sql_ip_location, sql_ip_ranges, sql_parent_path, tail_appended_lines, snapshot_handover,
        topic_exactly_once, land_compacted, stream_progress, append_evolving, enrich_bucketed,
    )
}

SQL = {
    "sql_ip_number": oracles.ALL["ip_number"],
    "sql_ip_location": oracles.ALL["ip_location"],
    "sql_ip_ranges": f"""
        SELECT location, count(*) AS n FROM ({oracles.ALL["ip_location"]}) l
        WHERE location <> 'Other IDC' AND ip IS NOT NULL GROUP BY location""",
    "sql_parent_path": oracles.ALL["parent_path"],
    "tail_appended_lines": f"SELECT value, n FROM ({oracles.ALL['tail_to_messages']}) t",
    "snapshot_handover": """
        WITH log AS (
            SELECT o_orderkey AS id, -1 AS position, o_orderstatus AS status, o_totalprice AS price, FALSE AS gone FROM orders
            UNION ALL SELECT o_orderkey, (1 + (o_orderkey * 7) % 2000) * 4, o_orderstatus, o_totalprice + 1, FALSE
                FROM orders WHERE o_orderkey % 3 = 0
            UNION ALL SELECT o_orderkey, (1 + (o_orderkey * 11) % 2000) * 4 + 1, o_orderstatus, o_totalprice + 2, FALSE
                FROM orders WHERE o_orderkey % 6 = 0
            UNION ALL SELECT o_orderkey, (1 + (o_orderkey * 13) % 2000) * 4 + 2, NULL, NULL, TRUE
                FROM orders WHERE o_orderkey % 10 = 1
            UNION ALL SELECT -o_orderkey, (1 + (o_orderkey * 17) % 2000) * 4 + 3, o_orderstatus, o_totalprice, FALSE
                FROM orders WHERE o_orderkey % 15 = 2)
        SELECT id, status, price FROM log
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY position DESC) = 1 AND NOT gone""",
    "topic_exactly_once": f"SELECT value, event_id FROM ({oracles._NUMBERED_LINES}) t",
    "land_compacted": oracles.ALL["land_by_table"],
    "stream_progress": "SELECT 3::BIGINT AS batches, count(*) AS n, 1::BIGINT AS failures FROM events",
    "append_evolving": """
        SELECT c_custkey::BIGINT AS id, c_name AS name, 'customer' AS "table", NULL::DOUBLE AS balance,
            NULL::BIGINT AS nation, NULL::BIGINT AS size FROM customer
        UNION ALL SELECT s_suppkey + 10000000000, NULL, 'supplier', s_acctbal, s_nationkey, NULL FROM supplier
        UNION ALL SELECT p_partkey, p_name, 'part', NULL, NULL, p_size FROM part""",
    "enrich_bucketed": oracles.ALL["enrich_large"],
}
