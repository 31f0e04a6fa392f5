"""Every operator as a query over the test tables. ``oracles`` holds the matching SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import clock, objects
from millrace.functions.net import ip_to_long
from millrace.functions.text import split_tokens
from millrace.operators import envelope as env
from millrace.operators import kpi
from millrace.operators import projections as prj
from millrace.operators.enrich import DIM_TYPE, attach, enrich, latest_dims
from millrace.operators.geo import parse_ranges, with_ip_location
from millrace.operators.hierarchy import parent_paths, with_parent_path
from millrace.operators.union import union_all
from millrace.operators.words import text_lines, word_count
from millrace.plans import flows, inputs, reports
from millrace.session import cut_lineage, scratch_path
from millrace.sinks import database, files, local, messages, tables
from millrace.sources.changes import ChangeSource, read_changes, snapshot_records
from millrace.sources.files import parse_source_list, read_lines, read_source_list, tail_lines
from millrace.sources.messages import position, read_message_files
from millrace.sources.tables import read_facts, read_hierarchy
from millrace.streaming import jobs
from millrace.streaming.dims import maintained_dims, read_dims, snapshot_dims

DAY = 19980316
GMV_DAY = 19960917
NOW_MILLIS = 1704164645000  # 2024-01-02 03:04:05 UTC


def _now() -> Column:
    return F.timestamp_millis(F.lit(NOW_MILLIS))


# --- daily figures ---------------------------------------------------------------------------


def amount_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.amount(inputs.sales_facts(spark, sf), DAY).select(
        F.col("total_amount").cast(inputs.MONEY).alias("total_amount")
    )


def new_count_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.new_count(inputs.sales_facts(spark, sf), DAY)


def gmv_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.gmv(inputs.orders_gmv(spark, sf), GMV_DAY).select(
        F.col("order_amount").cast(inputs.MONEY).alias("order_amount")
    )


def _money(df: DataFrame) -> DataFrame:
    casts = {"total_amount": inputs.MONEY, "order_amount": inputs.MONEY}
    return df.select(*[F.col(c).cast(casts.get(c, df.schema[c].dataType)).alias(c) for c in df.columns])


def tm_amount_topk(spark: SparkSession, sf: str, day: int = DAY) -> DataFrame:
    return _money(kpi.top_brands(inputs.product_stats(spark, sf), day))


def spu_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _money(kpi.top_products(inputs.product_stats(spark, sf), DAY))


def category3_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _money(kpi.top_categories(inputs.product_stats(spark, sf), DAY))


def trademark_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _money(kpi.top_trademarks(inputs.product_stats(spark, sf), DAY))


def report_amount(spark: SparkSession, sf: str) -> DataFrame:
    return reports.scalar_report(amount_by_day(spark, sf))


def report_new(spark: SparkSession, sf: str) -> DataFrame:
    return reports.scalar_report(new_count_by_day(spark, sf))


def report_gmv(spark: SparkSession, sf: str) -> DataFrame:
    return reports.scalar_report(gmv_by_day(spark, sf))


def report_brands(spark: SparkSession, sf: str) -> DataFrame:
    return reports.table_report(
        tm_amount_topk(spark, sf), reports.BRAND_COLUMNS, "total_amount", ["tm"]
    )


def report_products(spark: SparkSession, sf: str) -> DataFrame:
    return reports.table_report(
        spu_topk(spark, sf), reports.PRODUCT_COLUMNS, "order_amount", ["spu_id", "spu_name"]
    )


def report_categories(spark: SparkSession, sf: str) -> DataFrame:
    return reports.name_value_report(
        category3_topk(spark, sf), "category3_name", "order_amount", ["category3_id", "category3_name"]
    )


def report_trademarks(spark: SparkSession, sf: str) -> DataFrame:
    return reports.series_report(
        trademark_topk(spark, sf), "tm_name", "order_amount", ["tm_id", "tm_name"]
    )


def figures_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """Amount and count of a day from a catalog table."""
    inputs.sales_facts(spark, sf).createOrReplaceTempView("millrace_facts")
    facts = read_facts(spark, "millrace_facts")
    amount = kpi.amount(facts, DAY).select(
        F.lit("amount").alias("figure"), F.col("total_amount").cast(inputs.MONEY).alias("value")
    )
    count = kpi.new_count(facts, DAY).select(
        F.lit("new").alias("figure"), F.col("new_count").cast(inputs.MONEY).alias("value")
    )
    return amount.unionByName(count)


# --- change envelopes ------------------------------------------------------------------------

_EVENT_ROW = "event_id bigint, user_id bigint, value double, props string, note string"


def _flat_events(changes: DataFrame) -> DataFrame:
    """Envelope text of event changes, read back into columns."""
    rows = env.envelope_text(env.flat_envelope(env.read_records(changes)))
    known = f"database string, `table` string, type string, {_EVENT_ROW}"
    return rows.select(
        F.from_json("body", known).alias("b"), F.size(F.json_object_keys("body")).alias("n_keys")
    ).select("b.*", "n_keys")


def cdc_flat(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_events(inputs.event_changes(spark, sf))


def cdc_nested(spark: SparkSession, sf: str) -> DataFrame:
    rows = env.envelope_text(env.nested_envelope(env.read_records(inputs.event_changes(spark, sf))))
    known = f"database string, `table` string, type string, data struct<{_struct(_EVENT_ROW)}>"
    return rows.select(F.from_json("body", known).alias("b")).select(
        "b.database", "b.table", "b.type", "b.data.*"
    )


def _struct(columns: str) -> str:
    return ", ".join(c.strip().replace(" ", ":", 1) for c in columns.split(","))


def cdc_collision(spark: SparkSession, sf: str) -> DataFrame:
    rows = env.envelope_text(env.flat_envelope(env.read_records(inputs.clashing_changes(spark, sf))))
    known = "database string, `table` string, type string, event_id bigint"
    return rows.select(
        F.from_json("body", known).alias("b"), F.size(F.json_object_keys("body")).alias("n_keys")
    ).select("b.*", "n_keys")


def cdc_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Event changes, half of them broken in three ways; what is kept and what is set aside."""
    event = F.col("key").cast("bigint")
    broken = inputs.event_changes(spark, sf).select(
        F.when(event % 8 == 1, F.lit("short.topic")).otherwise(F.col("topic")).alias("topic"),
        "key",
        F.when(event % 8 == 3, F.lit("not json"))
        .when(event % 8 == 5, F.lit('{"op":"c","after":{"event_id":1}}'))
        .when(event % 8 == 7, F.lit('{"after":null,"source":{"db":"shop"}}'))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    records = env.read_records(broken)
    kept = env.usable(records).select("key", F.lit("kept").alias("state"))
    return kept.unionByName(env.quarantine(records).select("key", F.lit("aside").alias("state")))


def snapshot_and_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A table snapshot in front of its own changes."""
    rows = inputs.rows(spark, sf, "events").select(
        "event_id", "user_id", "value", "props", F.lit(None).cast("string").alias("note")
    )
    snapshot = snapshot_records(rows, "srv", "shop", "dbo.events")
    return _flat_events(union_all([snapshot, inputs.event_changes(spark, sf)]))


def _streamed(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream to its end into parquet and read the result."""
    writer = stream.writeStream.format("parquet").option("path", path)
    jobs.run(writer, jobs.StreamSettings(checkpoint))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def _landed_messages(rows: DataFrame, label: str) -> str:
    """Write message rows as JSON files, the stand-in for a broker's topics."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.json(path)
    return path


def changes_of_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    folder = _landed_messages(inputs.event_changes(spark, sf), "topics")
    source = ChangeSource("srv", folder=folder)
    stream = read_changes(spark, source, ["dbo.click", "dbo.view"])
    flat = _flat_events(stream)
    return _streamed(flat, scratch_path(spark, "out"), scratch_path(spark, "ckpt"))


def changes_of_server(spark: SparkSession, sf: str) -> DataFrame:
    folder = _landed_messages(inputs.event_changes(spark, sf), "topics")
    stream = read_changes(spark, ChangeSource("srv", folder=folder))
    flat = _flat_events(stream)
    return _streamed(flat, scratch_path(spark, "out"), scratch_path(spark, "ckpt"))


def _type_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A source list with one entry per event type, read back from its file."""
    kinds = inputs.table(spark, sf, "events").select("event_type").distinct()
    path = scratch_path(spark, "list")
    kinds.select(F.format_string("h1 1433 shop dbo.%s u p", "event_type").alias("value")).write.text(path)
    return read_source_list(spark, path)


def streams_per_source(spark: SparkSession, sf: str) -> DataFrame:
    """An independent stream for every entry of a source list, each into its own folder."""
    folder = _landed_messages(inputs.event_changes(spark, sf), "topics")
    source, out = ChangeSource("srv", folder=folder), scratch_path(spark, "out")
    streams = jobs.source_streams(
        _type_sources(spark, sf), lambda entry: _flat_events(read_changes(spark, source, [entry.tb]))
    )
    jobs.run_each(
        streams,
        lambda entry, s: s.writeStream.format("parquet").option("path", f"{out}/{entry.tb}"),
        lambda entry: jobs.StreamSettings(scratch_path(spark, "ckpt")),
    )
    return union_all([spark.read.schema(s.schema).parquet(f"{out}/{e.tb}") for e, s in streams])


def union_of_source_list(spark: SparkSession, sf: str) -> DataFrame:
    """All entries of a source list in one stream: one subscription to their topics."""
    folder = _landed_messages(inputs.event_changes(spark, sf), "topics")
    tables = [entry.tb for entry in jobs.source_entries(_type_sources(spark, sf))]
    changes = read_changes(spark, ChangeSource("srv", folder=folder), tables, max_files=2)
    flat = _flat_events(changes)
    return _streamed(flat, scratch_path(spark, "out"), scratch_path(spark, "ckpt"))


# --- enrichment ------------------------------------------------------------------------------

_ORDER_OUT = "database string, tenantid string, Id bigint, `table` string, type string"


def _opened(df: DataFrame, columns: str) -> DataFrame:
    text = env.envelope_text(df)
    return text.select(F.from_json("body", columns).alias("b")).select("b.*")


def dimension_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_dims(env.parse_envelope(inputs.customer_feed(spark, sf)))


def _customer_dims(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension as a written snapshot, since a lookup measures it before joining it."""
    return cut_lineage(dimension_latest(spark, sf), "dims")


def dimension_deletes(spark: SparkSession, sf: str) -> DataFrame:
    feed = inputs.guid_feed(spark, sf, "customer", "shop_", "c_custkey", "c_name")
    dims = latest_dims(env.parse_envelope(feed), honor_deletes=True)
    return dims.select("database", "guid")


def enrich_two_key(spark: SparkSession, sf: str) -> DataFrame:
    facts = env.parse_envelope(inputs.order_envelopes(spark, sf)).select("envelope")
    out = enrich(facts, _customer_dims(spark, sf))
    return _opened(out, _ORDER_OUT).withColumnRenamed("Id", "order_id")


def enrich_one_key(spark: SparkSession, sf: str) -> DataFrame:
    facts = env.parse_envelope(inputs.customer_envelopes(spark, sf)).select("envelope")
    feed = inputs.guid_feed(spark, sf, "nation", "db_", "n_nationkey", "n_name")
    out = enrich(facts, latest_dims(env.parse_envelope(feed)), tenant=False)
    return _opened(out, "database string, Id bigint, `table` string").withColumnRenamed("Id", "cust_id")


def enrich_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup on typed columns, without a JSON body; over orders."""
    orders = inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("shop_"), F.col("o_custkey").cast("string")).alias("database"),
    )
    out = attach(orders, _customer_dims(spark, sf), "database")
    return out.select(
        "o_orderkey", F.coalesce("dim_guid", "database").alias("database"), "dim_tenantid"
    )


def _in_files(rows: DataFrame, path: str, n: int = 6, fmt: str = "json") -> str:
    """Write rows as at least a few files, so that streams over them take several batches."""
    rows.repartition(n).write.format(fmt).save(path)
    return path


def _streamed_dims(spark: SparkSession, sf: str) -> str:
    """Run the customer feed as a stream, published after each of several batches."""
    feed = _in_files(inputs.customer_feed(spark, sf), scratch_path(spark, "feed"))
    rows = spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", 2).json(feed)
    path = scratch_path(spark, "dims")
    writer = maintained_dims(env.parse_envelope(rows), path, merge_after=2)
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    return path


def dimension_stream(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_dims(spark, _streamed_dims(spark, sf))


def enrich_stream(spark: SparkSession, sf: str) -> DataFrame:
    """One stream keeps the dimension, another reads it anew in every micro-batch."""
    dims = _streamed_dims(spark, sf)
    folder = _in_files(inputs.order_envelopes(spark, sf), scratch_path(spark, "facts"))
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2)
    facts = env.parse_envelope(reader.json(folder))
    out = scratch_path(spark, "out")
    write = jobs.overwrite_batch(out)
    writer = jobs.enriched_batches(
        facts.select("envelope"),
        lambda: read_dims(spark, dims),
        lambda batch, batch_id: write(_opened(batch, _ORDER_OUT), batch_id),
    )
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    landed = spark.read.schema(_ORDER_OUT).parquet(out).drop("batch_id")
    return landed.withColumnRenamed("Id", "order_id")


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Three inputs of one shape, one of them twice."""

    def source(name: str, prefix: str) -> DataFrame:
        return inputs.table(spark, sf, name).select(
            F.lit(name).alias("source"),
            F.col(f"{prefix}key").cast("bigint").alias("id"),
        )

    supplier = source("supplier", "s_supp")
    return union_all([source("customer", "c_cust"), supplier, source("orders", "o_order"), supplier])


# --- addresses and hierarchies ---------------------------------------------------------------


def ip_number(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.order_ips(spark, sf).withColumn("number", ip_to_long(F.col("ip")))


def ip_location(spark: SparkSession, sf: str) -> DataFrame:
    ranges = parse_ranges(inputs.range_lines(spark, sf))
    return with_ip_location(inputs.order_ips(spark, sf), "ip", ranges)


def ip_location_large(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup the way it runs when the range table is too large to broadcast."""
    ranges = parse_ranges(inputs.range_lines(spark, sf))
    return with_ip_location(inputs.order_ips(spark, sf), "ip", ranges, small=False)


def parent_path(spark: SparkSession, sf: str) -> DataFrame:
    items = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("id")
    )
    return with_parent_path(items, "id", inputs.part_edges(spark, sf), "CAT")


def parent_paths_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of every id of a catalog table whose first hop carries the group."""
    edges = inputs.part_edges(spark, sf).withColumnRenamed("cfg_group", "CfgGroup")
    edges.createOrReplaceTempView("millrace_tree")
    return parent_paths(read_hierarchy(spark, "millrace_tree"), "CAT")


# --- record transforms -----------------------------------------------------------------------


def _order_flat(spark: SparkSession, sf: str) -> DataFrame:
    return env.flat_envelope(env.read_records(inputs.order_changes(spark, sf)))


def id_projection(spark: SparkSession, sf: str) -> DataFrame:
    return prj.id_only(_order_flat(spark, sf)).select("key", "body")


def id_suffix(spark: SparkSession, sf: str) -> DataFrame:
    ids = env.parse_envelope(id_projection(spark, sf), "body")
    return env.envelope_text(prj.suffix_id(ids), out="body").select("key", "body")


def flatten_projection(spark: SparkSession, sf: str) -> DataFrame:
    return prj.flatten(env.nested_envelope(env.read_records(inputs.order_changes(spark, sf))))


def _fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    records = env.read_records(inputs.sales_changes(spark, sf), image=prj.FACT_IMAGE)
    return prj.typed_rows(env.nested_envelope(records), now=_now())


def _dated(facts: DataFrame) -> DataFrame:
    return facts.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(_fact_rows(spark, sf))


def typed_rows_of_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same from envelope text, as another job would find it on a topic."""
    records = env.read_records(inputs.sales_changes(spark, sf))
    text = env.envelope_text(env.nested_envelope(records))
    return _dated(prj.typed_rows(text, "body", now=_now()))


def positional_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as the positional writer would send them."""
    target = ["c_id", "c_amount", "c_new", "c_count", "c_tm"]
    return database.positional_rows(_fact_rows(spark, sf), target, excluded=["date"])


def rewrite_event(spark: SparkSession, sf: str) -> DataFrame:
    out = prj.rewrite_event(inputs.event_bodies(spark, sf), now=_now())
    known = "event_id bigint, value double, `table` string, ModifyTime string"
    return out.select(
        F.col("headers")["timestamp"].alias("head_time"),
        F.col("headers")["table"].alias("head_table"),
        F.from_json("body", known).alias("b"),
    ).select(
        "head_time",
        "head_table",
        "b.event_id",
        "b.value",
        F.col("b.table").alias("body_table"),
        F.col("b.ModifyTime").alias("body_time"),
    )


def drop_transient(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.table(spark, sf, "supplier")
    return prj.drop_transient(rows.to(prj.mark_transient(rows.schema, ["s_acctbal"])))


def column_value_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted key and value lists of the id envelopes."""
    obj = F.col("envelope")
    ids = env.parse_envelope(id_projection(spark, sf), "body")
    return ids.select(
        "key",
        objects.quoted_column_list(obj).alias("columns"),
        objects.quoted_value_list(obj).alias("vals"),
    )


def source_list(spark: SparkSession, sf: str) -> DataFrame:
    """Source descriptors from a space- and a comma-separated list."""
    spaced = parse_source_list(inputs.source_lines(spark, sf, " "))
    return spaced.unionByName(parse_source_list(inputs.source_lines(spark, sf, ","), ","))


# --- words -----------------------------------------------------------------------------------


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return word_count(text_lines(inputs.rows(spark, sf, "documents"), "text"), "line")


def word_counts_of_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "texts")
    inputs.rows(spark, sf, "documents").select("text").write.text(path)
    return word_count(read_lines(spark, path), "value")


def word_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """``(word, 1)`` rows saved as text lines in parallel and read back, counted per line."""
    words = prj.tokens(inputs.event_lines(spark, sf), "value", ":")
    path = scratch_path(spark, "pairs")
    files.save_pairs_text(prj.paired(words), path, files=None)
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def token_lists(spark: SparkSession, sf: str) -> DataFrame:
    parts = split_tokens(F.col("value"), ":")
    return inputs.event_lines(spark, sf).select(
        "value", F.size(parts).alias("n"), F.concat_ws("|", parts).alias("parts")
    )


def colon_count_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every micro-batch on its own: the lines arrive in five parts, each read by one batch."""
    folder, out = scratch_path(spark, "lines"), scratch_path(spark, "out")
    settings = jobs.StreamSettings(scratch_path(spark, "ckpt"))
    lines = inputs.event_lines(spark, sf, "event_id")
    for part in range(5):
        lines.filter(F.col("event_id") % 5 == part).select("value").write.mode("append").text(folder)
        jobs.run(jobs.batch_word_counts(tail_lines(spark, folder), out), settings)
    counts = spark.read.schema("word string, n bigint, batch_id int").parquet(out)
    return counts.select(F.col("batch_id").cast("int").alias("batch"), "word", "n")


def running_count_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Counts over the whole stream, the full result rewritten after every batch."""
    folder = scratch_path(spark, "lines")
    inputs.event_lines(spark, sf).write.text(folder)
    out = scratch_path(spark, "out")
    counts = jobs.running_word_counts(tail_lines(spark, folder, max_files=4))
    writer = counts.writeStream.outputMode("complete").foreachBatch(
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(out)
    )
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    return spark.read.schema("word string, n bigint").parquet(out)


def tail_to_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines streamed raw to a topic; JSON files stand in for the broker."""
    folder = scratch_path(spark, "logs")
    inputs.event_lines(spark, sf).write.text(folder)
    rows = messages.message_rows(tail_lines(spark, folder), "value", topic=F.lit("log"))
    out = scratch_path(spark, "topic")
    writer = messages.stream_messages(rows, {"path": out}, scratch_path(spark, "ckpt"), fmt="json")
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    sent = read_message_files(spark, out, streaming=False)
    return sent.groupBy("topic", "value").agg(F.count("*").alias("n"))


# --- landing and appends ---------------------------------------------------------------------


def _landing(df: DataFrame, day) -> DataFrame:
    out = prj.rewrite_event(df, now=_now())
    return files.landing_rows(out, table=F.col("headers")["table"], day=day)


def _landed_events(spark: SparkSession, path: str) -> DataFrame:
    """Every landed event with its table and day, and all of its body."""
    return opened_events(spark.read.schema("value string, `table` string, dt string").text(path))


def opened_events(rows: DataFrame) -> DataFrame:
    """Columns of landed event lines."""
    known = "event_id bigint, value double, ModifyTime string, `table` string"
    return rows.select(
        "table",
        "dt",
        F.from_json("value", known).alias("e"),
        F.size(F.json_object_keys("value")).alias("n_keys"),
    ).select(
        "table", "dt", "e.event_id", "e.value", F.col("e.ModifyTime").alias("changed"),
        F.col("e.table").alias("body_table"), "n_keys",
    )


def land_by_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "land")
    files.land_by_table(_landing(inputs.event_bodies(spark, sf), F.to_date("ts")), path)
    return _landed_events(spark, path)


def land_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = _in_files(inputs.event_bodies(spark, sf), scratch_path(spark, "bodies"), fmt="parquet")
    reader = spark.readStream.schema("body string, ts timestamp_ntz").option("maxFilesPerTrigger", 2)
    stream = reader.parquet(folder)
    path, checkpoint = scratch_path(spark, "land"), scratch_path(spark, "ckpt")
    writer = files.land_stream(_landing(stream, F.to_date("ts")), path, checkpoint)
    jobs.run(writer, jobs.StreamSettings(checkpoint))
    return _landed_events(spark, path)


def _shop_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Created orders, a database per customer and a topic per order status."""
    row = F.struct(F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("Name"))
    shop = inputs.text_of("shop_", F.col("o_custkey").cast("string"))
    none = F.lit(None).cast("string")
    return inputs.rows(spark, sf, "orders").select(
        inputs.text_of("srv.dbo.", F.col("o_orderstatus")).alias("topic"),
        F.col("o_orderkey").cast("string").alias("key"),
        inputs.change_value(none, row, shop, F.lit("c")).alias("value"),
    )


def _landed_orders(spark: SparkSession, path: str) -> DataFrame:
    landed = spark.read.schema("value string, `table` string").text(path)
    known = "database string, tenantid string, Id bigint, Name string, type string"
    return landed.select("table", F.from_json("value", known).alias("b")).select(
        "table", "b.database", "b.tenantid", F.col("b.Id").alias("order_id"), "b.Name", "b.type"
    )


def capture_enrich_land(spark: SparkSession, sf: str) -> DataFrame:
    """The main path in one job: change records, flat envelopes, tenants, files by table."""
    flat = env.flat_envelope(env.read_records(_shop_changes(spark, sf))).select("envelope")
    text = env.envelope_text(enrich(flat, _customer_dims(spark, sf)))
    name = objects.get_string(F.col("envelope"), "table")
    path = scratch_path(spark, "ods")
    files.land_by_table(files.landing_rows(text, table=name, by_day=False), path)
    return _landed_orders(spark, path)


def capture_stream_to_files(spark: SparkSession, sf: str) -> DataFrame:
    """The main path as streams: the dimension feed, and the changes landed by table and day."""
    dims = _streamed_dims(spark, sf)
    folder = _in_files(_shop_changes(spark, sf), scratch_path(spark, "topics"))
    changes = read_changes(spark, ChangeSource("srv", folder=folder), max_files=2)
    path = scratch_path(spark, "ods")
    day = F.lit("2024-01-02").cast("date")
    writer = flows.capture_to_files(changes, lambda: read_dims(spark, dims), path, day)
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    return _landed_orders(spark, path)


def capture_stream_to_report(spark: SparkSession, sf: str) -> DataFrame:
    """The second path: changes to typed facts, then the brand ranking of their day as JSON."""
    folder = _in_files(inputs.sales_changes(spark, sf), scratch_path(spark, "topics"))
    changes = read_changes(spark, ChangeSource("srv", folder=folder), ["dbo.sales"], max_files=2)
    path = scratch_path(spark, "facts")
    jobs.run(
        flows.capture_to_facts(changes, path, now=_now()),
        jobs.StreamSettings(scratch_path(spark, "ckpt")),
    )
    facts = spark.read.schema(f"{prj.FACT_TYPE}, dt date").parquet(path)
    ranking = kpi.top_brands(facts, 20240102, ts="dt")
    return reports.table_report(ranking, reports.BRAND_COLUMNS, "total_amount", ["tm"])


def append_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources with different keys appended to one typed table."""
    path = scratch_path(spark, "table")
    name = "millrace_" + path.rsplit("-", 1)[1]
    columns = "`database` STRING, `table` STRING, `type` STRING, id BIGINT, name STRING, balance DOUBLE, nation INT"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    for source, row in (
        ("customer", ["c_custkey Id", "c_name name", "c_nationkey nation"]),
        ("supplier", ["s_suppkey ID", "s_acctbal balance"]),
    ):
        rows = inputs.table(spark, sf, source).selectExpr(*row)
        changes = snapshot_records(rows, "srv", "shop", f"dbo.{source}")
        tables.append_dynamic(env.flat_envelope(env.read_records(changes)), name)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # the rows stay in the folder
    return spark.read.schema(schema).parquet(path)


def append_dynamic_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Object rows streamed into a typed folder, two sources with different keys."""
    folder = scratch_path(spark, "topics")
    for source, row in (
        ("customer", ["c_custkey Id", "c_name name"]),
        ("supplier", ["s_suppkey ID", "s_acctbal balance"]),
    ):
        rows = inputs.table(spark, sf, source).selectExpr(*row)
        snapshot_records(rows, "srv", "shop", f"dbo.{source}").write.mode("append").json(folder)
    columns = "`database` STRING, `table` STRING, `type` STRING, id BIGINT, name STRING, balance DOUBLE"
    target = spark.createDataFrame([], columns).schema
    changes = read_changes(spark, ChangeSource("srv", folder=folder))
    flat = env.flat_envelope(env.read_records(changes))
    path = scratch_path(spark, "table")
    jobs.run(
        tables.dynamic_stream(flat, target, path), jobs.StreamSettings(scratch_path(spark, "ckpt"))
    )
    return spark.read.schema(target).parquet(path)


def fan_out_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """One stream to two sinks per batch: whole rows, and text by table."""
    folder = _landed_messages(inputs.event_changes(spark, sf), "topics")
    changes = read_changes(spark, ChangeSource("srv", folder=folder))
    text = env.envelope_text(env.flat_envelope(env.read_records(changes)))
    rows, land = scratch_path(spark, "rows"), scratch_path(spark, "land")

    write_rows = jobs.overwrite_batch(rows)

    def keep(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch.select("key", "body"), batch_id)

    def by_table(batch: DataFrame, batch_id: int) -> None:
        name = objects.get_string(F.col("envelope"), "table")
        files.land_batch(files.landing_rows(batch, table=name, by_day=False), land, batch_id)

    jobs.run(
        jobs.fan_out_batches(text, [keep, by_table]), jobs.StreamSettings(scratch_path(spark, "ckpt"))
    )
    kept = spark.read.schema("key string, body string").parquet(rows)
    landed = spark.read.schema("value string, `table` string").text(land)
    known = f"database string, `table` string, type string, {_EVENT_ROW}"
    one = kept.select(F.from_json("body", known).alias("b")).select("b.*")
    two = landed.select("table", F.from_json("value", known).alias("b")).select(
        "b.database", "table", "b.type", *[f"b.{c.split()[0]}" for c in _EVENT_ROW.split(", ")]
    )
    return one.withColumn("sink", F.lit("rows")).unionByName(two.withColumn("sink", F.lit("text")))


def topic_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """Messages written to a topic named by the table of each envelope; files stand in for a broker."""
    flat = env.flat_envelope(env.read_records(inputs.event_changes(spark, sf)))
    name = objects.get_string(F.col("envelope"), "table")
    key = objects.get_string(F.col("envelope"), "event_id")
    rows = messages.message_rows(env.envelope_text(flat.drop("key")), topic=name, key=key)
    out = scratch_path(spark, "topic")
    messages.write_messages(rows, {"path": out}, fmt="json")
    sent = read_message_files(spark, out, streaming=False)
    known = f"database string, `table` string, type string, {_EVENT_ROW}"
    return sent.select("topic", "key", F.from_json("value", known).alias("b")).select("topic", "key", "b.*")


# --- records that go wrong, and large joins ---------------------------------------------------


def cdc_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose image gives a key twice: the record stays and the last value counts."""
    twice = inputs.text_of('{"Id":', F.col("o_orderkey").cast("string"), ',"n":1,"n":', F.col("o_custkey").cast("string"), "}")
    value = inputs.text_of('{"before":null,"after":', twice, ',"source":{"db":"shop"},"op":"c"}')
    changes = inputs.rows(spark, sf, "orders").select(F.lit("srv.dbo.T").alias("topic"), value.alias("value"))
    rows = env.envelope_text(env.flat_envelope(env.read_records(changes)))
    known = "`table` string, Id bigint, n bigint"
    return rows.select(F.from_json("body", known).alias("b")).select("b.table", F.col("b.Id").alias("order_id"), "b.n")


def _broken(changes: DataFrame) -> DataFrame:
    """Change records of which every fifth has no operation and every seventh is no JSON."""
    number = F.col("key").cast("bigint")
    value = F.when(number % 7 == 0, F.lit("no json")).when(number % 5 == 0, F.lit('{"source":{"db":"shop"}}'))
    return changes.withColumn("value", F.coalesce(value, F.col("value")))


def capture_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The first path over partly unusable records: what landed, and what was set aside with it."""
    folder = _in_files(_broken(_shop_changes(spark, sf)), scratch_path(spark, "topics"))
    changes = read_changes(spark, ChangeSource("srv", folder=folder), max_files=2)
    path, aside = scratch_path(spark, "ods"), scratch_path(spark, "aside")
    empty = spark.createDataFrame([], DIM_TYPE)
    writer = flows.capture_to_files(changes, lambda: empty, path, F.lit("2024-01-02").cast("date"), aside=aside)
    jobs.run(writer, jobs.StreamSettings(scratch_path(spark, "ckpt")))
    kept = _landed_orders(spark, path).select(
        F.lit("kept").alias("state"), "table", F.col("order_id").cast("string").alias("key"), F.lit(None).cast("string").alias("value")
    )
    lost = spark.read.schema("value string, `table` string").text(aside)
    lost = lost.select("table", F.from_json("value", "topic string, key string, value string").alias("r"))
    return kept.unionByName(lost.select(F.lit("aside").alias("state"), "table", "r.key", "r.value"))


def facts_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The second path over partly unusable records: facts and what was set aside with them."""
    changes = _shop_changes(spark, sf).withColumn("topic", F.lit("srv.dbo.sales"))
    folder = _in_files(_broken(changes), scratch_path(spark, "topics"))
    read = read_changes(spark, ChangeSource("srv", folder=folder), ["dbo.sales"], max_files=2)
    path, aside = scratch_path(spark, "facts"), scratch_path(spark, "aside")
    jobs.run(
        flows.capture_to_facts(read, path, now=_now(), aside=aside), jobs.StreamSettings(scratch_path(spark, "ckpt"))
    )
    facts = spark.read.schema(f"{prj.FACT_TYPE}, dt date").parquet(path)
    kept = facts.groupBy("dt").agg(F.count("*").alias("n")).select(F.lit("kept").alias("state"), "n")
    lost = spark.read.schema("value string, `table` string").text(aside)
    return kept.unionByName(lost.groupBy(F.lit("aside").alias("state")).agg(F.count("*").alias("n")))


def malformed_envelopes_land(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope text of which a part is malformed, enriched and landed: that part keeps its text."""
    text = inputs.order_envelopes(spark, sf, "o_orderkey")
    broken = F.when(F.col("o_orderkey") % 9 == 0, inputs.text_of("broken ", F.col("o_orderkey").cast("string")))
    facts = env.parse_envelope(text.select(F.coalesce(broken, F.col("value")).alias("value")))
    out = env.envelope_text(enrich(facts, _customer_dims(spark, sf)), text="value")
    path = scratch_path(spark, "ods")
    name = objects.get_string(F.col("envelope"), "table")
    files.land_by_table(files.landing_rows(out, table=name, by_day=False), path)
    landed = spark.read.schema("value string, `table` string").text(path)
    opened = F.from_json("value", "database string, Id bigint").alias("b")
    rows = landed.select("table", "value", opened)
    whole = F.col("table") != files.UNKNOWN_TABLE
    return rows.select(
        "table",
        F.col("b.database").alias("database"),
        F.col("b.Id").alias("order_id"),
        F.when(~whole, F.col("value")).alias("text"),
    )


def typed_rows_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope text without data, or no JSON: no facts, and set aside as it came."""
    number = F.col("o_orderkey")
    plain = inputs.text_of('{"data":{"id":"', number.cast("string"), '","total_amount":5},"type":"insert"}')
    body = F.when(number % 7 == 0, "no json").when(number % 5 == 0, '{"type":"insert"}').otherwise(plain)
    texts = inputs.table(spark, sf, "orders").select(body.alias("body"))
    facts = prj.typed_rows(texts, "body", now=_now()).select("id", "total_amount", F.lit(None).cast("string").alias("aside"))
    lost = prj.without_data(texts, "body")
    return facts.unionByName(
        lost.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("total_amount"), F.col("body").alias("aside"))
    )


def ip_location_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges nested in ranges over several prefixes: the one over an address that starts last."""
    ranges = inputs.nested_ranges(spark, sf)
    return with_ip_location(inputs.order_ips(spark, sf), "ip", ranges)


def enrich_large(spark: SparkSession, sf: str) -> DataFrame:
    """The two-key enrichment the way it runs when the dimension is too large to broadcast."""
    facts = env.parse_envelope(inputs.order_envelopes(spark, sf)).select("envelope")
    out = enrich(facts, _customer_dims(spark, sf), small=False)
    return _opened(out, _ORDER_OUT).withColumnRenamed("Id", "order_id")


def dimension_of_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables' change records keep the dimension: inserts, updates and deletes, in three batches.

    The log gives each message's place; the batches do not arrive in that order.
    """
    records = inputs.customer_changes(spark, sf)
    folder, path = scratch_path(spark, "topics"), scratch_path(spark, "dims")
    settings = jobs.StreamSettings(scratch_path(spark, "ckpt"))
    source = ChangeSource("srv", folder=folder)
    for offset in (2, 1, 3):
        records.filter(F.col("offset") == offset).write.mode("append").json(folder)
        changes = read_changes(spark, source, ["dbo.databases", "dbo.tenants"])
        feed = env.flat_envelope(env.read_records(changes))
        jobs.run(maintained_dims(feed, path, seq=position(), honor_deletes=True, merge_after=2), settings)
    return snapshot_dims(spark, path)


# --- controls --------------------------------------------------------------------------------


def clock_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Day number, epoch milliseconds and hour stamp, of a time given and of every event's."""
    return inputs.table(spark, sf, "events").select(
        "event_id",
        clock.today_number(_now()).alias("today"),
        clock.epoch_millis_text(_now()).alias("millis"),
        clock.hour_stamp(F.col("ts")).alias("hour"),
    )


def payload_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Message payloads as bytes, read as text."""
    lines = inputs.event_lines(spark, sf, "event_id").withColumn("value", F.encode("value", "UTF-8"))
    return prj.record_text(lines)


def restarted_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that fails in its second batch and goes on from its checkpoint: no row twice."""
    folder = _in_files(inputs.event_lines(spark, sf, "event_id"), scratch_path(spark, "in"))
    stream = spark.readStream.schema("value string, event_id bigint").option("maxFilesPerTrigger", 2).json(folder)
    out = scratch_path(spark, "out")
    write, failed = jobs.overwrite_batch(out), []

    def act(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    jobs.run(jobs.per_batch(stream, act), jobs.StreamSettings(scratch_path(spark, "ckpt"), retries=2))
    return spark.read.schema("value string, event_id bigint").parquet(out).drop("batch_id")


def dataset_controls(spark: SparkSession, sf: str) -> DataFrame:
    """A frame cut from its lineage, in fewer partitions, and its first rows in order."""
    held = local.checkpointed(inputs.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    few = local.fewer_files(held, 2)
    local.discard(few)
    return local.preview(few.orderBy("o_orderkey"), 10)


ALL = {
    f.__name__: f
    for f in (
        tm_amount_topk, amount_by_day, new_count_by_day, gmv_by_day, spu_topk, category3_topk,
        trademark_topk, report_amount, report_new, report_gmv, report_brands, report_products,
        report_categories, report_trademarks, cdc_flat, cdc_nested, cdc_collision, cdc_quarantine,
        snapshot_and_changes, changes_of_two_tables, changes_of_server, dimension_latest,
        dimension_deletes, enrich_two_key, enrich_one_key, enrich_columns, dimension_stream,
        enrich_stream,
        union_sources, ip_number, ip_location, ip_location_large, parent_path, id_projection,
        id_suffix, flatten_projection, typed_rows, typed_rows_of_text, positional_insert, rewrite_event,
        drop_transient, column_value_lists, source_list, word_counts, word_counts_of_files,
        word_pairs, token_lists, colon_count_stream, tail_to_messages, land_by_table, land_stream,
        capture_enrich_land, capture_stream_to_files, capture_stream_to_report, append_dynamic,
        topic_by_table, figures_of_table, streams_per_source, union_of_source_list,
        parent_paths_of_table, running_count_stream, append_dynamic_stream, fan_out_sinks,
        cdc_repeated_keys, capture_quarantine, facts_quarantine, malformed_envelopes_land,
        typed_rows_malformed, ip_location_overlap, enrich_large, dimension_of_changes, clock_texts,
        payload_texts, restarted_stream, dataset_controls,
    )
}
