from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import envelope as env
from millrace.operators import kpi
from millrace.plans import flows
from millrace.sinks import files
from millrace.sources.changes import ChangeSource, read_changes
from millrace.plans.inputs import spread
from millrace.streaming import dims, jobs
from millrace.streaming.dims import maintained_dims, snapshot_dims


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def change(table, row, db="shop", op="c"):
    value = {"before": None, "after": row, "source": {"db": db}, "op": op}
    return {"topic": f"srv.dbo.{table}", "key": None, "value": json.dumps(value)}


def feed_row(seq, **body):
    return {"value": json.dumps(body), "seq": seq}


def run_feed(spark, tmp_path):
    rows = spark.readStream.schema("value string, seq long").json(str(tmp_path / "feed"))
    writer = maintained_dims(env.parse_envelope(rows), str(tmp_path / "dims"))
    jobs.run(writer, jobs.StreamSettings(str(tmp_path / "feed-ck")))


def dims_now(spark, tmp_path):
    rows = snapshot_dims(spark, str(tmp_path / "dims")).collect()
    return {r.database: (r.guid, r.tenantid) for r in rows}


def test_dimension_state_survives_restarts(spark, tmp_path):
    assert dims_now(spark, tmp_path) == {}
    put(tmp_path / "feed", "1.json", [feed_row(1, DataBase="a", guid="A1"), feed_row(2, db_name="a", tenant_id="T")])
    run_feed(spark, tmp_path)
    assert dims_now(spark, tmp_path) == {"a": ("A1", "T")}
    put(tmp_path / "feed", "2.json", [feed_row(3, DataBase="a", guid="A2"), feed_row(4, DataBase="b", guid="B")])
    run_feed(spark, tmp_path)
    assert dims_now(spark, tmp_path) == {"a": ("A2", "T"), "b": ("B", None)}
    put(tmp_path / "feed", "3.json", [feed_row(5, DataBase="b")])
    run_feed(spark, tmp_path)
    assert dims_now(spark, tmp_path) == {"a": ("A2", "T")}


def landed(spark, path):
    return sorted(
        (r.table, str(r.dt), json.dumps(json.loads(r.value), sort_keys=True))
        for r in spark.read.text(str(path)).collect()
    )


def test_capture_to_files_repeats_nothing_after_a_failure(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [feed_row(1, DataBase="shop", guid="G"), feed_row(2, db_name="shop", tenant_id="9")])
    run_feed(spark, tmp_path)
    path, settings = tmp_path / "ods", jobs.StreamSettings(str(tmp_path / "ck"), retries=1)
    lost = []

    def read_dims():
        return snapshot_dims(spark, str(tmp_path / "dims"))

    def start_once(fail):
        changes = read_changes(spark, ChangeSource("srv", folder=str(tmp_path / "in")))
        writer = flows.capture_to_files(changes, read_dims, str(path), F.lit("2024-01-02").cast("date"))
        if not fail:
            return jobs.run(writer, settings)
        original = flows.land_batch

        def land_then_lose(rows, target, batch_id):
            original(rows, target, batch_id)
            if not lost:
                lost.append(batch_id)
                raise RuntimeError("executor lost")

        flows.land_batch = land_then_lose
        try:
            return jobs.run(writer, settings)
        finally:
            flows.land_batch = original

    put(tmp_path / "in", "1.json", [change("A", {"Id": 1}), change("B", {"Id": 2}, db="other")])
    start_once(fail=True)
    put(tmp_path / "in", "2.json", [change("A", {"Id": 3}, op="u"), {"topic": "srv.dbo.A", "value": "junk"}])
    start_once(fail=False)
    assert lost == [0]
    want = [
        ("A", {"database": "G", "tenantid": "9", "table": "A", "Id": 1, "type": "insert"}),
        ("A", {"database": "G", "tenantid": "9", "table": "A", "Id": 3, "type": "update"}),
        ("B", {"database": "other", "table": "B", "Id": 2, "type": "insert"}),
    ]
    assert landed(spark, path) == sorted((t, "2024-01-02", json.dumps(b, sort_keys=True)) for t, b in want)


def test_processing_date_is_the_default_day(spark, tmp_path):
    put(tmp_path / "in", "1.json", [change("A", {"Id": 1})])
    changes = read_changes(spark, ChangeSource("srv", folder=str(tmp_path / "in")))
    writer = flows.capture_to_files(
        changes, lambda: snapshot_dims(spark, str(tmp_path / "none")), str(tmp_path / "ods"), tenant=False
    )
    jobs.run(writer, jobs.StreamSettings(str(tmp_path / "ck")))
    days = spark.read.text(str(tmp_path / "ods")).select("dt", F.current_date().alias("d")).first()
    assert str(days.dt) == str(days.d)


def test_capture_to_facts(spark, tmp_path, plan):
    put(tmp_path / "in", "1.json", [change("sales", {"id": 1, "total_amount": 5}), change("sales", {"id": 2})])
    changes = read_changes(spark, ChangeSource("srv", folder=str(tmp_path / "in")))
    jobs.run(flows.capture_to_facts(changes, str(tmp_path / "f")), jobs.StreamSettings(str(tmp_path / "ck")))
    rows = spark.read.parquet(str(tmp_path / "f")).orderBy("id").collect()
    assert [(r.id, r.total_amount, r.pro_cnt) for r in rows] == [("1", 5, 0), ("2", 0, 0)]
    assert rows[0].date is not None
    facts = spark.read.parquet(str(tmp_path / "f"))
    assert "PartitionFilters: [isnotnull(dt" in plan(kpi.amount(facts, 20240102, ts="dt"))
    assert kpi.new_count(facts, 0, ts="dt").first()[0] == 2


def test_stream_landing_gathers_files(spark, tmp_path):
    rows = [change("hot" if i % 3 else f"t{i % 4}", {"Id": i}) for i in range(300)]
    for part in range(6):
        put(tmp_path / "in", f"{part}.json", rows[part::6])
    changes = read_changes(spark, ChangeSource("srv", folder=str(tmp_path / "in")))
    flat = env.envelope_text(env.flat_envelope(env.read_records(changes)))
    landing = files.landing_rows(flat, table=F.get_json_object("body", "$.table"), by_day=False)
    ck = str(tmp_path / "ck")
    jobs.run(files.land_stream(landing, str(tmp_path / "out"), ck), jobs.StreamSettings(ck))
    assert spark.read.text(str(tmp_path / "out")).count() == 300
    for folder in (tmp_path / "out").glob("table=*"):
        assert len(list(folder.glob("*/*.txt"))) == 1


def test_writers_of_a_hot_table_grow_with_it(spark, tmp_path):
    """What lands is split by size, between reading tasks: more bytes have more writers, without a cap."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        files_of = {}
        for rows in (2_000, 40_000):
            text = F.concat(F.lit("x"), F.sha2(F.col("id").cast("string"), 256))
            df = spark.range(0, rows, 1, rows // 500).select(text.alias("value"), F.lit("hot").alias("table"))
            files.land_batch(df, str(tmp_path / str(rows)), 0)
            files_of[rows] = len(list((tmp_path / str(rows)).glob("table=hot/*/*.txt")))
        assert files_of[40_000] > 8 >= 4 * files_of[2_000]
    finally:
        spark.conf.set(key, before)


def test_a_new_checkpoint_does_not_bring_old_values_back(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [feed_row(7, DataBase="a", guid="new"), feed_row(1, DataBase="b", guid="B")])
    run_feed(spark, tmp_path)
    put(tmp_path / "feed2", "1.json", [feed_row(3, DataBase="a", guid="old"), feed_row(9, DataBase="c", guid="C")])
    rows = spark.readStream.schema("value string, seq long").json(str(tmp_path / "feed2"))
    writer = maintained_dims(env.parse_envelope(rows), str(tmp_path / "dims"))
    jobs.run(writer, jobs.StreamSettings(str(tmp_path / "other-ck")))
    assert dims_now(spark, tmp_path) == {"a": ("new", None), "b": ("B", None), "c": ("C", None)}


def test_a_batch_again_during_a_read_changes_nothing(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [feed_row(1, DataBase="a", guid="A")])
    run_feed(spark, tmp_path)
    open_before = snapshot_dims(spark, str(tmp_path / "dims"))
    rows = spark.readStream.schema("value string, seq long").json(str(tmp_path / "feed"))
    again = maintained_dims(env.parse_envelope(rows), str(tmp_path / "dims"), merge_after=1)
    jobs.run(again, jobs.StreamSettings(str(tmp_path / "again-ck")))
    assert [tuple(r) for r in open_before.collect()] == [("a", "A", None)]  # its files are still there
    assert dims_now(spark, tmp_path) == {"a": ("A", None)}
    state = dims.read_state(spark, str(tmp_path / "dims"))
    assert [t["name"].split("-")[0] for t in state.tables] == ["full"] and state.number == 3
    assert dims._expire(spark, str(tmp_path / "dims"), state, keep=-1.0) == 2
    assert [f.name for f in (tmp_path / "dims" / "tables").iterdir()] == [state.tables[0]["name"]]
    assert dims_now(spark, tmp_path) == {"a": ("A", None)}


def test_work_of_a_batch_does_not_grow_with_the_batches_before(spark, tmp_path):
    """Of 60 batches each leaves at most five tables to read and four state files."""
    path = str(tmp_path / "dims")
    for number in range(60):
        rows = spark.createDataFrame([(f"k{number % 7}", "guid", f"v{number}", number)], "database string, kind string, value string, seq long")
        state = dims._publish(spark, path, dims.read_state(spark, path), rows, full=False)
        if len(state.tables) > 4:
            dims._publish(spark, path, state, dims._merged(spark, path, state), full=True)
        state = dims.read_state(spark, path)
        assert len(state.tables) <= 5 and len(list((tmp_path / "dims" / "state").glob("[!.]*"))) <= 4
    assert dims_now(spark, tmp_path) == {f"k{n % 7}": (f"v{n}", None) for n in range(53, 60)}
    assert sum(t["rows"] for t in state.tables) <= 11


def test_unusable_records_are_set_aside_in_both_flows(spark, tmp_path):
    junk = {"topic": "srv.dbo.A", "key": "9", "value": "junk"}
    put(tmp_path / "in", "1.json", [change("A", {"id": 1}), junk, change("A", None, op="t")])
    changes = read_changes(spark, ChangeSource("srv", folder=str(tmp_path / "in")))
    path = str(tmp_path / "ods")
    writer = flows.capture_to_files(changes, lambda: snapshot_dims(spark, str(tmp_path / "none")), path)
    jobs.run(writer, jobs.StreamSettings(str(tmp_path / "ck")))
    assert spark.read.text(path).count() == 2
    aside = [json.loads(r.value) for r in spark.read.text(path + "-unusable").collect()]
    assert aside == [{"topic": "srv.dbo.A", "key": "9", "value": "junk"}]
    jobs.run(flows.capture_to_facts(changes, str(tmp_path / "f")), jobs.StreamSettings(str(tmp_path / "ck2")))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "f")).collect()] == ["1"]
    assert spark.read.text(str(tmp_path / "f-unusable")).count() == 2


@pytest.mark.parametrize("splits, moved", [(1, True), (2, True), (3, False), (8, False)])
def test_spread_moves_only_idle_scans(spark, splits, moved):
    df = spark.range(0, 100, 1, splits)
    assert spark.sparkContext.defaultParallelism == 4
    assert (spread(df).rdd.getNumPartitions() != splits) == moved
