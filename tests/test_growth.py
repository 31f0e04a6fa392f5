"""Growing logs, snapshots with changes, rolled folders, messages read once, lookups from SQL."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.net import ip_to_long
from millrace.lookup import bucketed_join, save_bucketed
from millrace.operators import envelope as env
from millrace.operators.geo import with_ip_location
from millrace.operators.hierarchy import with_parent_path
from millrace.operators.sql import register_ip_location, register_ip_number, register_parent_path
from millrace.sinks import compaction, files, messages, tables
from millrace.sources import snapshots
from millrace.sources.appended import AppendedReader, tail_appended
from millrace.sources.messages import header_id, read_once, topic_options
from millrace.streaming import health, jobs

# Growing logs


def rows_between(reader, start, end):
    out = []
    for split in reader.partitions(start, end):
        for batch in reader.read(split):
            out += batch.to_pylist()
    return out


@pytest.mark.parametrize("split_bytes", [1, 2, 7, 64, 1 << 20])
def test_every_line_belongs_to_one_split(tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    lines = ["x" * rng.choice([0, 0, 1, 3, 30, 200]) + str(i) * (i % 3) for i in range(120)]
    data = "".join(f"{line}\n" for line in lines).encode()
    (tmp_path / "a.log").write_bytes(data + b"not yet")
    reader = AppendedReader(str(tmp_path), split_bytes)
    rows = rows_between(reader, {}, reader.latestOffset())
    rows.sort(key=lambda r: r["position"])
    assert [r["value"] for r in rows] == lines
    assert all(data[r["position"] :].startswith(r["value"].encode() + b"\n") for r in rows)


def test_appended_lines_come_once_and_unfinished_ones_wait(tmp_path):
    log, reader = tmp_path / "a.log", AppendedReader(f"{tmp_path}/*.log", 5)
    log.write_bytes(b"")
    (tmp_path / "other.txt").write_text("no log\n")
    start, got = reader.initialOffset(), []
    for piece in [b"one\ntw", b"o\n", b"", b"three", b"\r\n\xff\n\n", b"end"]:
        with log.open("ab") as out:
            out.write(piece)
        end = reader.latestOffset()
        got.append([r["value"] for r in rows_between(reader, start, end)])
        start = end
    assert got == [["one"], ["two"], [], [], ["three", "�", ""], []]
    # A reader that starts anew knows nothing but the checkpoint's position.
    again = AppendedReader(f"{tmp_path}/*.log", 5)
    assert rows_between(again, start, again.latestOffset()) == []


def test_a_replaced_file_is_read_from_its_start(tmp_path):
    log, reader = tmp_path / "a.log", AppendedReader(str(tmp_path), 1 << 20)
    log.write_text("first one\nfirst two\n")
    start = reader.latestOffset()
    log.write_text("second file, which is longer than the first one was\nand goes on\n")
    end = reader.latestOffset()
    assert [r["value"] for r in rows_between(reader, start, end)][0].startswith("second file")
    log.write_text("short\n")
    assert [r["value"] for r in rows_between(reader, end, reader.latestOffset())] == ["short"]
    fresh = AppendedReader(str(tmp_path), 1 << 20)
    assert [r["value"] for r in rows_between(fresh, end, fresh.latestOffset())] == ["short"]


def test_tail_over_restarts(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    out, settings = str(tmp_path / "out"), jobs.StreamSettings(str(tmp_path / "ck"))
    want = []
    for step in range(3):
        for name in range(step + 1):
            lines = [f"{name}-{step}-{i}" for i in range(50)]
            want += lines
            with (folder / f"{name}.log").open("a") as log:
                log.write("".join(f"{line}\n" for line in lines))
        stream = tail_appended(spark, str(folder), split_bytes=100)
        jobs.run(jobs.per_batch(stream, jobs.overwrite_batch(out)), settings)
    rows = spark.read.parquet(out)
    assert sorted(r["value"] for r in rows.collect()) == sorted(want)
    assert rows.select("file").distinct().count() == 3


# Snapshots


def test_ranges_cover_every_key_once(spark):
    rows = spark.createDataFrame([(k,) for k in [5] * 50 + list(range(100)) + [None]], "id long")
    ranges = snapshots.key_ranges(rows, "id", 8)
    assert 2 <= len(ranges) <= 8 and ranges[0].low is None and ranges[-1].high is None
    counts = [rows.filter(r.condition(F.col("id"))).count() for r in ranges]
    assert sum(counts) == 151 and max(counts) <= 80
    assert [rows.filter(r.predicate("id")).count() for r in ranges] == counts
    assert len(snapshots.key_ranges(rows.limit(0), "id", 8)) == 1
    assert len(snapshots.key_ranges(rows, "id", 1)) == 1


def test_rows_that_a_change_overtook_go(spark):
    rows = [({"id": 1, "v": "a"}, 0, 10, 20), ({"id": 2, "v": "b"}, 0, 10, 20), ({"id": 3, "v": "c"}, 1, 20, 30)]
    chunks = spark.createDataFrame([((r["id"], r["v"]), *m) for r, *m in rows], "row struct<id: long, v: string>, chunk int, low_mark long, high_mark long")
    log = spark.createDataFrame([(1, 10), (2, 11), (3, 20), (3, 31), (9, 15)], "id long, position long")
    kept = snapshots.settled_rows(chunks, log, "id")
    assert sorted(r["row"]["id"] for r in kept.collect()) == [1, 3]


def test_feed_gives_the_state_whatever_a_read_saw(spark):
    """Keys change, go and come back while ranges are read at random places of the log."""
    rng = random.Random(3)
    state_at, log = [{k: f"v{k}" for k in range(30)}], []
    for position in range(1, 81):
        state, key = dict(state_at[-1]), rng.randrange(36)
        gone = rng.random() < 0.3
        state.pop(key, None) if gone else state.update({key: f"p{position}"})
        log.append((key, position, None if gone else (key, f"p{position}"), gone))
        state_at.append(state)
    changes = spark.createDataFrame(log, "id long, position long, row struct<id: long, v: string>, gone boolean")
    marks = iter([0, 20, 20, 35, 50, 80])
    low = []

    def mark():
        low.append(next(marks))
        return low[-1]

    def read(chunk):
        seen = {k: state_at[low[-1] + rng.randrange(15)].get(k) for k in range(36)}
        rows = [(k, v) for k, v in seen.items() if v is not None]
        return spark.createDataFrame(rows, "id long, v string").filter(chunk.condition(F.col("id")))

    ranges = [snapshots.KeyRange(0, None, 10), snapshots.KeyRange(1, 10, 20), snapshots.KeyRange(2, 20, None)]
    chunks = snapshots.read_chunks(spark, ranges, read, mark)
    got = snapshots.state_of(snapshots.handover(chunks, changes, "id"), "id")
    assert {r["id"]: r["v"] for r in got.collect()} == state_at[-1]


# Rolled folders


def landed(spark, path):
    return sorted(tuple(r) for r in compaction.read_landed(spark, path).collect())


def land(spark, path, batch_id, rows):
    df = spark.createDataFrame(rows, "value string, `table` string, dt string").repartition(3)
    files.land_batch(df, path, batch_id)


def test_rolled_folders_keep_every_line_once(spark, tmp_path):
    path = str(tmp_path / "land")
    rows = [(f"line {i}", table, day) for i in range(40) for table in ("a", "b c:d%") for day in ("2024-01-01", "2024-01-02")]
    random.Random(1).shuffle(rows)
    for batch_id in range(4):
        land(spark, path, batch_id, rows[batch_id::4])
    assert landed(spark, path) == sorted(rows)
    assert compaction.compact(spark, path, before="2024-01-02") == 2
    assert landed(spark, path) == sorted(rows)
    assert compaction.compact(spark, path, before="2024-01-02") == 0
    run = tmp_path / "land-compacted" / "runs"
    assert len(list(run.rglob("part-*.txt"))) == 2
    # A late batch is seen at once, and taken by the next run.
    late = [("late", "a", "2024-01-01")]
    land(spark, path, 9, late)
    assert landed(spark, path) == sorted(rows + late)
    assert compaction.compact(spark, path, before="2024-01-02") == 1
    assert landed(spark, path) == sorted(rows + late)
    assert compaction.expire_covered(spark, path, older_than=3600) == 0
    gone = compaction.expire_covered(spark, path, older_than=-1)
    assert gone == 9 and landed(spark, path) == sorted(rows + late)
    assert compaction.expire_covered(spark, path, older_than=-1) == 0
    assert compaction.compact(spark, path, before="2024-01-02") == 0


def test_a_run_that_was_never_published_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "land")
    rows = [(f"line {i}", "a", "2024-01-01") for i in range(9)]
    for batch_id in range(3):
        land(spark, path, batch_id, rows[batch_id::3])
    with monkeypatch.context() as broken:
        broken.setattr(compaction.time, "time", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact(spark, path, before="2024-02-01")
    assert landed(spark, path) == rows
    assert compaction.compact(spark, path, before="2024-02-01") == 1
    assert landed(spark, path) == rows
    assert compaction.expire_covered(spark, path, older_than=-1) == 3  # nothing is left where it landed
    assert landed(spark, path) == rows


def test_a_large_folder_gets_several_files(spark, tmp_path):
    path = str(tmp_path / "land")
    for batch_id in range(8):
        land(spark, path, batch_id, [(f"{batch_id} " + "x" * 100, "a", "2024-01-01")] * 30)
    assert compaction.compact(spark, path, before="2024-02-01", target_bytes=8000) == 1
    assert 2 <= len(list((tmp_path / "land-compacted" / "runs").rglob("part-*.txt"))) <= 4
    assert len(landed(spark, path)) == 240


# Messages read once


def test_a_batch_that_runs_again_gives_the_same_ids(spark, tmp_path):
    spark.range(100).repartition(4).selectExpr("cast(id as string) value").write.json(str(tmp_path / "in"))
    seen = []
    for checkpoint in ("one", "two"):
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).json(str(tmp_path / "in"))
        out = str(tmp_path / checkpoint / "out")
        writer = messages.identified_batches(stream, lambda b, out=out: b.write.mode("append").json(out))
        jobs.run(writer, jobs.StreamSettings(str(tmp_path / checkpoint / "ck")))
        seen.append(sorted((r["value"], r["id"]) for r in spark.read.json(out).collect()))
    assert seen[0] == seen[1] and len({i for _, i in seen[0]}) == 100


def test_repeats_are_dropped_also_in_later_runs(spark, tmp_path):
    topic, out = tmp_path / "topic", str(tmp_path / "out")
    sent = [[("a", "1"), ("b", "2"), ("a", "1")], [("b", "2"), ("c", "3"), ("n", None)], [("n", None), ("c", "3")]]
    for number, rows in enumerate(sent):
        df = spark.createDataFrame([(v, i, number) for v, i in rows], "value string, id string, s int")
        stamped = df.select("value", "id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("timestamp"))
        stamped.coalesce(1).write.mode("append").json(str(topic))
        stream = spark.readStream.schema("value string, id string, timestamp timestamp").json(str(topic))
        writer = jobs.per_batch(read_once(stream, "10 minutes"), jobs.overwrite_batch(out))
        jobs.run(writer, jobs.StreamSettings(str(tmp_path / "ck")))
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "n", "n"]


def test_ids_in_headers(spark):
    row = spark.range(1).select(F.lit("7-0-3").alias("id")).select(messages.id_headers(F.col("id")))
    assert row.select(header_id(F.col("headers")).alias("id")).first()["id"] == "7-0-3"


def test_batches_begin_by_size_or_time():
    options = topic_options("b:1", ["t"], max_per_batch=9000, min_per_batch=5000, max_wait="2000ms")
    assert options["minOffsetsPerTrigger"] == "5000" and options["maxTriggerDelay"] == "2000ms"
    with pytest.raises(ValueError):
        topic_options("b:1", ["t"], min_per_batch=5000)


# Lookups from SQL

IPS = ["0.0.0.5", "1.2.3.4", "1.2.3.255", "1.2.200.1", "9.9.9.9", "x", "", "999.1.0.300", "1.2.3.4 ", None]


def test_sql_functions_agree_with_the_operators(spark, plan):
    ips = spark.createDataFrame([(ip,) for ip in IPS], "ip string")
    ips.createOrReplaceTempView("some_ips")
    register_ip_number(spark, "ip_as_number")
    got = spark.sql("SELECT ip, ip_as_number(ip) AS n FROM some_ips").collect()
    assert got == ips.select("ip", ip_to_long(F.col("ip")).alias("n")).collect()
    low = 0x01020000
    ranges = [(low, low + 300_000, "wide"), (low + 700, low + 900, "in'ner"), (0, 9, "zero"), (low + 65_000, low + 66_000, "over")]
    ranges += [(low + 10 * i, low + 10 * i + 5, f"dense {i}") for i in range(60)]
    table = spark.createDataFrame(ranges, "start_ip long, end_ip long, location string")
    register_ip_location(spark, table, "place", no_match="no\\'where")
    want = {r["ip"]: r["location"] for r in with_ip_location(ips, "ip", table, no_match="no\\'where").collect()}
    found = spark.sql("SELECT ip, place(ip) AS location FROM some_ips")
    assert {r["ip"]: r["location"] for r in found.collect()} == want
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    several = spark.sql("SELECT s.ip, p.location FROM some_ips s LEFT JOIN LATERAL place_of(s.ip) p")
    assert "NestedLoop" not in plan(several) and "Cartesian" not in plan(several)
    shown = {ip: None if ip is None or text == "no\\'where" else text for ip, text in want.items()}
    assert {r["ip"]: r["location"] for r in several.collect()} == shown
    grouped = spark.sql("SELECT place(ip) AS p, count(*) AS n FROM some_ips WHERE place(ip) = 'zero' GROUP BY ALL")
    assert [tuple(r) for r in grouped.collect()] == [("zero", 4)]


def test_sql_paths_agree_with_the_operator(spark, plan):
    edges = [("4", "2", "g"), ("2", "1", "x"), ("1", "", "g"), ("5", "4", "x"), ("6", "5", "g")]
    edges = spark.createDataFrame(edges, "id string, parentid string, cfg_group string")
    nodes = spark.createDataFrame([("4",), ("6",), ("5",), ("none",), (None,)], "id string")
    nodes.createOrReplaceTempView("some_nodes")
    register_parent_path(spark, edges, "way", "g")
    found = spark.sql("SELECT id, way(id) AS path FROM some_nodes")
    assert sorted(map(str, found.collect())) == sorted(map(str, with_parent_path(nodes, "id", edges, "g").collect()))
    assert "NestedLoop" not in plan(found)


# Tables that change their shape


def objects_of(spark, texts):
    return env.parse_envelope(spark.createDataFrame([(t,) for t in texts], "value string")).select("envelope")


@pytest.fixture
def table(spark, tmp_path):
    name = "evolving_" + re.sub(r"\W", "_", tmp_path.name)
    spark.sql(f"CREATE TABLE {name} (id INT, f FLOAT, name STRING, flag BOOLEAN) USING parquet LOCATION '{tmp_path / 'table'}'")
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_columns_come_and_widen(spark, table):
    first = objects_of(spark, ['{"id":1,"f":0.5,"name":"a","flag":true}', '{"ID":2}'])
    assert tables.append_evolving(first, table) == ({}, {"f": "double"})  # a number with a point is a double
    more = ['{"id":3000000000,"f":1e300,"Name":7,"new":1,"none":null}', '{"new":5,"list":[1,{"a":2}],"mixed":1}', '{"mixed":"x"}']
    added, widened = tables.append_evolving(objects_of(spark, more), table)
    assert added == {"new": "bigint", "list": "string", "mixed": "string"}
    assert widened == {"id": "bigint"}
    rows = {tuple(r) for r in spark.table(table).collect()}
    assert rows == {
        (1, 0.5, "a", True, None, None, None),
        (2, None, None, None, None, None, None),
        (3000000000, 1e300, "7", None, None, None, 1),
        (None, None, None, None, '[1,{"a":2}]', "1", 5),
        (None, None, None, None, None, "x", None),
    }
    assert tables.append_evolving(objects_of(spark, more), table) == ({}, {})


def test_a_conflict_changes_nothing(spark, table):
    with pytest.raises(ValueError, match="flag is boolean, got int"):
        tables.append_evolving(objects_of(spark, ['{"flag":3,"new":1}']), table)
    assert spark.table(table).columns == ["id", "f", "name", "flag"] and spark.table(table).count() == 0
    assert tables.append_evolving(objects_of(spark, ["{}"]).limit(0), table) == ({}, {})


def test_a_table_that_spark_owns_is_not_declared_anew(spark):
    spark.sql("CREATE TABLE owned_one (id INT) USING parquet")
    try:
        with pytest.raises(ValueError, match="no external table"):
            tables.append_evolving(objects_of(spark, ['{"id":3000000000}']), "owned_one")
        assert spark.table("owned_one").schema["id"].dataType.simpleString() == "int"
    finally:
        spark.sql("DROP TABLE owned_one")


# Dimensions that stay where they are


def test_a_bucketed_table_is_not_moved(spark, tmp_path, plan, no_broadcast):
    dims = spark.range(200).selectExpr("'k' || id as k", "'v' || id as v")
    save_bucketed(dims, "bucketed_dims", "k", 8, str(tmp_path / "dims"))
    try:
        keys = [f"k{i % 300}" for i in range(3000)] + ["k7"] * 4000 + [None] * 500
        facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, n long")
        joined = bucketed_join(facts, spark.table("bucketed_dims"), "k")
        want = {(k, i): f"v{k[1:]}" if k and int(k[1:]) < 200 else None for i, k in enumerate(keys)}
        assert {(r["k"], r["n"]): r["v"] for r in joined.collect()} == want and joined.count() == len(keys)
        shown = plan(joined)
        merge = shown[shown.index("SortMergeJoin") :]
        scan = merge[: merge.index("Bucketed: true")]
        right = scan[scan.rindex("+- ", 0, scan.rindex("Filter")) :]
        assert "Bucketed: true" in merge and "Exchange" not in right
        with pytest.raises(ValueError):
            bucketed_join(spark.readStream.format("rate").load().selectExpr("'k' k"), spark.table("bucketed_dims"), "k")
    finally:
        spark.sql("DROP TABLE bucketed_dims")


# Settings of jobs


def lines_stream(spark, tmp_path):
    spark.range(30).repartition(3).selectExpr("cast(id as string) value").write.json(str(tmp_path / "in"))
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def test_a_batch_that_takes_too_long_runs_again(spark, tmp_path):
    out, slow = str(tmp_path / "out"), []
    write = jobs.overwrite_batch(out)

    def act(batch, batch_id):
        if batch_id == 1 and not slow:
            slow.append(1)
            time.sleep(8)
        write(batch, batch_id)

    writer = jobs.per_batch(lines_stream(spark, tmp_path), act)
    jobs.run(writer, jobs.StreamSettings(str(tmp_path / "ck"), batch_timeout=3, retries=2))
    assert slow and spark.read.parquet(out).count() == 30
    with pytest.raises(TimeoutError):
        stuck = jobs.per_batch(lines_stream(spark, tmp_path / "b"), lambda batch, i: time.sleep(6))
        jobs.run(stuck, jobs.StreamSettings(str(tmp_path / "ck2"), batch_timeout=1, retries=0))


def test_batches_keep_their_pause(spark, tmp_path):
    times = []
    act = jobs.paced(lambda batch, i: times.append((time.monotonic(), time.sleep(0.1), time.monotonic())), 0.7)
    jobs.run(jobs.per_batch(lines_stream(spark, tmp_path), act), jobs.StreamSettings(str(tmp_path / "ck")))
    assert len(times) == 3 and all(b[0] - a[2] >= 0.65 for a, b in zip(times, times[1:]))


def test_a_query_stops_after_its_batch(spark, tmp_path):
    done = []
    writer = jobs.per_batch(lines_stream(spark, tmp_path), lambda batch, i: (time.sleep(1.5), done.append(i)))
    query = jobs.start(writer, jobs.StreamSettings(str(tmp_path / "ck"), every="1 hour"))
    while not query.status["isTriggerActive"]:
        time.sleep(0.05)
    assert jobs.stop_after_batch(query) and not query.isActive and len(done) >= 1


def test_reports_and_failures_are_kept(spark, tmp_path):
    recorder = health.Recorder(keep=50)
    spark.streams.addListener(recorder)
    try:
        good = jobs.per_batch(lines_stream(spark, tmp_path), lambda batch, i: batch.count()).queryName("good")
        jobs.run(good, jobs.StreamSettings(str(tmp_path / "ck")))
        bad = jobs.per_batch(lines_stream(spark, tmp_path / "b"), lambda batch, i: 1 / 0).queryName("bad")
        with pytest.raises(Exception):
            jobs.run(bad, jobs.StreamSettings(str(tmp_path / "ck2"), retries=0))
        for _ in range(100):
            if recorder.failures and len([r for r in recorder.reports if r[0] == "good" and r[2]]) >= 3:
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(recorder)
    rows = recorder.table(spark).filter("query = 'good' and `rows` > 0").collect()
    assert sum(r["rows"] for r in rows) == 30 and sorted(r["batch"] for r in rows) == [0, 1, 2]
    assert "division by zero" in recorder.failures[0][1] and not recorder.active
    late = spark.createDataFrame([("q", 1, 5, 9.0, 1.0, 0.0, "b"), ("q", 0, 5, 1.0, 1.0, 0.0, "a"), ("r", 0, 5, 1.0, 1.0, 0.0, "a")], health.PROGRESS_TYPE)
    assert [r["query"] for r in health.behind(late, 5.0).collect()] == ["q"]
