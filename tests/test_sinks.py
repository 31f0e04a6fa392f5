from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import objects
from millrace.operators import envelope as env
from millrace.operators.words import word_count
from millrace.sinks import database, files, local, messages, tables
from millrace.sources.files import read_lines
from millrace.streaming import jobs


def test_landing_layout(spark, tmp_path):
    df = spark.createDataFrame(
        [('{"a":1}', "t1", dt.date(2024, 1, 2)), ('{"a":2}', "t1", dt.date(2024, 1, 3)), ("{}", None, None)],
        "body string, table string, day date",
    )
    path = str(tmp_path / "land")
    files.land_by_table(files.landing_rows(df, day=F.coalesce("day", F.lit(dt.date(2000, 1, 1)))), path)
    folders = sorted(str(p.relative_to(path)) for p in (tmp_path / "land").glob("*/*") if p.is_dir())
    assert folders == [
        "table=t1/dt=2024-01-02", "table=t1/dt=2024-01-03", f"table={files.UNKNOWN_TABLE}/dt=2000-01-01",
    ]
    assert {r.value for r in spark.read.text(path).collect()} == {'{"a":1}', '{"a":2}', '{}'}


def test_landing_defaults_to_today(spark):
    df = spark.createDataFrame([("{}", "t")], "body string, table string")
    row = files.landing_rows(df).select("dt", F.date_format(F.current_date(), "yyyy-MM-dd").alias("d")).first()
    assert row.dt == row.d
    assert files.landing_rows(df, by_day=False).columns == ["value", "table"]


def test_landing_file_count_follows_data(spark, tmp_path):
    df = spark.range(4000, numPartitions=8).selectExpr(
        "cast(id as string) body", "if(id % 3 = 0, 'hot', concat('t', id % 5)) table"
    )
    path = tmp_path / "few"
    files.land_by_table(files.landing_rows(df, by_day=False), str(path))
    assert len(list(path.glob("*/*.txt"))) <= 6 * 2
    assert spark.read.text(str(path)).count() == 4000


def test_records_per_file(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id as string) body", "'t' table")
    files.land_by_table(files.landing_rows(df, by_day=False), str(tmp_path / "r"), max_records=30)
    assert len(list((tmp_path / "r").glob("*/*.txt"))) >= 4


def test_save_pairs(spark, tmp_path):
    pairs = spark.createDataFrame([("a", 1), ("", 1)], "word string, one int")
    files.save_pairs_text(pairs, str(tmp_path / "p"), files=1)
    assert sorted(r.value for r in read_lines(spark, str(tmp_path / "p")).collect()) == ["(,1)", "(a,1)"]
    assert len(list((tmp_path / "p").glob("part-*"))) == 1


def envelopes(spark, bodies):
    return env.parse_envelope(spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1))


TARGET = StructType().add("id", "long").add("Name", "string").add("ok", "boolean")


def test_promote_columns(spark):
    df = envelopes(spark, ['{"Id":1,"name":"it\'s"}', '{"ID":"2","OK":true,"Name":null}', "{}"])
    rows = [tuple(r) for r in tables.promote_columns(df, TARGET).collect()]
    assert rows == [(1, "it's", None), (2, None, True), (None, None, None)]


@pytest.mark.parametrize("body", ['{"id":1,"extra":2}', '{"id":1,"ID":2}', '{"id":"x"}'])
def test_promote_columns_errors(spark, body):
    with pytest.raises(Exception, match="not in the target|DUPLICATED|CAST"):
        tables.promote_columns(envelopes(spark, [body]), TARGET).collect()


def test_append_dynamic(spark):
    spark.sql("DROP TABLE IF EXISTS t_dyn")
    spark.sql("CREATE TABLE t_dyn (id BIGINT, Name STRING, ok BOOLEAN) USING parquet")
    tables.append_dynamic(envelopes(spark, ['{"Id":1}']), "t_dyn")
    tables.append_dynamic(envelopes(spark, ['{"name":"b","ok":"false"}']), "t_dyn")
    assert sorted(map(str, spark.table("t_dyn").collect())) == [
        "Row(id=1, Name=None, ok=None)", "Row(id=None, Name='b', ok=False)",
    ]
    spark.sql("DROP TABLE t_dyn")


def test_dynamic_streams(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"value":"{\\"id\\":1}"}\n{"value":"{\\"NAME\\":\\"x\\"}"}\n')
    stream = env.parse_envelope(spark.readStream.schema("value string").json(str(tmp_path / "in")))
    out = str(tmp_path / "out")
    jobs.run(tables.dynamic_stream(stream, TARGET, out), jobs.StreamSettings(str(tmp_path / "ck")))
    rows = spark.read.schema(TARGET).parquet(out).collect()
    assert sorted(map(str, rows)) == ["Row(id=1, Name=None, ok=None)", "Row(id=None, Name='x', ok=None)"]
    handed = []
    monkeypatch.setattr(database, "append_rows", lambda df, options: handed.append((df.columns, df.count(), options)))
    ck = str(tmp_path / "ck2")
    jobs.run(database.dynamic_stream(stream, TARGET, {"url": "jdbc:x"}, ck), jobs.StreamSettings(ck))
    ck = str(tmp_path / "ck3")
    facts = stream.select("value")
    jobs.run(database.positional_stream(facts, {"url": "jdbc:x"}, ck, ["body"]), jobs.StreamSettings(ck))
    assert handed == [(["id", "Name", "ok"], 2, {"url": "jdbc:x"}), (["body"], 2, {"url": "jdbc:x"})]


def test_positional_rows_and_options(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert database.positional_rows(df, ["u", "v"], ["b"]).columns == ["u", "v"]
    with pytest.raises(ValueError):
        database.positional_rows(df, ["u"])
    options = database.write_options("jdbc:x", "t", extra={"driver": "d"})
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "driver": "d"}


def test_database_appends_through_any_writer(spark, tmp_path):
    """The JDBC writer itself needs a database; the rows it is handed are checked through parquet."""
    path = str(tmp_path / "rows")
    database.append_rows(spark.range(3), {"path": path}, fmt="parquet")
    assert spark.read.parquet(path).count() == 3


def test_message_rows(spark):
    df = spark.createDataFrame([("b", "t", 5)], "body string, table string, id int")
    rows = messages.message_rows(df, topic=F.col("table"), key=F.col("id"))
    assert [tuple(r) for r in rows.collect()] == [("b", "t", "5")]
    assert messages.message_rows(df).columns == ["value"]
    assert messages.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_local_sinks(spark, capsys, tmp_path):
    df = spark.range(20)
    local.print_rows(df, "p", 2)
    assert capsys.readouterr().out.splitlines() == ['p> {"id":0}', 'p> {"id":1}']
    assert local.preview(df).count() == 10
    local.discard(df)
    seen = []
    local.fan_out(df, [lambda d: seen.append(d.count()), lambda d: d.write.parquet(str(tmp_path / "f"))])
    assert seen == [20] and spark.read.parquet(str(tmp_path / "f")).count() == 20
    kept = local.checkpointed(df.selectExpr("id * 2 as x"))
    assert kept.agg(F.sum("x")).first()[0] == 380
    assert local.fewer_files(spark.range(0, 10, 1, 4), 2).rdd.getNumPartitions() == 2
    local.for_each_row(df, lambda row: None)


def test_word_count_file(spark, tmp_path):
    (tmp_path / "t.txt").write_text("hello scala\nhello spark\nhello flink\nhello java")
    rows = word_count(read_lines(spark, str(tmp_path / "t.txt")), "value").collect()
    assert {r.word: r.n for r in rows} == {"hello": 4, "scala": 1, "spark": 1, "flink": 1, "java": 1}


def test_object_strings(spark):
    df = envelopes(spark, ['{"a":1}'])
    assert df.select(objects.string_values(F.col("envelope"))).first()[0] == {"a": "1"}
