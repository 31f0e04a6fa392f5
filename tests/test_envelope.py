from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import envelope as env
from millrace.operators import projections as prj

TOPIC = "srv.dbo.T"


def record(op, before=None, after=None, db="shop"):
    return json.dumps({"before": before, "after": after, "source": {"db": db}, "op": op})


FIXTURE = [
    (record("c", after={"Id": 1, "Name": "a"}),
     {"database": "shop", "table": "T", "Id": 1, "Name": "a", "type": "insert"},
     {"database": "shop-dbo", "table": "T", "data": {"Id": 1, "Name": "a"}, "type": "insert"}),
    (record("u", {"Id": 1, "Name": "a"}, {"Id": 1, "Name": None}),
     {"database": "shop", "table": "T", "Id": 1, "type": "update"},
     {"database": "shop-dbo", "table": "T", "data": {"Id": 1}, "type": "update"}),
    (record("d", {"Id": 1}),
     {"database": "shop", "table": "T", "Id": 1, "type": "delete"},
     {"database": "shop-dbo", "table": "T", "data": {"Id": 1}, "type": "delete"}),
    (record("r", after={"Id": 2}),
     {"database": "shop", "table": "T", "Id": 2, "type": "read"},
     {"database": "shop-dbo", "table": "T", "data": {"Id": 2}, "type": "read"}),
    (record("c", after={"database": "C", "type": "X"}),
     {"database": "C", "table": "T", "type": "insert"},
     {"database": "shop-dbo", "table": "T", "data": {"database": "C", "type": "X"}, "type": "insert"}),
    (record("c", after={"database": None, "table": "U"}),
     {"table": "U", "type": "insert"},
     {"database": "shop-dbo", "table": "T", "data": {"table": "U"}, "type": "insert"}),
    (record("t"),
     {"database": "shop", "table": "T", "type": "truncate"},
     {"database": "shop-dbo", "table": "T", "type": "truncate"}),
]


def frame(spark, values, topic=TOPIC):
    return spark.createDataFrame([(topic, v) for v in values], "topic string, value string").coalesce(1)


@pytest.mark.parametrize("shape, index", [(env.flat_envelope, 1), (env.nested_envelope, 2)])
def test_fixture(spark, shape, index):
    df = frame(spark, [f[0] for f in FIXTURE])
    out = env.envelope_text(shape(env.read_records(df))).collect()
    assert [json.loads(r.body) for r in out] == [f[index] for f in FIXTURE]


def test_each_record_is_parsed_once(spark, tmp_path, plan):
    frame(spark, [f[0] for f in FIXTURE]).write.parquet(str(tmp_path / "m"))
    df = spark.read.parquet(str(tmp_path / "m"))
    text = env.envelope_text(env.flat_envelope(env.read_records(df))).select("body")
    assert plan(text).count("parseJson") == 1


def test_unreadable_records_are_set_aside(spark):
    good = record("c", after={"Id": 1})
    bad = ["junk", record(None, after={}), '{"op":"c"}', None]
    df = frame(spark, [good, *bad]).union(frame(spark, [good], "short.topic"))
    records = env.read_records(df)
    assert env.flat_envelope(records).count() == 1
    aside = env.quarantine(records)
    assert aside.columns == ["topic", "value"] and aside.count() == 5
    texts = [json.loads(r.body) for r in env.quarantine_text(records).collect()]
    assert {"topic": TOPIC, "value": "junk"} in texts and {"topic": TOPIC} in texts


def test_the_last_of_repeated_keys_counts(spark):
    twice = '{"op":"c","after":{"a":1,"b":3,"a":2},"source":{"db":"x"}}'
    out = env.envelope_text(env.flat_envelope(env.read_records(frame(spark, [twice])))).first()
    assert json.loads(out.body) == {"database": "x", "table": "T", "a": 2, "b": 3, "type": "insert"}


def test_malformed_envelopes_keep_their_text(spark):
    df = env.parse_envelope(spark.createDataFrame([("not json",), ('{"a":1}',), (None,)], "value string"))
    assert [r.body for r in env.envelope_text(df, text="value").collect()] == ["not json", '{"a":1}', None]


def test_no_data_is_no_fact(spark):
    texts = spark.createDataFrame([("not json",), ('{"type":"insert"}',), ('{"data":{"id":"1"}}',), (None,)], "body string")
    assert [r.id for r in prj.typed_rows(texts, "body").collect()] == ["1"]
    assert prj.without_data(texts, "body").count() == 3
    nested = env.nested_envelope(env.read_records(frame(spark, [record("t"), record("c", after={"id": 5})])))
    assert [r.id for r in prj.typed_rows(nested).collect()] == ["5"]
    assert prj.without_data(nested).count() == 1


def test_strict_mode_fails(spark):
    for value in ("junk", '{"op":"c"}'):
        with pytest.raises(Exception, match="MALFORMED|unusable"):
            env.flat_envelope(env.read_records(frame(spark, [value]), strict=True)).collect()


def test_id_projection_and_suffix(spark):
    df = frame(spark, [record("c", after={"Id": 7}), record("c", after={"x": 1})])
    ids = prj.id_only(env.flat_envelope(env.read_records(df)))
    assert [r.body for r in ids.collect()] == ['{"id":"7"}', "{}"]
    suffixed = env.envelope_text(prj.suffix_id(env.parse_envelope(ids.select("body"), "body")), out="body")
    assert [r.body for r in suffixed.collect()] == ['{"id":"7f"}', '{"id":"nullf"}']


def test_typed_rows(spark):
    now = F.timestamp_millis(F.lit(1704164645000))
    values = [
        record("c", after={"id": "a", "total_amount": 5, "tm": "X"}),
        record("c", after={"id": 3, "total_amount": "12", "pro_cnt": 2.9, "is_new": "1"}),
        record("c", after={"id": "n", "total_amount": None, "pro_cnt": ""}),
    ]
    nested = env.nested_envelope(env.read_records(frame(spark, values)))
    known = env.nested_envelope(env.read_records(frame(spark, values), image=prj.FACT_IMAGE))
    want = [("a", 5, None, 0, "X"), ("3", 12, "1", 2, None), ("n", 0, None, 0, None)]
    for df in (
        prj.typed_rows(nested, now=now),
        prj.typed_rows(known, now=now),
        prj.typed_rows(env.envelope_text(known), "body", now=now),
        prj.typed_rows(env.envelope_text(nested), "body", now=now),
    ):
        rows = df.collect()
        assert [tuple(r)[:5] for r in rows] == want
        assert {r.date.year for r in rows} == {2024}
        assert df.schema.simpleString() == f"struct<{','.join(c.strip().replace(' ', ':') for c in prj.FACT_TYPE.split(','))}>"
    with pytest.raises(Exception, match="CAST"):
        bad = frame(spark, [record("c", after={"total_amount": "abc"})])
        prj.typed_rows(env.nested_envelope(env.read_records(bad))).collect()


def test_flatten(spark):
    df = frame(spark, [record("c", after={"Id": 1, "Age": 30, "Name": "a"})])
    row = prj.flatten(env.nested_envelope(env.read_records(df))).first()
    assert tuple(row) == ("shop-dbo", "1", 30, "a", "insert", "T")


def test_rewrite_event_fixture(spark):
    now = F.timestamp_millis(F.lit(99))
    rows = [
        ('{"table":"T","ModifyTime":"17","Id":1}', {"k": "v", "table": "old"}),
        ('{"table":"T","Id":1}', {}),
    ]
    df = spark.createDataFrame(rows, "body string, headers map<string,string>").coalesce(1)
    out = prj.rewrite_event(df, now=now, headers="headers").collect()
    assert out[0].headers == {"k": "v", "timestamp": "17", "table": "T"}
    assert json.loads(out[0].body) == {"ModifyTime": "17", "Id": 1}
    assert out[1].headers == {"timestamp": "99", "table": "T"}
    assert json.loads(out[1].body) == {"Id": 1}


def test_malformed_bodies_are_kept(spark):
    df = spark.createDataFrame([("{oops",), ('{"table":"T"}',)], "body string").coalesce(1)
    out = prj.rewrite_event(df, now=F.timestamp_millis(F.lit(99))).collect()
    assert out[0].body == "{oops" and out[0].headers == {"timestamp": "99", "table": None}
    assert out[1].body == "{}"
    parsed = env.parse_envelope(df, "body")
    assert [r.body for r in env.unparsed(parsed, "body").collect()] == ["{oops"]


def test_drop_transient_keeps_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    marked = df.to(prj.mark_transient(df.schema, ["b"]))
    assert prj.drop_transient(marked).columns == ["a", "c"]
    assert prj.drop_transient(marked, ["c"]).columns == ["a"]


def test_record_text_and_pairs(spark):
    df = spark.createDataFrame([(b"a:b",)], "value binary")
    words = prj.tokens(prj.record_text(df), "value", ":")
    assert [tuple(r) for r in prj.paired(words).collect()] == [("a", 1), ("b", 1)]
