from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import clock, objects
from millrace.functions.change import change_type, topic_part
from millrace.functions.net import ip_to_long
from millrace.functions.text import is_not_blank, split_lines, split_tokens

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def expected_tokens(text, delimiter):
    parts = text.split(delimiter)
    if text == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize(
    "text, tokens",
    [("a:b::", ["a", "b"]), (":a", ["", "a"]), (":", []), ("", [""]), ("a", ["a"]), ("a::b", ["a", "", "b"])],
)
def test_split_tokens_fixture(spark, text, tokens):
    assert texts(spark, [text]).select(split_tokens(F.col("v"), ":")).first()[0] == tokens


@QUICK
@given(st.lists(st.text(alphabet="ab: |\n", max_size=12), min_size=1, max_size=30))
def test_split_tokens_agrees_with_python(spark, values):
    for d in ":", " ", "|":
        rows = texts(spark, values).select("v", split_tokens(F.col("v"), d).alias("t")).collect()
        assert [r.t for r in rows] == [expected_tokens(r.v, d) for r in rows]


def test_split_tokens_wants_one_character(spark):
    with pytest.raises(ValueError):
        split_tokens(F.col("v"), "::")


def test_split_tokens_handles_long_runs(spark):
    run = " " * 200_000
    df = texts(spark, [run + "a" + run])
    assert df.select(F.size(split_tokens(F.col("v"), " "))).first()[0] == 200_001


def test_split_lines_as_a_file_scan(spark, tmp_path):
    values = ["a b", "a\n", "a\n\n", "", "a\r\nb", "x\ry", "\n"]
    rows = texts(spark, values).select(split_lines(F.col("v")).alias("l")).collect()
    for i, (value, row) in enumerate(zip(values, rows)):
        path = tmp_path / f"{i}.txt"
        path.write_bytes(value.encode())
        assert row.l == [r.value for r in spark.read.text(str(path)).collect()], repr(value)


def test_blank(spark):
    values = [None, "", "  ", "\t", "\u3000", "\u2003\n", " x ", "\u00a0"]
    rows = texts(spark, values).select(is_not_blank(F.col("v"))).collect()
    assert [r[0] for r in rows] == [False] * 6 + [True] * 2


def test_ip_fixture(spark):
    cases = {
        "1.0.1.0": 16777472,
        "1.0.4.0": 16778240,
        "abc": 0,
        "999.1.0.300": 16760504620,
        None: None,
        "1.2.3": 0,
        "1.2.3.4\n": 0,
        "1.2.3.4444": 0,
        " 1.2.3.4": 0,
        "255.255.255.255": 2**32 - 1,
    }
    rows = texts(spark, list(cases)).select("v", ip_to_long(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in rows} == cases


@QUICK
@given(st.lists(st.tuples(*[st.integers(0, 999)] * 4), min_size=1, max_size=40))
def test_ip_agrees_with_python(spark, octets):
    rows = texts(spark, [".".join(map(str, o)) for o in octets]).select(ip_to_long(F.col("v"))).collect()
    for (a, b, c, d), row in zip(octets, rows):
        assert row[0] == ((((a << 8 | b) << 8) | c) << 8) | d


def test_objects_keep_types_and_drop_nulls(spark):
    df = texts(spark, ['{"Id":1,"DataBase":"a","database":"b","x":null,"n":{"q":[1]},"f":2.5,"t":true}'])
    obj = objects.parse_object(F.col("v"))
    row = df.select(
        objects.to_text(obj).alias("all"),
        objects.get_string(obj, "Id").alias("id"),
        objects.get_string(obj, "database").alias("lower"),
        objects.get_string(obj, "DataBase").alias("upper"),
        objects.get_string(obj, "x").alias("x"),
        objects.get_string(obj, "none").alias("none"),
        objects.get_string(obj, "n").alias("n"),
        objects.to_text(objects.get_object(obj, "n")).alias("inner"),
        objects.to_text(objects.put_string(obj, "Id", F.lit("z"))).alias("put"),
        objects.to_text(objects.put_string(obj, "Id", F.lit(None).cast("string"))).alias("kept"),
        objects.to_text(objects.remove_key(obj, "n")).alias("removed"),
    ).first()
    whole = {"Id": 1, "DataBase": "a", "database": "b", "n": {"q": [1]}, "f": 2.5, "t": True}
    assert json.loads(row["all"]) == json.loads(row.kept) == whole
    assert (row.id, row.lower, row.upper, row.x, row.none, row.n) == ("1", "b", "a", None, None, '{"q":[1]}')
    assert row.inner == '{"q":[1]}'
    assert json.loads(row.put) == {**whole, "Id": "z"}
    assert json.loads(row.removed) == {k: v for k, v in whole.items() if k != "n"}


def test_malformed_object(spark):
    df = texts(spark, ["{", "[1]", "", None])
    assert [r[0] for r in df.select(objects.parse_object(F.col("v"))).collect()] == [None] * 4
    for bad in ("{", "[1]"):
        with pytest.raises(Exception, match="MALFORMED|INVALID_VARIANT_CAST"):
            texts(spark, [bad]).select(objects.parse_object(F.col("v"), strict=True)).collect()


def test_the_last_of_repeated_keys_counts(spark):
    df = texts(spark, ['{"a":1,"a":2}', '{"a":{"b":1,"b":2}}'])
    for strict in (False, True):
        rows = df.select(objects.to_text(objects.parse_object(F.col("v"), strict)).alias("t")).collect()
        assert [r.t for r in rows] == ['{"a":2}', '{"a":{"b":2}}']


def test_quoted_lists(spark):
    obj = objects.parse_object(F.col("v"))
    row = texts(spark, ['{"a":1,"b":"x"}']).select(
        objects.quoted_column_list(obj), objects.quoted_column_list(obj, '"'), objects.quoted_value_list(obj)
    ).first()
    assert tuple(row) == ("`a`,`b`", '"a","b"', "'1','x'")


def test_change_parts(spark):
    ops = ["c", "create", "CREATE", "u", "d", "r", "read", "t", "other", None]
    rows = texts(spark, ops).select(change_type(F.col("v"))).collect()
    assert [r[0] for r in rows] == [
        "insert", "insert", "insert", "update", "delete", "read", "read", "truncate", "other", None,
    ]
    row = texts(spark, ["s.dbo.T"]).select(*[topic_part(F.col("v"), i) for i in range(4)]).first()
    assert tuple(row) == ("s", "dbo", "T", None)


def test_clock(spark):
    now = F.timestamp_millis(F.lit(1704164645678))
    row = spark.range(1).select(
        clock.today_number(now), clock.epoch_millis_text(now), clock.hour_stamp(now)
    ).first()
    assert tuple(row) == (20240102, "1704164645678", "2024-01-02-03")


def test_on_day_is_half_open_and_pushed(spark, tmp_path, plan):
    rows = [(dt.datetime(2024, 1, d, h),) for d in (1, 2, 3) for h in (0, 23)]
    spark.createDataFrame(rows, "ts timestamp").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(clock.on_day("ts", 20240102))
    assert sorted(r.ts.hour for r in df.collect()) == [0, 23]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(df)


def test_day_zero_is_today(spark):
    df = spark.range(1).select(F.current_timestamp().alias("ts"))
    assert df.filter(clock.on_day("ts", 0)).count() == 1
