from __future__ import annotations

import json
import random

import pytest

from pyspark.sql import functions as F

from millrace import lookup
from millrace.operators import envelope as env
from millrace.operators.enrich import attach, enrich, latest_dims
from millrace.operators.union import union_all
from millrace.streaming import jobs


def objects_of(spark, bodies):
    rows = [(json.dumps(b), i) for i, b in enumerate(bodies)]
    return env.parse_envelope(spark.createDataFrame(rows, "value string, seq long"))


def ordered(bodies):
    return sorted(bodies, key=lambda b: json.dumps(b, sort_keys=True))


def out_of(df):
    return ordered(json.loads(r.body) for r in env.envelope_text(df).collect())


FEED = [
    {"DataBase": "shop", "guid": "G0", "type": "insert"},
    {"DataBase": "shop", "guid": "G1", "type": "update"},
    {"db_name": "shop", "tenant_id": 9, "type": "insert"},
    {"guid": "lost", "type": "insert"},
]


def test_fixture(spark):
    facts = objects_of(spark, [{"database": "shop", "Id": 1}, {"database": "other", "Id": 2}, {"Id": 3}])
    dims = latest_dims(objects_of(spark, FEED))
    same = [{"database": "other", "Id": 2}, {"Id": 3}]
    two = ordered([{"database": "G1", "tenantid": "9", "Id": 1}, *same])
    one = ordered([{"database": "G1", "Id": 1}, *same])
    for small in (True, False):
        assert out_of(enrich(facts, dims, small=small)) == two
        assert out_of(enrich(facts, dims, tenant=False, small=small)) == one


def test_latest_value_wins_and_null_unmaps(spark):
    feed = FEED + [{"DataBase": "b", "guid": "x"}, {"DataBase": "b", "guid": None}]
    dims = {r.database: (r.guid, r.tenantid) for r in latest_dims(objects_of(spark, feed)).collect()}
    assert dims == {"shop": ("G1", "9")}


def test_deletes(spark):
    feed = FEED + [{"DataBase": "shop", "guid": "G1", "type": "delete"}]
    kept = latest_dims(objects_of(spark, feed)).first()
    assert (kept.guid, kept.tenantid) == ("G1", "9")
    honored = latest_dims(objects_of(spark, feed), honor_deletes=True).first()
    assert (honored.guid, honored.tenantid) == (None, "9")


def test_key_kinds_do_not_collide(spark):
    feed = [{"DataBase": "x_db", "guid": "G"}, {"db_name": "x", "tenant_id": "T"}]
    facts = objects_of(spark, [{"database": "x"}, {"database": "x_db"}])
    assert out_of(enrich(facts, latest_dims(objects_of(spark, feed)))) == ordered(
        [{"database": "G"}, {"database": "x", "tenantid": "T"}]
    )


@pytest.mark.parametrize("small", [True, False])
def test_hot_key_and_null_keys_against_brute_force(spark, no_broadcast, small):
    rng = random.Random(5)
    keys = ["hot"] * 400 + [None] * 400 + [f"k{rng.randrange(60)}" for _ in range(400)]
    table = {f"k{i}": f"v{i}" for i in range(40)} | {"hot": "vh"}
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    dims = spark.createDataFrame(list(table.items()), "k string, v string")
    got = lookup.lookup_join(facts, dims, "k", small=small).collect()
    assert sorted((r.i, r.k, r.v) for r in got) == sorted(
        ((i, k, table.get(k)) for i, k in enumerate(keys)), key=lambda x: x[0]
    )


def test_hot_keys_are_exact_and_few(spark):
    facts = spark.range(4000).selectExpr("if(id % 2 = 0, 'hot', if(id % 4 = 1, null, 'k' || id)) as k", "id")
    hot = lookup.hot_keys(facts, "k").collect()
    assert [r.k for r in hot] == ["hot"]
    assert 600 < hot[0]._slots <= 1000
    assert lookup.hot_keys(facts.limit(0), "k").count() == 0


def test_hot_rows_are_spread_even_when_all_alike(spark, no_broadcast):
    facts = spark.range(0, 20000, 1, 40).selectExpr("'hot' as k", "'same' as p")
    dims = spark.createDataFrame([("hot", "v")], "k string, v string")
    slots = facts.withColumn("n", F.pmod(lookup._row_number(facts), F.lit(1000)))
    assert slots.select("n").distinct().count() > 30
    joined = lookup.lookup_join(facts, dims, "k", small=False)
    assert joined.groupBy("v").count().collect() == [("v", 20000)]


def test_lookup_on_a_stream(spark, tmp_path):
    spark.range(100).selectExpr("if(id % 3 = 0, null, id % 7) k", "id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, id long").parquet(str(tmp_path / "in"))
    dims = spark.range(5).selectExpr("id as k", "'v' || id as v")
    with pytest.raises(ValueError, match="foreachBatch"):
        lookup.lookup_join(stream, dims, "k", small=False)
    in_batches = jobs.overwrite_batch(str(tmp_path / "oFalse"))
    for small in (True, False):
        path, ck = str(tmp_path / f"o{small}"), str(tmp_path / f"c{small}")
        if small:
            writer = lookup.lookup_join(stream, dims, "k", small=True).writeStream.format("parquet").option("path", path)
        else:
            writer = jobs.per_batch(stream, lambda b, i: in_batches(lookup.lookup_join(b, dims, "k", small=False), i))
        jobs.run(writer, jobs.StreamSettings(ck))
        rows = spark.read.parquet(path).collect()
        assert len(rows) == 100
        assert all(r.v == (f"v{r.k}" if r.k is not None and r.k < 5 else None) for r in rows)


def test_hot_envelopes_take_many_slots(spark, no_broadcast):
    rows = spark.range(0, 20000, 1, 4).selectExpr("""'{"database":"shop","Id":' || id || '}' as value""")
    facts = env.parse_envelope(rows).select("envelope").withColumn("_db", F.lit("shop"))
    slots = facts.select(F.pmod(lookup._row_number(facts), F.lit(1000)).alias("n")).groupBy("n").count()
    counts = [r["count"] for r in slots.collect()]
    assert len(counts) > 900 and max(counts) < 60
    dims = spark.createDataFrame([("shop", "G", "T")], "database string, guid string, tenantid string")
    out = env.envelope_text(enrich(facts.select("envelope"), dims, small=False))
    assert out.select(F.get_json_object("body", "$.database").alias("d")).groupBy("d").count().collect() == [("G", 20000)]


def test_size_is_measured(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) as t", "array('ab') as a")
    rows, size = lookup.measured_size(df)
    assert rows == 100 and size >= 100 * 100
    assert lookup.fits_broadcast(df)
    assert not lookup.fits_broadcast(df, max_rows=99)
    assert not lookup.fits_broadcast(df, max_bytes=5000)


def test_plans(spark, no_broadcast, plan):
    facts = spark.createDataFrame([("a",)], "database string")
    dims = spark.createDataFrame([("a", "g", "t")], "database string, guid string, tenantid string")
    assert "BroadcastHashJoin" in plan(attach(facts, dims, "database"))
    large = plan(attach(facts, dims, "database", small=False))
    assert "SortMergeJoin" in large and "BroadcastNestedLoopJoin" not in large


def test_union(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    assert sorted(map(tuple, union_all([a, b, a]).collect())) == [(1, "x")] * 3
    empty = union_all([], spark, "a int")
    assert empty.columns == ["a"] and empty.count() == 0
    with pytest.raises(ValueError):
        union_all([])
