"""Operators against small Python models on random input."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import envelope as env
from millrace.operators.enrich import enrich, latest_dims

QUICK = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

VALUES = st.one_of(st.none(), st.integers(-9, 9), st.text("ab\"\\é", max_size=3), st.booleans())
IMAGES = st.none() | st.dictionaries(st.sampled_from(["database", "table", "type", "a", "A", "b"]), VALUES)
OPS = st.sampled_from(["c", "u", "d", "r"])
NAMES = {"c": "insert", "u": "update", "d": "delete", "r": "read"}


def without_nulls(row):
    return {k: v for k, v in row.items() if v is not None}


def flat_model(before, after, op):
    image = after if after is not None else before
    out = {"database": "db", "table": "T"}
    out.update(image or {})
    out["type"] = NAMES[op]
    return without_nulls(out)


def nested_model(before, after, op):
    image = after if after is not None else before
    out = {"database": "db-dbo", "table": "T", "type": NAMES[op]}
    return out if image is None else {**out, "data": without_nulls(image)}


@QUICK
@given(st.lists(st.tuples(IMAGES, IMAGES, OPS), min_size=1, max_size=40))
def test_envelopes(spark, records):
    rows = [
        (i, "s.dbo.T", json.dumps({"before": b, "after": a, "source": {"db": "db"}, "op": op}))
        for i, (b, a, op) in enumerate(records)
    ]
    df = env.read_records(spark.createDataFrame(rows, "i int, topic string, value string"))
    for shape, model in ((env.flat_envelope, flat_model), (env.nested_envelope, nested_model)):
        out = env.envelope_text(shape(df)).orderBy("i").collect()
        assert [json.loads(r.body) for r in out] == [model(*r) for r in records]


KEYS = st.sampled_from(["a", "b", "a_db", "c"])
WRITES = st.fixed_dictionaries(
    {},
    optional={
        "DataBase": KEYS,
        "guid": st.none() | st.sampled_from(["g1", "g2"]),
        "db_name": KEYS,
        "tenant_id": st.none() | st.integers(1, 3),
        "type": st.sampled_from(["insert", "update", "delete"]),
    },
)
FACTS = st.fixed_dictionaries({"Id": st.integers(0, 9)}, optional={"database": KEYS, "tenantid": st.just("own")})


def enrich_model(feed, facts, honor):
    guid, tenant = {}, {}
    for w in feed:
        gone = honor and w.get("type") == "delete"
        if w.get("DataBase") is not None:
            guid[w["DataBase"]] = None if gone else w.get("guid")
        if w.get("db_name") is not None:
            value = w.get("tenant_id")
            tenant[w["db_name"]] = None if gone or value is None else str(value)
    out = []
    for fact in facts:
        row, db = dict(fact), fact.get("database")
        if guid.get(db) is not None:
            row["database"] = guid[db]
        if tenant.get(db) is not None:
            row["tenantid"] = tenant[db]
        out.append(row)
    return out


def objects_of(spark, bodies):
    rows = [(json.dumps(b), i) for i, b in enumerate(bodies)]
    return env.parse_envelope(spark.createDataFrame(rows, "value string, seq long"))


def ordered(bodies):
    return sorted(json.dumps(b, sort_keys=True) for b in bodies)


@QUICK
@given(
    st.lists(WRITES, min_size=1, max_size=20),
    st.lists(FACTS, min_size=1, max_size=20),
    st.booleans(),
    st.booleans(),
)
def test_enrichment(spark, feed, facts, honor, small):
    dims = latest_dims(objects_of(spark, feed), honor_deletes=honor)
    out = env.envelope_text(enrich(objects_of(spark, facts), dims, small=small)).collect()
    assert ordered(json.loads(r.body) for r in out) == ordered(enrich_model(feed, facts, honor))
