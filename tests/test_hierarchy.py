from __future__ import annotations

import random

import pytest

from millrace.operators import hierarchy
from millrace.operators.hierarchy import ancestor_chains, parent_paths, with_parent_path


def edges_of(spark, rows):
    return spark.createDataFrame(rows, "id string, parentid string, cfg_group string")


def brute_path(rows, start, group):
    def parent(i, label=None):
        found = [p for a, p, g in rows if a == i and p is not None and (label is None or g == label)]
        return min(found) if found else None

    if start is None:
        return None
    path, up = [start], parent(start, group)
    while up is not None and up.strip() and up not in path:
        path.append(up)
        up = parent(up)
    return ",".join(path)


FIXTURE = [("c", "b", "CAT"), ("b", "a", "OTHER"), ("a", "", "CAT"), ("z", "y", "OTHER")]


def check(spark, rows, ids, group="CAT"):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    out = with_parent_path(df, "id", edges_of(spark, rows), group)
    assert out.columns == ["id", "path"]
    got = sorted((str(r.id), str(r.path)) for r in out.collect())
    assert got == sorted((str(i), str(brute_path(rows, i, group))) for i in ids)


def test_fixture(spark):
    df = spark.createDataFrame([(i,) for i in "cabzq"] + [(None,)], "id string")
    out = with_parent_path(df, "id", edges_of(spark, FIXTURE), "CAT")
    assert {r.id: r.path for r in out.collect()} == {
        "c": "c,b,a", "a": "a", "b": "b", "z": "z", "q": "q", None: None,
    }
    check(spark, FIXTURE, ["c", "b", "a", "z", "q", None])


def test_default_group_and_many_parents(spark):
    group = hierarchy.FIRST_HOP_GROUP
    rows = [("a", "c", group), ("a", "b", group), ("a", "0", "X"), ("b", " ", "X"), ("b", None, "X")]
    out = parent_paths(edges_of(spark, rows)).collect()
    assert [tuple(r) for r in out] == [("a", "a,b")]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_with_cycles(spark, no_broadcast, monkeypatch, seed, small):
    if not small:
        monkeypatch.setattr(hierarchy, "ROUND_BROADCAST_BYTES", 0)
        monkeypatch.setattr("millrace.lookup.fits_broadcast", lambda df: False)
    rng = random.Random(seed)
    rows = [(str(i), str(rng.randrange(60)), rng.choice(["CAT", "OTHER"])) for i in range(40)]
    rows += [(str(i), str(i + 1), "CAT") for i in range(100, 120)]  # a chain
    rows += [(str(i), "100", "CAT") for i in range(200, 230)]  # a hot parent
    rows += [("300", "301", "CAT"), ("301", "302", "CAT"), ("302", "300", "CAT")]  # a ring
    rows += [("400", "300", "CAT"), ("500", "500", "CAT")]  # into the ring; its own parent
    ids = [r[0] for r in rows] + ["x", None, "100", "100"]
    check(spark, rows, ids)


def test_rounds_follow_the_logarithm_of_the_depth(spark, monkeypatch):
    calls = []
    original = hierarchy.cut_lineage
    monkeypatch.setattr(hierarchy, "cut_lineage", lambda df, label: calls.append(label) or original(df, label))
    nodes = spark.range(200).selectExpr("string(id) id", "if(id > 0, string(id - 1), '') parent")
    chains, _ = ancestor_chains(nodes)
    assert chains.selectExpr("max(size(above))").first()[0] == 199
    assert len(calls) <= 9


def test_hot_id_in_the_rows(spark):
    check(spark, FIXTURE, ["c"] * 300 + ["a"] * 10)
