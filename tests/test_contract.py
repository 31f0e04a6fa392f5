from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
from millrace.plans import oracles, registered, registered_growth  # noqa: E402

CORE = {**registered.ALL, **registered_growth.ALL}

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(registered.ALL) == set(oracles.ALL)
    assert set(registered_growth.ALL) == set(registered_growth.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note
