"""Driver contract: entry() runs; every registered query equals its SQL
oracle (run here on sf0.001; the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from portrait.queries import REGISTRY

SF = "/root/testdata/sf0.001"
FAST = [n for n in REGISTRY if not n.startswith("stream_")]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "new_ageGroup" in df.columns
    assert df.count() >= 0


def test_every_query_has_sql():
    missing = set(REGISTRY) - set(E.oracle_sql())
    assert not missing, missing


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    r = compare(REGISTRY[name](spark, SF), con, E.oracle_sql()[name])
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"], r
