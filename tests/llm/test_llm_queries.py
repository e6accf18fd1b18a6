import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from portrait.llm import queries


def test_every_operator_has_a_query():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.REGISTRY}
    assert set(queries.REGISTRY) | {"pipeline"} <= names
    assert set(queries.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    r = compare(E.queries()[name](spark, sf), duck(sf), E.oracle_sql()[name])
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"], r


def test_workers_need_no_package(spark):
    """Functions of the subpackage travel by value."""
    from pyspark import cloudpickle

    from portrait.llm import quality

    assert b"text_counts" in cloudpickle.dumps(quality.text_counts) and len(cloudpickle.dumps(quality.text_counts)) > 1000
