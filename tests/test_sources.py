"""Database readers (re-aimed, injected readers) and dimension plug-ins."""

from pyspark.sql import functions as F

from portrait.operators.dims import DimSpec, RefreshingDim, enrich, enrich_batches
from portrait.sources import jdbc


def test_read_query_labels_and_camel(spark):
    def fake():
        return spark.createDataFrame([(1, "a")], "id int, category_name string")
    df = jdbc.read_query(spark, "jdbc:none", "select ...", reader=fake, underline_to_camel=True)
    assert df.columns == ["id", "categoryName"]


def test_snapshot_changes(spark):
    df = spark.createDataFrame([(1, "x")], "id long, name string")
    r = jdbc.snapshot_changes(df, "user_info", ts_ms=5).first()
    assert r.op == "r" and r.after == {"id": "1", "name": "x"} and r.source.table == "user_info" and r.ts_ms == 5


def test_enrich_specs(spark):
    facts = spark.createDataFrame([(1, "t1"), (2, "t9")], "id long, tm_id string")
    tm = spark.createDataFrame([("t1", "Brand")], "id string, tm_name string")
    out = {r.id: r.tm_name for r in enrich(facts, [DimSpec("tm", "tm_id", {"tm_name": "tm_name"})], {"tm": tm}).collect()}
    assert out == {1: "Brand", 2: None}


def test_refreshing_dim_ttl(spark):
    now = [0.0]
    calls = []

    def load(s):
        calls.append(1)
        return s.createDataFrame([("t1", f"v{len(calls)}")], "id string, tm_name string")

    dim = RefreshingDim(load, ttl_seconds=10, clock=lambda: now[0])
    got = []
    fn = enrich_batches([DimSpec("tm", "tm_id", {"tm_name": "tm_name"})], {"tm": dim},
                        lambda df, b: got.append(df.first().tm_name))
    batch = spark.createDataFrame([(1, "t1")], "id long, tm_id string")
    fn(batch, 0); now[0] = 5; fn(batch, 1); now[0] = 11; fn(batch, 2)
    assert got == ["v1", "v1", "v2"] and dim.loads == 2
