"""Interval, window and dimension joins: bounds, misses, precedence."""

import random

from pyspark.sql import functions as F

from portrait.operators import joins as J


def test_interval_bounds_inclusive(spark):
    l = spark.createDataFrame([(1, 10_000)], "k long, lt long")
    r = spark.createDataFrame([(1, 10_000 - 86_400_000), (1, 10_000 + 60_000), (1, 10_000 - 86_400_001),
                               (1, 10_000 + 60_001), (2, 10_000)], "k2 long, rt long")
    got = sorted(x.rt for x in J.interval_join(l, r, "k", "k2", "lt", "rt", -86_400_000, 60_000).collect())
    assert got == [10_000 - 86_400_000, 10_000 + 60_000]


def test_interval_bucketed_equals_plain(spark):
    rnd = random.Random(7)
    left = [(rnd.randrange(5), rnd.randrange(0, 10 * 86_400_000)) for _ in range(300)]
    right = [(rnd.randrange(5), rnd.randrange(0, 10 * 86_400_000)) for _ in range(300)]
    l = spark.createDataFrame(left, "k long, lt long")
    r = spark.createDataFrame(right, "k2 long, rt long")
    a = J.interval_join(l, r, "k", "k2", "lt", "rt", -86_400_000, 86_400_000).collect()
    b = J.interval_join(l, r, "k", "k2", "lt", "rt", -86_400_000, 86_400_000, bucket_ms=None).collect()
    brute = [(k, lt, k2, rt) for k, lt in left for k2, rt in right if k == k2 and lt - 86_400_000 <= rt <= lt + 86_400_000]
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == sorted(brute)


def test_interval_timestamps_and_merge(spark):
    l = spark.createDataFrame([(1, "a", 1000)], "id long, name string, ts long").withColumn(
        "t", F.timestamp_millis("ts"))
    r = spark.createDataFrame([(1, "b", 2000)], "uid long, name string, ts long").withColumn(
        "t2", F.timestamp_millis("ts"))
    out = J.interval_join(l, r, "id", "uid", "t", "t2", -5000, 5000, merge="right", time_out="et").first()
    assert out.name == "b" and out.ts == 2000 and out.id == 1
    out = J.interval_join(l, r, "id", "uid", "t", "t2", -5000, 5000, merge="left").first()
    assert out.name == "a" and out.ts == 1000


def test_window_join_edges(spark):
    l = spark.createDataFrame([(1, 59_999), (1, 60_000)], "k long, t long")
    r = spark.createDataFrame([("1", 0), ("1", 119_999)], "u string, t2 long")
    got = sorted((x.window_start, x.result.t, x.Log.t2) for x in J.window_join(l, r, "k", "u", "t", "t2", 60_000).collect())
    assert got == [(0, 59_999, 0), (60_000, 60_000, 119_999)]


def test_dim_join_miss_and_override(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "sku_id long, sku_name string")
    dim = spark.createDataFrame([("1", "real", "t1")], "id string, sku_name string, tm_id string")
    rows = {r.sku_id: r for r in J.dim_join(df, dim, "sku_id", "id", {"sku_name": "sku_name", "tm_id": "tm_id"}).collect()}
    assert rows[1].sku_name == "real" and rows[1].tm_id == "t1"
    assert rows[2].sku_name is None and rows[2].tm_id is None
    assert J.dim_join(df, dim, "sku_id", "id", {"tm_id": "tm_id"}, how="inner").count() == 1


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert J.broadcast_if_small(small) is not small       # hinted
    assert J.broadcast_if_small(small, max_bytes=1) is small  # over the limit: left to the planner


def test_lookup_default_and_strict(spark):
    df = spark.createDataFrame([("low", "18-24"), ("low", "Under 18")], "price_interval string, age_group string")
    from portrait.functions.weights import price_weights
    strict = J.lookup_default(df, price_weights(spark), ["price_interval", "age_group"], "weight", "w")
    assert [float(r.w) for r in strict.collect()] == [0.8]
    soft = J.lookup_default(df, price_weights(spark), ["price_interval", "age_group"], "weight", "w", default="0.5")
    assert sorted(float(r.w) for r in soft.collect()) == [0.5, 0.8]


def test_dimension_miss_at_each_hop(spark):
    from portrait.plans.wide_orders import Dims, sku_dim_chain
    dims = Dims(
        sku=spark.createDataFrame([("1", "s1", "t1", "c3"), ("2", "s2", "tX", "c3"), ("3", "s3", "t1", "c3X"),
                                   ("4", "s4", "t1", "c3b")], "id string, sku_name string, tm_id string, category3_id string"),
        trademark=spark.createDataFrame([("t1", "Brand")], "id string, tm_name string"),
        category3=spark.createDataFrame([("c3", "C3", "c2"), ("c3b", "C3b", "c2X")], "id string, name string, category2_id string"),
        category2=spark.createDataFrame([("c2", "C2", "c1")], "id string, name string, category1_id string"),
        category1=spark.createDataFrame([("c1", "C1")], "id string, name string"))
    lines = spark.createDataFrame([(i, "raw") for i in range(1, 6)], "sku_id long, sku_name string")
    got = {r.sku_id: (r.sku_name, r.tm_name, r.category3_name, r.category2_name, r.category1_name)
           for r in sku_dim_chain(lines, dims).collect()}
    assert got == {
        1: ("s1", "Brand", "C3", "C2", "C1"),
        2: ("s2", None, "C3", "C2", "C1"),        # brand miss
        3: ("s3", "Brand", None, None, None),     # category3 miss: later hops empty
        4: ("s4", "Brand", "C3b", None, None),    # category2 miss
        5: (None, None, None, None, None),        # sku miss
    }
