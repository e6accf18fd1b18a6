"""Page-log flatten, dedup, running profile (both forms), window last."""

import contextlib
import random

import pytest
from pyspark.sql import functions as F

from portrait.operators import profile as P
from portrait.sources.adapters import PAGE_LOG_DDL


def raw(spark, rows):
    return spark.createDataFrame(rows, PAGE_LOG_DDL)


def common(uid, os="iOS 17", ch="a", md="m", ba="b"):
    return (uid, os, ch, md, ba, "1", "v1", "sid", "mid", "0")


def page(item=None, item_type=None):
    return ("home", 10, item, item_type)


def test_flatten_rules(spark):
    rows = [
        (None, page(), 1, 1),                                 # no common: dropped
        (common(None), page("x", "keyword"), 2, 2),           # no uid: '-1', kept
        (common(""), page(), 3, 3),                           # empty uid: dropped
        (common("7", os="Android 13"), page("y", "sku_id"), 4, 4),
    ]
    out = {r.seq: r for r in P.flatten_page_log(raw(spark, rows)).collect()}
    assert set(out) == {2, 4}
    assert out[2].uid == "-1" and out[2].search_item == "x"
    assert out[4].deviceInfo.os == "Android" and out[4].search_item is None
    assert "sid" not in out[4].deviceInfo.asDict() and "is_new" not in out[4].deviceInfo.asDict()


def test_dedup_keeps_first_delivery(spark):
    r = raw(spark, [(common("1"), page(), 5, 9), (common("1"), page(), 5, 3), (common("1"), page(), 6, 4)])
    out = sorted((x.ts, x.seq) for x in P.dedup_exact(P.flatten_page_log(r)).collect())
    assert out == [(5, 3), (6, 4)]


def _random_flat(spark, n=600, hot_share=0.4, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        uid = "hot" if rnd.random() < hot_share else str(rnd.randrange(8))
        os_ = rnd.choice(["iOS 17", "Android 13", "HarmonyOS 4"])
        ch = rnd.choice(["a", "b", None])
        item = rnd.choice([None, "s1", "s2", "口红"])
        rows.append((common(uid, os=os_, ch=ch), page(item, "keyword" if item else None),
                     rnd.randrange(0, 3_000_000), i))
    return P.dedup_exact(P.flatten_page_log(raw(spark, rows)))


@contextlib.contextmanager
def partitions(spark, n):
    """``n`` shuffle partitions that Spark does not put together again."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", [1, 4, 25])
def test_running_profile_in_chunks_equals_one_window(spark, n):
    flat = _random_flat(spark)
    a = sorted(map(tuple, P.running_profile_window(flat).collect()))
    with partitions(spark, n):
        b = P.running_profile(flat)
        assert sorted(map(tuple, b.select(*P.running_profile_window(flat).columns).collect())) == a


def test_every_uid_is_cut_by_rows(spark):
    """A uid with half a hundredth of the rows lies in several tasks."""
    rows = [("small" if i % 200 == 0 else f"u{i % 199}" if i % 2 else "hot", i, i) for i in range(12_000)]
    with partitions(spark, 400):
        chunks = P.row_chunks(spark.createDataFrame(rows, "uid string, ts long, seq long"))
        n = {r.uid: r.n for r in chunks.groupBy("uid").agg(F.countDistinct("_chunk").alias("n")).collect()}
        assert n["small"] >= 2 and n["hot"] >= 150
        assert chunks.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 150


@pytest.mark.parametrize("size", [60_000, 1_000_000])
def test_window_profile_equals_last_of_running(spark, size):
    flat = _random_flat(spark, n=500, seed=5)
    want = P.window_last(P.running_profile_window(flat), size)
    got = P.window_profile(flat, size)
    assert got.columns == ["uid", "window_start", "ts", "seq", "pv", "os", "ch", "md", "ba", "search_item"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_window_profile_latest_matching_term(spark):
    flat = _random_flat(spark, n=300, seed=7).withColumn("known", F.col("search_item").isin("s1", "口红"))
    got = {(r.uid, r.window_start): r.search_term for r in P.window_profile(flat, 60_000, matched="known").collect()}
    latest, want = {}, {}
    for r in sorted(flat.collect(), key=lambda r: (r.uid, r.ts, r.seq)):
        if r.search_item in ("s1", "口红"):
            latest[r.uid] = r.search_item
        want[r.uid, r.ts // 60_000 * 60_000] = latest.get(r.uid)
    assert got == want
    assert P.window_profile(flat.limit(0), 60_000).count() == 0


def test_running_profile_brute_force(spark):
    flat = _random_flat(spark, n=200, seed=11)
    rows = sorted(flat.collect(), key=lambda r: (r.uid, r.ts, r.seq))
    expect, state = {}, {}
    for r in rows:
        pv, sets = state.get(r.uid, (0, {"os": set(), "search_item": set()}))
        pv += 1
        sets["os"].add(r.deviceInfo.os)
        if r.search_item is not None:
            sets["search_item"].add(r.search_item)
        state[r.uid] = (pv, sets)
        expect[r.seq] = (pv, ",".join(sorted(sets["os"])), ",".join(sorted(sets["search_item"])))
    got = {r.seq: (r.pv, r.os, r.search_item)
           for r in P.running_profile(flat).collect()}
    assert got == expect


def test_window_last(spark):
    df = spark.createDataFrame([("1", 1000, 1, 1), ("1", 119_999, 2, 2), ("1", 119_999, 1, 3), ("1", 120_000, 3, 4)],
                               "uid string, ts long, seq long, pv long")
    out = sorted((r.window_start, r.pv) for r in P.window_last(df).collect())
    assert out == [(0, 2), (120_000, 4)]
