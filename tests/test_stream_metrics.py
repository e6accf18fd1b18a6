"""Metrics on a stream: flags, slots, retraction, state that goes."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare, duck
from portrait.operators import metrics as M
from portrait.sources.adapters import PAGE_LOG_DDL
from portrait.streaming import metrics as SM
from portrait.streaming import stateful as ST
from portrait.streaming.sinks import run_stream, run_to_completion
from portrait.streaming.sources import read_stream

HOUR = 3_600_000
SF = "/root/testdata/sf0.001"


def record(uid, ts, seq, page="home", sid="s", item_type=None):
    return ((uid, "iOS 17", "a", "m", "b", "1", "v1", sid, "m", "0"), (page, 1, None, item_type), ts, seq)


def arrivals(spark, rows_of, schema):
    """A stream whose micro-batches are the given lists of rows, and folders."""
    base = tempfile.mkdtemp(prefix="portrait-metrics-")
    src = os.path.join(base, "in")
    for rows in rows_of:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # the file source orders arrivals by modification time
    s = read_stream(spark, "files", path=src, schema=spark.createDataFrame(rows_of[0], schema).schema, max_files_per_trigger=1)
    return s, os.path.join(base, "out"), os.path.join(base, "ckpt")


@pytest.mark.parametrize("name", ["stream_metric_traffic", "stream_metric_home_detail", "stream_metric_cart", "stream_metric_sku", "stream_metric_login", "stream_metric_payment"])
def test_stream_equals_batch_sql(spark, name):
    r = compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"] > 0, r


def test_flags_of_slots_add_up_to_the_day(spark):
    rows = [[record("1", 1 * HOUR, 1), record("2", 1 * HOUR, 2)], [record("1", 5 * HOUR, 3), record("3", 5 * HOUR, 4, sid=None)], [record("1", 26 * HOUR, 5)]]
    s, out, ck = arrivals(spark, rows, PAGE_LOG_DDL)
    run_to_completion(SM.traffic_stream(s, slot_ms=HOUR), sink=SM.report_sink(out), output_mode="update", checkpoint=ck)
    got = {r["stt"] // HOUR: (r["uv_ct"], r["sv_ct"], r["pv_ct"]) for r in SM.read_report(spark, out, ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new"]).collect()}
    assert got == {1: (2, 1, 2), 5: (1, 0, 2), 26: (1, 1, 1)}


def test_a_report_moves_while_the_day_goes_on(spark):
    rows = [[record("1", HOUR, 1, item_type="sku_id")], [record("1", 2 * HOUR, 2, item_type="sku_id"), record("2", 2 * HOUR, 3, item_type="sku_id"), record("", 2 * HOUR, 4, item_type="sku_id")]]
    s, out, ck = arrivals(spark, rows, PAGE_LOG_DDL)
    run_to_completion(SM.cart_add_stream(s), sink=SM.report_sink(out), output_mode="update", checkpoint=ck)
    assert [r[0] for r in spark.read.parquet(out).orderBy("batch_id").select("cart_add_uu_ct").collect()][:2] == [1, 2]
    assert [r["cart_add_uu_ct"] for r in SM.read_report(spark, out, ["stt", "edt", "cur_date"]).collect()] == [2]


def test_state_of_a_day_goes_with_the_watermark(spark):
    rows = [[record(str(i), HOUR, i) for i in range(50)], [record("1", 30 * HOUR, 60)], [record("1", 31 * HOUR, 61)]]
    s, out, ck = arrivals(spark, rows, PAGE_LOG_DDL)
    q = run_stream(SM.home_detail_stream(s), sink=SM.report_sink(out), output_mode="update", checkpoint=ck)
    q.awaitTermination()
    held = [[o["numRowsTotal"] for o in p["stateOperators"]] for p in q.recentProgress if p["stateOperators"]]
    assert max(map(max, held)) >= 50 and max(held[-1]) <= 2


LINES = "id string, ts_ms long, pos long, sku_id string, original_cents long, activity_cents long, coupon_cents long"


def deltas(spark, batches):
    s, out, ck = arrivals(spark, batches, LINES)
    run_to_completion(SM.sku_deltas(s), sink="parquet", path=out, checkpoint=ck)
    return spark.read.parquet(out)


def test_a_later_delivery_takes_the_old_amounts_back(spark):
    day = M.DAY_MS
    batches = [[("a", 10, 0, "x", 100, 1, 2), ("b", 10, 0, "x", 50, 0, 0), ("a", 10, 0, "x", 100, 1, 2)],
               [("a", 10, 1, "x", 300, 3, 4)],
               [("a", 5, 9, "x", 7, 7, 7), ("b", day + 1, 0, "y", 60, 0, None)]]
    got = deltas(spark, batches)
    sums = got.groupBy((F.col("ts_ms") / day).cast("int").alias("d"), "sku_id").agg(*[F.sum(c).alias(c) for c in (*SM.CENTS, "n_lines")]).where("n_lines > 0")
    assert {tuple(r) for r in sums.collect()} == {(0, "x", 300, 3, 4, 1), (1, "y", 60, 0, 0, 1)}
    assert got.where("n_lines < 0").count() == 2
    rows = spark.createDataFrame([r for b in batches for r in b], LINES).fillna(0)
    latest = rows.groupBy("id").agg(F.max_by(F.struct("sku_id", "original_cents"), F.struct("ts_ms", "pos")).alias("l")).select("l.*")
    assert sorted(map(tuple, latest.collect())) == [("x", 300), ("y", 60)]


def test_a_day_that_all_lines_have_left_is_no_row(spark):
    got = deltas(spark, [[("a", 10, 0, "x", 100, 0, 0)], [("a", M.DAY_MS + 10, 0, "x", 100, 0, 0)]])
    one = lambda *c: spark.createDataFrame([], ", ".join(f"{x} string" for x in c))
    from portrait.plans.wide_orders import Dims
    dims = Dims(one("id", "sku_name", "tm_id", "category3_id"), one("id", "tm_name"), one("id", "name", "category2_id"), one("id", "name", "category1_id"), one("id", "name"))
    assert [r["stt"] for r in SM.sku_report(got, dims).collect()] == [M.DAY_MS]


def test_days_that_arrive_late_change_their_neighbours(spark):
    day = M.DAY_MS
    rows = [[record("1", 0, 1), record("1", 20 * day, 2), record("2", 3 * day, 3)], [record("1", 15 * day, 4), record("2", 3 * day + 5, 5)], [record("1", 2 * day, 6)]]
    s, out, ck = arrivals(spark, rows, PAGE_LOG_DDL)
    run_to_completion(SM.login_deltas(s, back_days=8, watermark="100 days"), sink="parquet", path=out, checkpoint=ck)
    got = SM.day_report(spark.read.parquet(out), "uu_ct", "back_ct").select("stt", "uu_ct", "back_ct")
    every = spark.createDataFrame([r for b in rows for r in b], PAGE_LOG_DDL)
    want = M.login(every, back_days=8).select("stt", "uu_ct", "back_ct")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(out).where("flagged < 0").count() == 1  # day 20 follows day 15 now


def test_first_payment_moves_to_an_earlier_day(spark):
    day = M.DAY_MS
    ddl = "user_id long, ts_ms long"
    batches = [[(1, 9 * day), (2, 9 * day), (None, 9 * day)], [(1, 4 * day), (2, 10 * day)]]
    s, out, ck = arrivals(spark, batches, ddl)
    run_to_completion(SM.payment_deltas(s, watermark="100 days"), sink="parquet", path=out, checkpoint=ck)
    got = SM.day_report(spark.read.parquet(out), "payment_uu_ct", "new_payer_ct")
    want = M.payment(spark.createDataFrame([r for b in batches for r in b], ddl))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_state_entries_are_buckets_not_users_or_lines(spark):
    """A call into Python for each bucket: thousands of keys are few groups."""
    day = M.DAY_MS
    for stream, rows, ddl in ((SM.payment_deltas, [(k % 6000, (k % 7) * 100) for k in range(7000)], "user_id long, ts_ms long"),
                              (SM.sku_deltas, [(f"l{k}", 10, 0, None if k % 5 else "x", 1, 2, 3) for k in range(6000)], LINES)):
        s, out, ck = arrivals(spark, [rows], ddl)
        q = run_stream(stream(s), sink="parquet", path=out, checkpoint=ck)
        q.awaitTermination()
        held = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"] if o["operatorName"] == "applyInPandasWithState"]
        assert 0 < max(held) <= ST.STATE_BUCKETS
        got = spark.read.parquet(out)
        if "users" in got.columns:
            assert tuple(got.agg(F.sum("users"), F.sum("flagged")).first()) == (6000, 6000) and [r[0] for r in got.select("day_ms").distinct().collect()] == [0 * day]
        else:
            assert {tuple(r) for r in got.groupBy("sku_id").agg(F.sum("n_lines"), F.sum("original_cents")).collect()} == {(None, 4800, 4800), ("x", 1200, 1200)}


def test_ids_longer_than_a_double_and_null_skus(spark):
    big = (1 << 62) + 1
    ddl = LINES.replace("id string, ts_ms", "id long, ts_ms").replace("sku_id string", "sku_id long")
    s, out, ck = arrivals(spark, [[(big, 10, 0, big, 5, 0, 0), (big + 1, 10, 0, None, 6, 0, 0)], [(big, 11, 0, big + 2, 7, 0, 0)]], ddl)
    run_to_completion(SM.sku_deltas(s), sink="parquet", path=out, checkpoint=ck)
    got = spark.read.parquet(out).groupBy("sku_id").agg(F.sum("original_cents"), F.sum("n_lines"))
    assert {tuple(r) for r in got.collect()} == {(big, 0, 0), (big + 2, 7, 1), (None, 6, 1)}
