"""Batch = stream: the streaming runs give the batch rows."""

import os
import tempfile

from pyspark.sql import functions as F

from portrait.operators import profile as P
from portrait.sources.adapters import PAGE_LOG_DDL
from portrait.streaming import stateful as ST
from portrait.streaming.sinks import olap_sink, run_to_completion
from portrait.streaming.sources import read_stream


def _dirs():
    base = tempfile.mkdtemp(prefix="portrait-test-")
    return [os.path.join(base, n) for n in ("in", "out", "ckpt")]


def test_window_last_stream_matches_batch(spark):
    src, out, ck = _dirs()
    rows = [("1", 1000, 1, 1), ("1", 119_999, 2, 2), ("1", 120_000, 3, 3), ("2", 5_000, 4, 1),
            ("9", 10_000_000, 5, 1)]  # the last row closes the earlier windows
    df = spark.createDataFrame(rows, "uid string, ts long, seq long, pv long")
    df.write.parquet(src)
    s = ST.with_event_time(read_stream(spark, "files", path=src, schema=df.schema))
    run_to_completion(ST.window_last_stream(s), sink="parquet", path=out, checkpoint=ck)
    got = sorted(map(tuple, spark.read.parquet(out).select("uid", "window_start", "pv").collect()))
    want = sorted(map(tuple, P.window_last(df).select("uid", "window_start", "pv").collect()))
    assert got == [w for w in want if w[0] != "9"]


def test_dedup_within_watermark(spark):
    src, out, ck = _dirs()
    common = ("1", "iOS 17", "a", "m", "b", "1", "v1", "s", "m", "0")
    rows = [(common, ("home", 1, None, None), 1000, 1), (common, ("home", 1, None, None), 1000, 2)]
    raw = spark.createDataFrame(rows, PAGE_LOG_DDL)
    raw.write.parquet(src)
    flat = ST.with_event_time(P.flatten_page_log(read_stream(spark, "files", path=src, schema=raw.schema)))
    run_to_completion(ST.dedup_stream(flat, watermark="1 minute").drop("deviceInfo"), sink="parquet",
                      path=out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 1


def test_olap_sink_idempotent(spark):
    src, out, ck = _dirs()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.write.parquet(src)
    s = read_stream(spark, "files", path=src, schema=df.schema)
    run_to_completion(s, sink=olap_sink(out), checkpoint=ck)
    f = olap_sink(out)
    f(df, 0)  # a retried batch 0 overwrites its own folder
    assert spark.read.json(out).count() == 2


def test_stream_queries_equal_batch_sql(spark):
    import __spark_entry__ as E
    from oracle_harness import compare, duck
    con = duck("/root/testdata/sf0.001")
    for name in ["stream_profile", "stream_upsert"]:
        r = compare(E.queries()[name](spark, "/root/testdata/sf0.001"), con, E.oracle_sql()[name])
        assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"], (name, r)


def test_late_row_dropped_by_watermark(spark):
    """A row older than the watermark arrives in a later micro-batch: the
    windowed stream drops it (the batch form would keep it).  Spark filters
    late input with the previous batch's watermark, so the late row comes
    two arrivals after the row that moved event time forward."""
    import time
    src, out, ck = _dirs()
    schema = "uid string, ts long, seq long, pv long"
    arrivals = [[("1", 1_000_000, 1, 1), ("1", 5_000_000, 2, 2)],
                [("1", 6_000_000, 3, 3)],
                [("1", 1_010_000, 4, 9), ("1", 9_000_000, 5, 4)]]
    for rows in arrivals:  # the file source orders arrivals by modification time
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    s = ST.with_event_time(read_stream(spark, "files", path=src, schema=schema, max_files_per_trigger=1))
    run_to_completion(ST.window_last_stream(s, watermark="1 minute"), sink="parquet", path=out, checkpoint=ck)
    got = sorted((r.window_start, r.pv) for r in spark.read.parquet(out).collect())
    assert (960_000, 9) not in got and (960_000, 1) in got


def test_interval_join_with_watermarks_equals_batch(spark):
    """Event-time interval join of two streams with watermarks (state
    is bounded) gives the batch rows when nothing arrives late."""
    from portrait.operators.joins import interval_join
    base = tempfile.mkdtemp(prefix="portrait-ij-")
    lrows = [(k, 1_000_000 + 60_000 * i) for i, k in enumerate([1, 2, 1, 3, 2, 1])]
    rrows = [(k, 1_000_000 + 45_000 * i) for i, k in enumerate([1, 1, 2, 3, 3, 2, 1, 2])]
    l = spark.createDataFrame(lrows, "k long, lms long")
    r = spark.createDataFrame(rrows, "k2 long, rms long")
    l.write.parquet(os.path.join(base, "l")); r.write.parquet(os.path.join(base, "r"))
    ls = ST.with_event_time(read_stream(spark, "files", path=os.path.join(base, "l"), schema=l.schema), "lms", "lt")
    rs = ST.with_event_time(read_stream(spark, "files", path=os.path.join(base, "r"), schema=r.schema), "rms", "rt")
    j = interval_join(ls.withWatermark("lt", "10 minutes"), rs.withWatermark("rt", "10 minutes"),
                      "k", "k2", "lt", "rt", -120_000, 60_000)
    out = os.path.join(base, "out")
    run_to_completion(j.select("k", "lms", "rms"), sink="parquet", path=out, checkpoint=os.path.join(base, "ck"))
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted((k, lt, rt) for k, lt in lrows for k2, rt in rrows if k == k2 and lt - 120_000 <= rt <= lt + 60_000)
    assert got == want and len(want) > 0


def _profile_rows(spark, rows, ddl, stream):
    src, out, ck = _dirs()
    schema = spark.createDataFrame([], ddl).schema
    for batch in rows:
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(src)
        import time
        time.sleep(1.1)
    s = read_stream(spark, "files", path=src, schema=schema, max_files_per_trigger=1)
    run_to_completion(stream(s), sink="parquet", path=out, checkpoint=ck)
    return spark.read.parquet(out)


def test_running_windows_stream_adds_sets_and_counts(spark):
    ddl = "uid string, window_start long, ts long, seq long, n long, os array<string>, ch array<string>, md array<string>, ba array<string>, search_item array<string>"
    batches = [[("1", 0, 5, 1, 3, ["iOS"], ["b", "a"], [], ["x"], []), ("2", 0, 6, 2, 1, [], [], [], [], ["ü"])],
               [("1", 240, 250, 5, 1, ["iOS"], ["c"], [], ["x"], ["z"]), ("1", 120, 130, 4, 2, ["Android"], ["a"], ["m"], ["x"], ["é"])]]
    got = _profile_rows(spark, batches, ddl, ST.running_windows_stream)
    assert sorted(map(tuple, got.select("uid", "window_start", "pv", "os", "ch", "md", "search_item").collect())) == [
        ("1", 0, 3, "iOS", "a,b", "", ""), ("1", 120, 5, "Android,iOS", "a,b", "m", "é"), ("1", 240, 6, "Android,iOS", "a,b,c", "m", "z,é"),
        ("2", 0, 1, "", "", "", "ü")]


def test_running_profile_over_batches(spark):
    ddl = "uid string, ts long, seq long, deviceInfo struct<os:string,ch:string,md:string,ba:string>, search_item string"
    batches = [[("1", 5, 1, ("iOS", "a", "m", None), None), ("1", 4, 0, ("iOS", "b", "m", None), "q")], [("1", 9, 2, ("Android", "a", "m", "x"), "q")]]
    got = _profile_rows(spark, batches, ddl, ST.running_profile_stream)
    assert sorted(map(tuple, got.select("seq", "pv", "os", "ch", "ba", "search_item").collect())) == [
        (0, 1, "iOS", "b", "", "q"), (1, 2, "iOS", "a,b", "", "q"), (2, 3, "Android,iOS", "a,b", "x", "q")]


def test_dedup_state_holds_digests(spark):
    """Long records cost state by number, not by length; nulls, texts and
    empty texts differ."""
    from portrait.streaming.sinks import run_stream

    src, out, ck = _dirs()
    ddl = "uid string, ts long, note string, seq long"
    rows = [("1", k, "x" * 5000, k) for k in range(100)] * 2 + [("1", 1, None, 900), ("1", 1, "", 901), ("1", 1, "null", 902), (None, 1, "", 903)]
    spark.createDataFrame([(u, t, n, i) for i, (u, t, n, _) in enumerate(rows)], ddl).coalesce(1).write.parquet(src)
    s = read_stream(spark, "files", path=src, schema=spark.createDataFrame([], ddl).schema)
    q = run_stream(ST.dedup_stream(s), sink="parquet", path=out, checkpoint=ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 104
    state = spark.read.format("statestore").option("path", ck).load()
    assert state.count() == 104 and state.select(F.max(F.octet_length("key._digest"))).first()[0] == 32


def test_a_hot_uid_is_spread_over_slices(spark):
    ddl = "uid string, ts long, seq long, deviceInfo struct<os:string,ch:string,md:string,ba:string>, search_item string"
    batches = [[("hot", 100 * k + b, 100 * b + k, (f"os{k % 3}", "a,b" if k % 2 else None, f"m{k // 20}", "x"), None if k % 7 else f"q{k}") for k in range(60)] for b in range(2)]
    rows = _profile_rows(spark, batches[:1], ddl, lambda s: ST.slice_profile_stream(s, slice_ms=500))
    assert rows.select("slice").distinct().count() == 12  # as many state keys as slices
    assert rows.agg(F.max("pv")).first()[0] == 5
    every = spark.createDataFrame(batches[0], ddl)
    want = P.running_profile_window(every.withColumn("search_item", F.col("search_item")))
    key = lambda df: sorted(map(tuple, df.select("uid", "ts", "seq", "pv", *ST.FIELDS).collect()))
    assert key(ST.with_earlier_slices(rows)) == key(want)


def test_state_entries_are_buckets_not_uids(spark):
    """Python is called, and state read and written, once a bucket."""
    from portrait.streaming.sinks import run_stream

    ddl = "uid string, ts long, seq long, deviceInfo struct<os:string,ch:string,md:string,ba:string>, search_item string"
    rows = [(f"ü{k % 300}", 10 * k, k, (f"os{k % 7}", None, "m\"", "x,y"), None if k % 3 else "\\q") for k in range(1200)]
    every = spark.createDataFrame(rows, ddl)
    key = lambda df: sorted(map(tuple, df.select("uid", "ts", "seq", "pv", *ST.FIELDS).collect()))
    for most, stream, whole in ((8, lambda s: ST.slice_profile_stream(s, slice_ms=6000, buckets=4), ST.with_earlier_slices), (256, ST.running_profile_stream, lambda df: df)):
        src, out, ck = _dirs()
        every.coalesce(1).write.parquet(src)
        q = run_stream(stream(read_stream(spark, "files", path=src, schema=every.schema)), sink="parquet", path=out, checkpoint=ck)
        q.awaitTermination()
        held = max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"])
        assert 0 < held < 300 and (most == 256 or held <= most)
        assert key(whole(spark.read.parquet(out))) == key(P.running_profile_window(every))


def test_page_log_job_takes_a_log_that_is_not_in_order_of_time(spark):
    """Event ids need not follow time: no record may be dropped as late."""
    import datetime

    import __spark_entry__ as E

    sf = tempfile.mkdtemp(prefix="portrait-log-")
    at = datetime.datetime(2024, 1, 1)
    rows = [(100 * c + k, at + datetime.timedelta(minutes=37 * k + c), 10 * c + k % 4, ("view", "click", "purchase")[k % 3], 1.5, '{"k": %d}' % k) for c in range(4) for k in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(os.path.join(sf, "events.parquet"))
    q = E.queries()
    rows_of = lambda name: sorted(map(str, q[name](spark, sf).collect()))
    got = rows_of("stream_page_profile")
    assert got == rows_of("device_score") and len(got) > 150
