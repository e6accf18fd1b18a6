"""Sink shapes: Kafka value, per-topic folders, text lines, window reduce."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from portrait.operators.profile import reduce_by_window
from portrait.streaming.sinks import kafka_value, read_upsert_snapshot, text_sink, topic_sink, upsert_stream
from portrait.streaming.sources import read_stream


def test_kafka_value_shape(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    r = kafka_value(df, key="id").first()
    assert json.loads(r.value) == {"id": 1, "v": "a"} and r.key == "1"


def test_topic_and_text_sinks(spark):
    base = tempfile.mkdtemp(prefix="portrait-sink-")
    src = os.path.join(base, "in")
    df = spark.createDataFrame([("dim_user", 1), ("dim_order", 2)], "t string, id int")
    df.write.parquet(src)
    s = read_stream(spark, "files", path=src, schema=df.schema)
    q = topic_sink(s, "t", os.path.join(base, "ck1"), path=os.path.join(base, "topics"), trigger="availableNow")
    q.awaitTermination()
    assert sorted(os.listdir(os.path.join(base, "topics")))[:2] == ["_spark_metadata", "topic=dim_order"]
    q = text_sink(s, os.path.join(base, "text"), os.path.join(base, "ck2"), trigger="availableNow")
    q.awaitTermination()
    lines = [json.loads(r.value) for r in spark.read.text(os.path.join(base, "text")).collect()]
    assert sorted((x["t"], x["id"]) for x in lines) == [("dim_order", 2), ("dim_user", 1)]


def test_reduce_by_window(spark):
    df = spark.createDataFrame([("u", 1000, 1.0), ("u", 2000, 2.0), ("u", 200_000, 5.0)], "uid string, ts long, v double")
    out = sorted(map(tuple, reduce_by_window(df, "uid", "ts", 120_000, F.sum("v").alias("s")).collect()))
    assert out == [("u", 0, 3.0), ("u", 120_000, 5.0)]


CHANGE = "op string, before map<string,string>, after map<string,string>, source struct<table:string,pos:long>, ts_ms long"


def change(op, key, ts, pos=0, **after):
    full = {"id": key, **after}
    return (op, full if op == "d" else None, None if op == "d" else full, ("t", pos), ts)


def upsert(spark, batches, sink="noop"):
    base = tempfile.mkdtemp(prefix="portrait-upsert-")
    src = os.path.join(base, "in")
    schema = spark.createDataFrame([], CHANGE).schema
    for rows in batches:
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # the file source orders arrivals by modification time
    s = read_stream(spark, "files", path=src, schema=schema, max_files_per_trigger=1)
    ck = os.path.join(base, "ck")
    upsert_stream(s, "id", ["id", "a", "b"], ck, sink=sink, trigger="availableNow").awaitTermination()
    return ck


BATCHES = [[change("c", "1", 10, a="x", b="y"), change("c", "2", 10, a="p"), change("c", "3", 10, a="q")],
           [change("u", "1", 20, a="z", b=""), change("d", "2", 20), change("u", "3", 5, a="older", b="new")],
           [change("c", "2", 30, b="again"), change("u", "1", 20, a="z", b="")]]  # the last one is a replay


def test_upsert_stream_reads_back_from_state(spark):
    ck = upsert(spark, BATCHES)
    rows = lambda b=None: {tuple(r) for r in read_upsert_snapshot(spark, ck, "id", ["id", "a", "b"], b).collect()}
    assert rows(0) == {("1", "x", "y"), ("2", "p", None), ("3", "q", None)}
    assert rows(1) == {("1", "z", "y"), ("3", "q", "new")}
    assert rows() == {("1", "z", "y"), ("2", None, "again"), ("3", "q", "new")}


def test_upsert_stream_equals_batch_and_tells_changed_keys(spark):
    from portrait.sources import cdc

    seen = []
    ck = upsert(spark, BATCHES, sink=lambda batch, _: seen.append({tuple(r) for r in batch.collect()}))
    every = spark.createDataFrame([r for b in BATCHES for r in b], CHANGE)
    want = {tuple(r) for r in cdc.apply_changes(every, "id", ["id", "a", "b"]).collect()}
    assert {tuple(r) for r in read_upsert_snapshot(spark, ck, "id", ["id", "a", "b"]).collect()} == want
    seen = [x for x in seen if x]
    assert seen[1] == {("1", False, "z", "y"), ("2", True, None, None), ("3", False, "q", "new")}
    assert seen[2] == {("1", False, "z", "y"), ("2", False, None, "again")}


def test_upsert_stream_goes_on_from_its_checkpoint(spark):
    ck = upsert(spark, BATCHES[:1])
    src = os.path.join(os.path.dirname(ck), "in")
    spark.createDataFrame(BATCHES[1], CHANGE).coalesce(1).write.mode("append").parquet(src)
    s = read_stream(spark, "files", path=src, schema=spark.createDataFrame([], CHANGE).schema, max_files_per_trigger=1)
    upsert_stream(s, "id", ["id", "a", "b"], ck, trigger="availableNow").awaitTermination()
    assert {tuple(r) for r in read_upsert_snapshot(spark, ck, "id", ["id", "a", "b"]).collect()} == {("1", "z", "y"), ("3", "q", "new")}
