"""The change-table source over a database file."""

import os
import sqlite3
import tempfile

from pyspark.sql import functions as F

from portrait.sources import cdc
from portrait.sources.change_table import change_table
from portrait.streaming.sinks import read_upsert_snapshot, run_to_completion, upsert_stream

N = 0


def database(rows, log=()):
    path = os.path.join(tempfile.mkdtemp(prefix="portrait-db-"), "shop.db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE users (id INTEGER, name TEXT, age INTEGER)")
    con.execute("CREATE TABLE changes (pos INTEGER, op TEXT, ts_ms INTEGER, id INTEGER, name TEXT, age INTEGER)")
    con.executemany("INSERT INTO users VALUES (?, ?, ?)", rows)
    con.commit()
    con.close()
    change(path, log)
    return path


def change(path, log):
    con = sqlite3.connect(path)
    con.executemany("INSERT INTO changes VALUES (?, ?, ?, ?, ?, ?)", log)
    con.commit()
    con.close()


def source(spark, path, parts=4, log="changes"):
    global N
    N += 1

    def connect():
        import sqlite3
        return sqlite3.connect(path)

    spark.dataSource.register(change_table(f"users_{N}", connect, "users", "id", ["id", "name", "age"], log=log, parts=parts))
    return f"users_{N}"


ROWS = [(i, f"n{i}", i % 90 or None) for i in range(1, 101)]


def test_snapshot_is_read_in_ranges_of_the_key(spark):
    df = spark.read.format(source(spark, database([*ROWS, (None, "nobody", 1)]))).load()
    assert df.rdd.getNumPartitions() == 4
    assert df.schema.simpleString() == cdc.ENVELOPE.simpleString()
    got = df.select("op", "after", F.spark_partition_id().alias("p")).collect()
    assert {r.op for r in got} == {"r"} and len(got) == 101
    assert max(sum(r.p == p for r in got) for p in range(4)) <= 26
    by_id = {r.after.get("id"): r.after for r in got}
    assert by_id["5"] == {"id": "5", "name": "n5", "age": "5"} and by_id["90"] == {"id": "90", "name": "n90"} and by_id[None]["name"] == "nobody"


def test_empty_table_and_log(spark):
    name = source(spark, database([]))
    assert spark.read.format(name).load().count() == 0
    base = tempfile.mkdtemp(prefix="portrait-cdc-")
    run_to_completion(spark.readStream.format(name).load(), sink="parquet", path=f"{base}/out", checkpoint=f"{base}/ck")
    assert spark.read.schema(cdc.ENVELOPE).parquet(f"{base}/out").count() == 0


def test_stream_goes_from_snapshot_to_log_and_on(spark):
    path = database(ROWS, [(k, "u", 10, k, f"before{k}", 1) for k in range(1, 6)])
    name = source(spark, path)
    base = tempfile.mkdtemp(prefix="portrait-cdc-")

    def drain():
        run_to_completion(spark.readStream.format(name).load(), sink="parquet", path=f"{base}/out", checkpoint=f"{base}/ck")
        return spark.read.parquet(f"{base}/out").select("op", "source.pos", F.coalesce("after", "before").alias("v")).collect()

    first = drain()
    assert len(first) == 100 and {(r.op, r.pos) for r in first} == {("r", 5)}
    assert len(drain()) == 100  # nothing new: nothing read again
    change(path, [(6, "u", 20, 7, "seven", 70), (7, "d", 21, 8, None, None), (8, "c", 22, 500, "new", 5)])
    second = drain()
    assert len(second) == 103
    assert sorted((r.op, r.pos, r.v["id"]) for r in second if r.op != "r") == [("c", 8, "500"), ("d", 7, "8"), ("u", 6, "7")]
    change(path, [(2009, "u", 30, 500, "newer", None)])  # a gap in the positions
    assert sorted((r.op, r.pos) for r in drain() if r.pos > 8) == [("u", 2009)]


def test_upsert_table_follows_the_source(spark):
    path = database(ROWS, [(1, "u", 5, 3, "old", 1)])
    name = source(spark, path)
    ck = tempfile.mkdtemp(prefix="portrait-cdc-") + "/ck"

    def table():
        upsert_stream(spark.readStream.format(name).load(), "id", ["id", "name", "age"], ck, trigger="availableNow").awaitTermination()
        return {r.id: (r.name, r.age) for r in read_upsert_snapshot(spark, ck, "id", ["id", "name", "age"]).collect()}

    assert table() == {str(i): (n, None if a is None else str(a)) for i, n, a in ROWS}
    change(path, [(2, "u", 10, 1, "one", None), (3, "d", 11, 2, None, None)])
    now = table()
    assert now["1"] == ("one", "1") and "2" not in now and len(now) == 99
