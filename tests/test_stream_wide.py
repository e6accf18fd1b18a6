"""The chain of watermarked joins: its rows, and its state that goes."""

import os
import tempfile
import time

import __spark_entry__ as E
from oracle_harness import compare, duck
from portrait.streaming import wide_orders as SW
from portrait.streaming.sinks import run_stream
from portrait.streaming.sources import read_stream

SF = "/root/testdata/sf0.001"
DAY = 86_400_000


def test_chain_equals_batch_sql(spark):
    r = compare(E.queries()["stream_wide_watermark"](spark, SF), duck(SF), E.oracle_sql()["stream_wide_watermark"])
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"] > 0, r


def folder(spark, base, name, batches, ddl):
    path = os.path.join(base, name)
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # the file source orders arrivals by modification time
    return read_stream(spark, "files", path=path, schema=spark.createDataFrame([], ddl).schema, max_files_per_trigger=1)


def test_state_goes_once_no_partner_can_come(spark):
    base = tempfile.mkdtemp(prefix="portrait-wide-")
    order = "id long, user_id long, total_amount double, event_ms long"
    user = "uid long, name string, event_ms long"
    orders = folder(spark, base, "orders", [[(k, k, 1.0, 9 * DAY) for k in range(40)], [(100, 1, 2.0, 60 * DAY)], [(101, 2, 3.0, 61 * DAY)]], order)
    users = folder(spark, base, "users", [[(k, f"n{k}", 10 * DAY) for k in range(20)], [(1, "late", 60 * DAY)], [(2, "later", 61 * DAY)]], user)
    out = os.path.join(base, "out")
    q = run_stream(SW.wide_topic(orders, users), sink="parquet", path=out, checkpoint=os.path.join(base, "ck"))
    q.awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 22 and sorted(r[0] for r in rows.where("id >= 100").select("name").collect()) == ["late", "later"]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) >= 60 and held[-1] <= 6


def test_dimensions_meet_only_rows_that_met_a_user(spark):
    """The five hops follow the join with the users, in the batch and in the
    chain of streams: they are in no shuffle, topic or state before it."""
    from portrait import queries as Q
    from portrait.sources import adapters as A
    from portrait.sources.tables import Tables
    t = Tables(spark, SF)
    topic = SW.order_topic(A.order_detail(t.lineitem), A.order_info(t.orders))
    assert not {"tm_id", "tm_name", "category1_name", "price_interval"} & set(topic.columns)
    plan = Q.wide(t)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "_dk" in joins[0] and "user_id" in joins[1] and "uid" in joins[1], joins
    assert Q.wide(t).columns[:12] == ["id", "order_id", "sku_id", "sku_name", "sku_num", "create_time", "user_id", "total_amount", "original_total_amount", "ts_ms", "tm_id", "category3_id"]
