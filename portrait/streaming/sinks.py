"""Stream sinks (S5-S7, S9, S15, S16) and the job runner.

Delivery: the file sink is exactly-once (its commit log lives in the
checkpoint); Kafka and ``foreachBatch`` sinks are at-least-once, made
idempotent where it matters by writing each micro-batch to a folder named
by its ``batch_id`` (a replayed batch overwrites itself).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from portrait.sources import cdc

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_CONF = "spark.sql.streaming.stateStore.rocksdb"


def run_stream(df: DataFrame, *, sink: str | Callable = "parquet", path: str | None = None,
               checkpoint: str, output_mode: str = "append", trigger: str = "availableNow",
               partition_by: list[str] | None = None, options: dict | None = None,
               query_name: str | None = None, state_partitions: int | None = None, count_state: bool = True) -> StreamingQuery:
    """Start a stream: ``sink`` is a format name (parquet, json, text,
    kafka, console, memory) or a ``foreachBatch`` function.  ``trigger`` is
    ``'availableNow'`` (drain and stop) or a processing-time interval like
    ``'5 seconds'`` (the original checkpointed every 5 s).

    State is kept in RocksDB (on disk, beside the heap); a micro-batch commits
    what it changed, not whole files.  ``count_state`` keeps the number of rows
    in state for the progress reports, a lookup more for each row put.
    ``state_partitions`` sizes the shuffles and state stores of the stream
    (fixed for the life of its checkpoint); default: the cluster's
    parallelism rather than the batch setting."""
    spark = df.sparkSession
    n = state_partitions or spark.sparkContext.defaultParallelism
    wanted = {"spark.sql.shuffle.partitions": str(n), "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              f"{ROCKSDB_CONF}.changelogCheckpointing.enabled": "true", f"{ROCKSDB_CONF}.trackTotalNumberOfRows": str(count_state).lower()}
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return _start(df, sink, path, checkpoint, output_mode, trigger, partition_by, options, query_name)
    finally:  # the stream copied the session's settings when it started
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _start(df, sink, path, checkpoint, output_mode, trigger, partition_by, options, query_name):
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if callable(sink):
        return w.foreachBatch(sink).start()
    w = w.format(sink)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path) if path else w.start()


def run_to_completion(df: DataFrame, **kw) -> None:
    q = run_stream(df, trigger="availableNow", count_state=False, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def kafka_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """S5 shape: ``value`` = the row as JSON text (and optional ``key``)."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        cols.append(F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def kafka_sink(df: DataFrame, topic: str, servers: str, checkpoint: str, **kw) -> StreamingQuery:
    """JSON rows to one topic (at-least-once)."""
    return run_stream(kafka_value(df), sink="kafka", checkpoint=checkpoint,
                      options={"kafka.bootstrap.servers": servers, "topic": topic}, **kw)


def topic_sink(df: DataFrame, topic_col: str, checkpoint: str, *, servers: str | None = None,
               path: str | None = None, **kw) -> StreamingQuery:
    """Each row goes to the topic named in ``topic_col``; to Kafka (the
    connector reads the ``topic`` column) or to files under
    ``path/topic=<name>/``."""
    if servers:
        out = kafka_value(df.drop(topic_col)).withColumn("topic", df[topic_col])
        return run_stream(out, sink="kafka", checkpoint=checkpoint,
                          options={"kafka.bootstrap.servers": servers}, **kw)
    return run_stream(df.withColumnRenamed(topic_col, "topic"), sink="parquet", path=path,
                      checkpoint=checkpoint, partition_by=["topic"], **kw)


def olap_sink(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """S7 as a ``foreachBatch`` function: each micro-batch lands as
    JSON-lines (or parquet) in ``path/batch_id=<id>``; a retried batch
    overwrites its own folder, so retries do not duplicate rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(os.path.join(path, f"batch_id={batch_id}"))
    return write


def upsert_stream(changes: DataFrame, key: str, columns: list[str], checkpoint: str, *, order: tuple[str, ...] = cdc.ORDER,
                  sink: str | Callable = "noop", **kw) -> StreamingQuery:
    """Change records folded into per-key change state by Spark's own
    streaming aggregation, in update mode: a micro-batch touches the state of
    its keys only, combined on the map side first, so a hot key is one row a
    task.  ``sink`` gets the changed keys: key, ``_gone`` (deleted) and the
    columns as they now are; the table itself is the state, see
    ``read_upsert_snapshot``."""
    state = cdc.change_state(changes, key, columns, order)
    live = ~F.col("_last.gone")
    rows = state.select(key, F.col("_last.gone").alias("_gone"), *[F.when(live, F.col(f"{c}.v")).alias(c) for c in columns if c != key])
    return run_stream(rows, sink=sink, output_mode="update", checkpoint=checkpoint, **kw)


def read_upsert_snapshot(spark, checkpoint: str, key: str, columns: list[str], batch_id: int | None = None) -> DataFrame:
    """The upsert table as of a batch (default: the latest finished one), read
    back from the stream's state, a task for each state partition."""
    r = spark.read.format("statestore").option("path", checkpoint)
    state = (r if batch_id is None else r.option("batchId", batch_id)).load()
    names = [key, "_last", *[c for c in columns if c != key]]
    # by place: the aggregates of the state all have one name
    return cdc.state_to_snapshot(state.select("key.*", F.inline(F.array("value"))).toDF(*names), key)


def console_sink(df: DataFrame, checkpoint: str, **kw) -> StreamingQuery:
    """S15."""
    return run_stream(df, sink="console", checkpoint=checkpoint, **kw)


def text_sink(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """One JSON text line per row."""
    return run_stream(df.select(F.to_json(F.struct(*df.columns)).alias("value")), sink="text",
                      path=path, checkpoint=checkpoint, **kw)
