"""Database sources, re-aimed as Spark readers.

The original opened one connection on the client and pulled whole result
lists into the job; here the database is read by the executors through
Spark's JDBC source (partitioned by a numeric column when large), and an
initial snapshot is turned into change records so it can be unioned with
a change-record stream.  No database server runs in this image; tests
inject any DataFrame in place of the reader.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.functions.scalars import snake_to_camel
from portrait.sources.cdc import to_change_records


def read_query(spark: SparkSession, url: str, query: str, *, properties: dict | None = None,
               underline_to_camel: bool = False,
               reader: Callable[[], DataFrame] | None = None) -> DataFrame:
    """A query's rows as a DataFrame; column *labels* (aliases) name the
    columns.  ``underline_to_camel`` renames snake_case labels (S12)."""
    if reader is not None:
        df = reader()
    else:
        r = spark.read.format("jdbc").option("url", url).option("query", query)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        df = r.load()
    return df.toDF(*[snake_to_camel(c) for c in df.columns]) if underline_to_camel else df


def read_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
               properties: dict | None = None, reader: Callable[[], DataFrame] | None = None) -> DataFrame:
    """A whole table read in ``num_partitions`` parallel range queries on a
    numeric column (no single task reads a large table)."""
    if reader is not None:
        return reader()
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def snapshot_changes(df: DataFrame, table: str, db: str = "shop", ts_ms: int | None = None) -> DataFrame:
    """S4 (re-aimed): an initial snapshot as ``op='r'`` change records, to be
    unioned with the live change-record stream."""
    if "ts_ms" not in df.columns:
        df = df.withColumn("ts_ms", F.lit(ts_ms if ts_ms is not None else 0).cast("long"))
    return to_change_records(df, table, "r", "ts_ms", db)
