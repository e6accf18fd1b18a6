"""Stream sources (S1, S2): Kafka or files, value as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, kind: str = "files", *, path: str | None = None,
                topic: str | None = None, servers: str | None = None, schema=None,
                fmt: str = "parquet", starting_offsets: str = "earliest",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """``kind='kafka'``: one topic from the earliest offset, the record
    value as text in ``value`` (null stays null) plus the Kafka timestamp.
    The Kafka connector jar must be on the classpath (it is not in this
    image; tests use ``kind='files'``).  ``kind='files'``: a folder of
    ``fmt`` files read as they arrive (``schema`` required)."""
    opts = dict(options or {})
    if kind == "kafka":
        if not (topic and servers):
            raise ValueError("kafka needs topic= and servers=")
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"),
                               F.col("timestamp").alias("kafka_ts"))
    if kind == "files":
        if path is None or schema is None:
            raise ValueError("files needs path= and schema=")
        r = spark.readStream.format(fmt).schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load(path)
    raise ValueError(f"unknown source kind {kind!r}")


#: Bytes of rows (by the schema's default width) for one staged file.
STAGE_FILE_BYTES = 32 * 1024 * 1024


def stage_slices(df: DataFrame, path: str, slice_col: str, n_slices: int, least_files: int = 2) -> int:
    """Write ``df`` as ``n_slices`` consecutive arrivals (slice i of
    ``slice_col``'s range after slice i-1) and return the files of each, so
    that a file stream read with ``maxFilesPerTrigger`` of that many sees them
    as successive micro-batches.  ``df`` is read once for the bounds and once
    for each slice: a projection of tables is read again for less than a copy
    costs; materialize what costs more.  The number of files, and so of writing
    and reading tasks, follows its size."""
    rows, lo, hi = df.agg(F.count(F.lit(1)), F.min(slice_col), F.max(slice_col)).first()
    width = df._jdf.schema().defaultSize()
    files = max(least_files, -(-rows * width // (n_slices * STAGE_FILE_BYTES)))
    if lo is None:
        df.limit(0).write.mode("append").parquet(path)
        return files
    width = (hi - lo) // n_slices + 1
    s = F.floor((F.col(slice_col) - F.lit(lo)) / F.lit(width))
    for i in range(n_slices):
        df.filter(s == i).repartition(files).write.mode("append").parquet(path)
    return files
