"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python task turns into objects at one time.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_text(c: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(c.cast("binary"), 256)


def text_key(c: Column) -> Column:
    """A 64-bit hash that tells texts of one id apart; null has its own."""
    return F.xxhash64(c.isNull(), c)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, set on the
    context.  Where it is unset only a local session may go on (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        d = tempfile.mkdtemp(prefix="portrait-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back; the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/portrait-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(run: Callable) -> Callable:
    """``run``, a function over a task's batches, that in the end gives memory
    it no longer uses back to the system: Python workers serve many tasks, and
    what one stage made them hold would stay beside the next."""

    def wrapped(batches: Iterator) -> Iterator:
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return wrapped


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """(start, end) runs of ``texts`` of about ``limit`` characters; a longer
    text is a run of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)
