"""Session helpers: sane defaults for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a production job wants as well as a test: AQE re-plans joins and
# shuffles at runtime (coalesces small partitions, splits skewed ones and
# converts sort-merge joins to broadcast when the real size is small).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # delete checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "portrait") -> SparkSession:
    """A local session for tests and the bench (a cluster brings its own)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session (or its SparkContext).  Where neither has one, a
    local session (tests, ad-hoc runs) gets a fresh scratch folder; on a
    cluster that is an error, because executors do not share a local one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="portrait-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (streams, sinks)."""
    base = checkpoint_dir(spark)
    # unique per call so reruns never collide with an old checkpoint
    return os.path.join(base, "portrait", f"{name}-{os.getpid()}-{next(_SEQ)}-{os.urandom(4).hex()}")


def _counter():
    i = 0
    while True:
        i += 1
        yield i


_SEQ = _counter()


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder
    (``spark.checkpoint.dir``) and continue from the written copy.

    Used where one intermediate feeds several branches that the optimizer
    would otherwise recompute separately (each pruned differently, so no
    shuffle reuse).  Reliable checkpoints survive executor loss; local
    checkpoints would not."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
