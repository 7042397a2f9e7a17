"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: they may be changed on a session someone else started.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Shuffles start with this many partitions per core on a cluster; adaptive execution merges
# what turns out small, so a high start costs little and keeps partitions within memory.
PARTITIONS_PER_CORE = 4


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS_PER_CORE * sc.defaultParallelism)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return spark


def build_session(app: str = "tablewarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a temporary one only for a local session."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tablewarden-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    Used where two branches must see the very same rows (sampled range
    borders, sketch values): a lost executor then re-reads the files instead of
    computing other borders.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
