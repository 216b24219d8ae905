"""Session settings, and the shared folder that jobs may use between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs count on. AQE coalesces small shuffle partitions, splits skewed
# join partitions and splits skewed partitions under a rebalance before a write.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # predicates that differ only in case are different columns
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "lakeloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Bytes of Parquet input for one partition of a shuffle; rows in memory take many times as much.
INPUT_A_PARTITION = 8 << 20


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Let shuffles start with as many partitions as the input calls for; AQE joins small ones again.

    A fixed number gives each task a share that grows with the input, until it spills. What
    the session asks for already is never made smaller. Returns the number of partitions.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    size = sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in folders)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-size // INPUT_A_PARTITION)
    if wanted > now:
        spark.conf.set(key, str(wanted))
    return max(now, wanted)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    A machine-local temporary folder is made only in local mode and only when the
    setting is absent; on a cluster the missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """A table of metadata (chosen types, column lists, specs) computed once and read back.

    As a written table it survives a lost executor, and Catalyst knows its size: it is
    broadcast while it is small and joined by a shuffle once it is not.
    """
    path = fresh_folder(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
