"""Session helpers: a local session for tests and benches, and the shared scratch folder.

On a cluster the session comes from the caller (``spark-submit``); nothing here overrides it.
Scratch data (stream inputs, checkpoints, result stores written by registered queries) goes to
the folder the cluster names in ``spark.checkpoint.dir``. Only when that is unset (local tests)
do we create one under ``/tmp``, and only for a ``local`` master: elsewhere executors would write
to their own disks, so an unset folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "postlens") -> SparkSession:
    """Single-JVM session with the settings we rely on (AQE, skew join, RocksDB state, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )


def context(spark: SparkSession):
    """The session's SparkContext, or None for sessions without one (Spark Connect)."""
    return getattr(spark, "_sc", None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the context). If neither is
    set, a ``local`` master (tests) gets a new folder under ``/tmp``; any other is an error.
    """
    ctx = context(spark)
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and ctx is not None:
        conf_dir = ctx.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if ctx is not None and not ctx.getCheckpointDir():
            ctx.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if ctx is not None and ctx.getCheckpointDir():
        return ctx.getCheckpointDir().rstrip("/")
    if ctx is None or not ctx.master.startswith("local") or ctx.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    ctx.setCheckpointDir(tempfile.mkdtemp(prefix="postlens-ckpt-", dir="/tmp"))
    return ctx.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder (one per run).

    The folder is removed when the application ends (its file system's delete-on-exit list).
    """
    path = f"{shared_dir(spark)}/postlens/{name}-{uuid.uuid4().hex[:12]}"
    ctx = context(spark)
    if ctx is not None:
        target = ctx._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(ctx._jsc.hadoopConfiguration())
        fs.mkdirs(target)  # only a folder that exists can be listed for removal
        fs.deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
