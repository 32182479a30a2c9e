"""Session settings, object-store options and shared working folders."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything in the library reads and writes instants in UTC. The partition advisory size drives how
# AQE splits hot partitions and merges small ones, both for joins and for rebalanced writes.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def object_store_options(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """Hadoop S3A settings for a path-style object store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def sized_for(total_cores: int, stream_partitions: int | None = None) -> dict[str, str]:
    """Shuffle width for a cluster of so many cores.

    Batch shuffles start at eight partitions per core and adaptive execution merges the small ones. A
    stream keeps the width it first ran with in its checkpoint and is not merged, so it gets its own.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(8 * total_cores),
        "spark.sql.shuffle.partitions": str(stream_partitions or 2 * total_cores),
    }


def build_session(
    app_name: str = "marketspark",
    master: str | None = None,
    options: dict[str, str] | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """A session with the library defaults; ``options`` (for example the object store) win over them.

    Shuffles are sized for ``total_cores``, or else for the cores that the session finds itself with.
    """
    chosen = {**SESSION_DEFAULTS, **(options or {})}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in sized_for(total_cores or _cores(spark)).items():
        if key not in chosen and spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    return spark


def _cores(spark: SparkSession) -> int:
    """Cores that the settings ask for, or those the scheduler has so far."""
    conf = spark.sparkContext.getConf()
    instances = conf.get("spark.executor.instances") or conf.get("spark.dynamicAllocation.maxExecutors")
    if instances and not spark.sparkContext.master.startswith("local"):
        return int(instances) * int(conf.get("spark.executor.cores", "1"))
    return spark.sparkContext.defaultParallelism


def use_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="marketspark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, dropped by Hadoop when the driver JVM ends."""
    path = f"{shared_folder(spark)}/marketspark/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
