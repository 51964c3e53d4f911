"""Session helpers: build a session for tests / bench and resolve the shared
checkpoint folder.  On a cluster the folder comes from ``spark.checkpoint.dir``
(set by the deployment); only when it is unset (local tests) do we pick one."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "affinity") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set,
    else — in local mode only (tests, bench) — a fresh local folder.  Also registers it with the
    SparkContext so ``DataFrame.checkpoint`` and ALS ``checkpointInterval`` work."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by executors and dies with them.
            raise RuntimeError("set spark.checkpoint.dir to a shared (distributed) folder")
        conf = tempfile.mkdtemp(prefix="affinity-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


@contextmanager
def persisted(df):
    """Cache a frame only while it feeds several jobs (MEMORY_AND_DISK, so a
    lost executor's blocks are recomputed from lineage), then release it."""
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()


#: Seconds between two collections of the driver's garbage while a long job runs, and how many times longer than one of them at least.
FREE_EVERY, FREE_SHARE = 15.0, 20.0
_freeing = {"jobs": 0, "lock": threading.Lock()}


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete shuffle files, cached blocks and broadcasts that nothing refers
    to any more.  Its cleaner learns of them from the driver's garbage collection,
    which a driver that holds little data runs every half hour; files of all
    iterations and fits until then stay on the executors' disks.  Python's
    collection goes first: models refer to themselves and so to what the driver holds."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def shuffles_freed(spark: SparkSession, every: float = FREE_EVERY):
    """``free_shuffles`` now and then while the block runs (one thread for all such blocks)."""
    with _freeing["lock"]:
        _freeing["jobs"] += 1
        if _freeing["jobs"] == 1:
            _freeing["ended"] = ended = threading.Event()
            threading.Thread(target=_free_until, args=(spark, ended, every), daemon=True).start()
    try:
        yield
    finally:
        with _freeing["lock"]:
            _freeing["jobs"] -= 1
            if _freeing["jobs"] == 0:
                _freeing["ended"].set()


def _free_until(spark: SparkSession, ended: threading.Event, every: float) -> None:
    wait = every
    while not ended.wait(wait):
        begun = time.monotonic()
        try:
            free_shuffles(spark)
        except Exception:  # the application has ended
            return
        wait = max(every, FREE_SHARE * (time.monotonic() - begun))


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings for a run over ``input_bytes`` on ``total_cores`` task
    slots: an initial shuffle-partition count large enough that no partition
    exceeds ~``target_partition_bytes`` before AQE coalesces (at least 3 waves
    of tasks), 128 MB file splits, and AQE skew splitting for hot keys.
    Apply at session build time (``SparkSession.builder.config(map=...)``)."""
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, by_size)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
