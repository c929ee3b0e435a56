"""Session set-up shared by the pipeline, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T, R = TypeVar("T"), TypeVar("R")

# Runtime SQL settings every plan in this package relies on. They are applied to
# whatever session the caller hands us (the driver builds its own session).
RUNTIME_CONF = {
    # All timestamps are UTC wall-clock values (EXTRACT(HOUR ...) is UTC).
    "spark.sql.session.timeZone": "UTC",
    # Landing folders month=01 must stay the string "01".
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Overwriting a partitioned table replaces only the partitions written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Starting points for a large cluster (~100 TB scans, ~1000 executors). Applied only
# where the cluster has not set the key itself (``apply_scale_conf``).
SCALE_CONF = {
    # Many initial shuffle partitions; AQE coalesces them to ~256 MB each at runtime,
    # so a 100 TB shuffle gets ~400k tasks and a small one just a few.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    # Scan splits of 256 MB keep per-task memory small and task counts sane.
    "spark.sql.files.maxPartitionBytes": "256m",
    # A partition 5x the median and over 1 GB is split (skew join).
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    # Broadcast only what measures small: planner estimate or AQE runtime size.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def apply_scale_conf(spark: SparkSession) -> SparkSession:
    """Set the cluster starting points, keeping every value the cluster already set."""
    conf = spark.sparkContext.getConf()
    for key, value in SCALE_CONF.items():
        if not conf.contains(key):
            spark.conf.set(key, value)
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ampere") -> SparkSession:
    """Local session for tests and the benchmark (clusters bring their own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names shared storage; we never replace it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster, intermediates must go to "
                "storage that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ampere-ckpt-")  # one JVM, one disk
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Scratch folders that results of this driver may still read.
_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for intermediate tables.

    It lives until ``remove_path``, at the latest until the driver ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ampere/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH[path] = spark
    return path


def held(df: DataFrame, name: str = "held") -> DataFrame:
    """``df`` computed once, into a scratch table: for a frame that several plans, or several
    places of one plan, read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, work: Callable[[T], R], items: Iterable[T], at_once: int = 3) -> list[R]:
    """``work`` on each item, a few at a time, results in order: for independent chains of jobs of
    which many are too small to fill the cluster. Waits for all; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(work), i) for i in items]]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on any storage Spark reaches (classic sessions: it calls the JVM)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _SCRATCH.pop(path, None)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _remove_scratch() -> None:
    for path, spark in list(_SCRATCH.items()):
        try:
            remove_path(spark, path)
        except Exception:  # the session may be gone already  # noqa: BLE001
            pass
