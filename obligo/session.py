"""Session settings and the shared scratch folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort-merge joins where every shuffled partition turned out to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.ui.enabled": "false",
}

# Bytes one shuffle task should get, and the number of partitions Spark uses by default.
SHUFFLE_TASK_BYTES = 512 * 1024**2
DEFAULT_PARTITIONS = 200


def build_session(app: str = "obligo", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on; sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, shuffled_bytes: int) -> int:
    """Sets the number of shuffle partitions for jobs that shuffle about so many bytes.

    Adaptive execution merges partitions that turn out small but cannot make more of them, so
    snapshot jobs over large tables have to start with enough for a partition to fit in memory.
    """
    partitions = max(DEFAULT_PARTITIONS, -(-shuffled_bytes // SHUFFLE_TASK_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


_jobs: list[str] = []
_removed_at_exit: set[str] = set()


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of what runs inside go to a folder of their own, removed at the end."""
    _jobs.append(f"job-{uuid4().hex}")
    try:
        yield
    finally:
        remove_folder(spark, scratch_folder(spark))
        _jobs.pop()


def scratch_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, below what the cluster names in spark.checkpoint.dir.

    Only a local-mode session without that setting uses a folder below its warehouse. On a cluster
    every executor must see the folder, so there is no default. It goes when the driver ends;
    results that were not written elsewhere by then are gone with it.
    """
    app_id = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = "/".join([configured.rstrip("/"), "obligo", app_id])
    elif spark.sparkContext.master.startswith("local"):
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{app_id}"
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if folder not in _removed_at_exit:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _removed_at_exit.add(folder)
    return "/".join([folder, *_jobs[-1:]])


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
