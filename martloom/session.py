"""Session factory and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Fixed value: folders a task may write at once; with more values than that it sorts.
CONCURRENT_WRITERS = 16

_SCRATCH: list[str] = []  # folders of scratch tables made by this process


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with UTC time, adaptive execution and skew handling."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a temporary folder; on a cluster a
    missing setting is an error because a machine-local folder would not survive
    the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="martloom-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder for a table written within one run; ``release`` removes it."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _SCRATCH.append(folder)
    return f"{folder}/{label}"


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables this process has made, from the ``since``-th on.

    For when the results that read them have been written or collected.
    """
    while len(_SCRATCH) > since:
        target = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """``with scratch(spark): ...`` deletes at its end what was written to scratch tables within it."""
    since = len(_SCRATCH)
    try:
        yield
    finally:
        release(spark, since)


def fit_shuffles(spark: SparkSession, *inputs: DataFrame, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Set the number of shuffle partitions for the size of the inputs, so that none exceeds ``target_bytes``.

    The size is the planner's estimate of the files.  Adaptive execution merges small
    partitions but never adds any, so a large job needs this before its first shuffle.
    """
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    wanted = max(spark.sparkContext.defaultParallelism, -(-size // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


@contextlib.contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """What is written within it to files leaves no shuffle files behind, and folders by value are written without a sort.

    For tables written once that later steps read instead of what they were made from.
    """
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": str(CONCURRENT_WRITERS)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles that nothing holds any more deleted now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps all see the same rows, whatever happens to executors, and read only the
    columns they need.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
