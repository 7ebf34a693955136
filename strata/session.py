"""Session factory and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Join-strategy policy. Static broadcast decisions use size *estimates*
# (compressed file sizes), which can be far below the in-memory size of a
# large table, so they are switched off. AQE still turns a join into a
# broadcast join when the *measured* shuffle output of one side is small.
# Sides whose size is bounded by construction (one-row scalars, bucket
# offset tables, fixed reference tables) are broadcast explicitly.
JOIN_POLICY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


# Sizing for a large cluster (about 1000 executors, inputs of ~100 TB).
# Shuffles start wide and AQE coalesces them to the advisory size, so small
# stages do not run 20 000 tiny tasks and big ones never exceed ~256 MB per
# task (fits executor memory, spills cleanly). A partition is called skewed
# above 5x the median and 512 MB, and is then split. Scan splits of 512 MB
# keep the task count of a 100 TB scan near 200 000. Parquet is written with
# zstd.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.files.openCostInBytes": "8MB",
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_policy(spark: SparkSession) -> SparkSession:
    """Session settings every strata job relies on (UTC clock, join policy)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in JOIN_POLICY.items():
        spark.conf.set(k, v)
    return spark


def get_spark(app_name: str = "strata", master: str | None = None,
              shuffle_partitions: int | None = None, cluster: bool = False,
              driver_memory: str | None = None) -> SparkSession:
    """Session with UTC time, AQE (coalescing + skew-join splitting) and no UI.

    ANSI mode stays on: raw input is cast with ``try_cast`` by the operators.
    On a cluster ``master`` is left to spark-submit and ``cluster=True``
    applies ``CLUSTER_CONF``; local tests pass ``master="local[*]"`` and a
    small shuffle width.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if driver_memory:  # local mode: the driver JVM is the executor (takes effect at JVM start)
        b = b.config("spark.driver.memory", driver_memory)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return apply_policy(b.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session (one JVM) that leaves it unset gets a folder of its own;
    on a cluster executors would not share it, so there it must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


_SCRATCH: list[tuple[SparkSession, str]] = []
_SCRATCH_LOCK = threading.Lock()
_REGISTERED = False
_SCOPES = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder.

    Paths handed out here are intermediate results of this process (staged
    layer tables, change sets, stream landing folders); ``release_scratch``
    deletes them once their readers are done, and does so at exit.
    """
    global _REGISTERED
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/strata/{name}-{uuid.uuid4().hex[:12]}"
    with _SCRATCH_LOCK:
        _SCRATCH.append((spark, path))
        for scope in getattr(_SCOPES, "open", []):
            scope.add(path)
        if not _REGISTERED:
            # registered after the JVM gateway exists, so it runs before the gateway shuts down
            atexit.register(release_scratch)
            _REGISTERED = True
    return path


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Delete the scratch paths that this thread takes within the block when it ends, also by an error.

    For work that repeats in one process (a micro-batch): what it stages must not
    wait for the end of the process.
    """
    mine: set[str] = set()
    _SCOPES.open = [*getattr(_SCOPES, "open", []), mine]
    try:
        yield
    finally:
        _SCOPES.open = _SCOPES.open[:-1]
        release_scratch(mine)


def release_scratch(only: set[str] | None = None) -> int:
    """Delete the scratch paths this process created (or ``only`` these); return how many."""
    with _SCRATCH_LOCK:
        items = [x for x in _SCRATCH if only is None or x[1] in only]
        _SCRATCH[:] = [x for x in _SCRATCH if x not in items]
    n = 0
    for spark, path in items:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if fs.exists(p):
                fs.delete(p, True)
                n += 1
        except Exception:  # noqa: BLE001 — the JVM may already be gone at exit
            if is_local_path(path) and os.path.isdir(local_fs_path(path)):
                shutil.rmtree(local_fs_path(path), ignore_errors=True)
                n += 1
    return n


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path
