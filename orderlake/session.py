"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that local-time text and epoch seconds agree
# across engines, AQE for runtime re-planning (coalescing, skew splitting, and turning
# a shuffle join into a broadcast join only when the measured side is small).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # the JVM does not compile methods above 8000 bytecodes: leave such a stage to the
    # row iterators rather than to interpreted generated code
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "orderlake",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_conf(spark)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run: enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (AQE coalesces the small ones and splits
    skewed ones at run time), at least two tasks per core, and scan splits of the same
    size so a scan task's output fits in executor memory without spilling."""
    slots = executors * cores_per_executor
    partitions = max(2 * slots, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        # static broadcasts only for sides measured far below executor memory
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        **SESSION_CONF,
    }


def apply_session_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (the driver's, for example)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the table they were made for is written, not when the
    driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names the shared store. Only when it is unset (local
    tests) do we create one, and register it as the checkpoint folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share "
                               "(a machine-local folder is not visible to the other nodes)")
        d = tempfile.mkdtemp(prefix="orderlake-ckpt-")  # local mode only: one machine
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job's written tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/orderlake/{name}-{uuid.uuid4().hex[:12]}"


def to_local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for the few helpers that list a local folder in tests."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
