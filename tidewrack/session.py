"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # one clock for batch, stream and partition folders
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # hot keys: split skewed join partitions even if that costs a further shuffle
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # month=09 must read back as '09', not as the integer 9
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # streaming de-duplication state lives off-heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
#: Scans and merged shuffles have at least this many tasks per core where there are bytes for them, so that a stage
#: does not end with most cores idle. Pieces stay above 4 MB (scans) and 1 MB (shuffles).
TASKS_PER_CORE = 4
TASKS_PER_CORE_SETTINGS = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library's results depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key in TASKS_PER_CORE_SETTINGS:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return spark


def build_session(
    app_name: str = "tidewrack",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; sizes are left to the cluster unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job run inside go when it ends; else they stay until the driver happens to collect its garbage.

    For writes: nothing reads their shuffles afterwards, while a frame that is collected twice may.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a new folder of its own; a cluster
    session without it is refused, because executors would not share the path.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidewrack-", dir="/tmp")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidewrack/{label}-{uuid.uuid4().hex}"
