"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results (zone, ANSI) or that every plan here relies on
# (AQE splits skewed join partitions and coalesces small ones).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A fused method above HotSpot's limit is never compiled; smaller ones are.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state lives on local disk with changelog checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Tables compress to a tenth or less of their rows: a task that sorts a larger part of one spills.
    "spark.sql.files.maxPartitionBytes": "32m",
}

# For a plan that is run once: its shuffle files go when it has ended, not when the driver happens to collect its garbage.
ONE_RUN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; its number of partitions stays."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for what starts inside; a stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vitrine")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The base is ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="vitrine-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
