"""Session settings the jobs rely on, and the folder that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # All event times are UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window state outgrows the heap long before it outgrows the disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="signalmill-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; a cluster session fails,
    since a folder on one machine is not seen by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
