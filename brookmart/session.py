"""Session settings the pipelines rely on."""
from __future__ import annotations

import uuid
from contextlib import contextmanager

SETTINGS = {
    # Window texts, day boundaries and JSON timestamps are all cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A hot key on the fact side of a join is read as several slices of its
    # shuffle partition, even when the plan above could have reused that
    # partitioning: an extra exchange is cheaper than one endless task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A batch looks a few keys up in all that came before: a Bloom filter of them spares most older rows the shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # Keyed state lives off-heap and on local disk, with changes checkpointed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# What a micro-batch needs besides, in the session that each stream has of its own.
STREAM_SETTINGS = {
    # Shuffle files go with the query that wrote them: they would lie there until the driver collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Stores, changelogs and results hold ids and texts: half the size for little time.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark):
    """Apply `SETTINGS` to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def stream_settings(spark, more=None):
    """`STREAM_SETTINGS`, and `more`, while a block runs."""
    settings = {**STREAM_SETTINGS, **(more or {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def work_folder(spark, purpose):
    """A fresh folder in the shared checkpoint area of the session.

    Where `spark.checkpoint.dir` is unset (tests, a laptop), the folder lies in the
    warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
