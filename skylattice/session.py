"""Session settings for the command line, the benchmark and the tests.

A cluster brings its own session; the library never changes settings of one it is given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: Joins on several columns take tables bucketed by one of them as they lie. A key of that one column that
#: holds much of the data then stays in one task, so it is set where the buckets are even, as cities' days are.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (BATCH | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
