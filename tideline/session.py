"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"

# Runtime settings every job relies on. One zone for parsing and formatting, and
# adaptive execution that may split a skewed join side even when that costs a shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Static settings, so they only apply to sessions built here. The stateful Python
# worker then talks to its task over a socket file and opens no TCP port.
STATIC_CONF = {"spark.python.unix.domain.socket.enabled": "true"}


def build_session(app="tideline", master=None, conf=None):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark):
    """Apply the runtime settings to a session that was built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Removes the shuffle files of a query when it has ended.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark, key, value):
    """A runtime setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


STATE_PARTITIONS = 8


def stream_session(spark, state_partitions=None, state=ROCKSDB):
    """A sibling session set up for stateful queries.

    State is in RocksDB. Where a short watermark keeps it small, ``IN_MEMORY`` is twice as fast.

    The first checkpoint of a query fixes its number of state partitions for good, so
    the number is an explicit setting of the deployment: give it the cores of the full
    cluster. The default is the cores at hand, and ``STATE_PARTITIONS`` at least.
    """
    if state_partitions is None:
        state_partitions = max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism)
    session = tune(spark.newSession())
    session.conf.set("spark.sql.streaming.stateStore.providerClass", state)
    # Counting the keys costs a lookup for each write.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    # A checkpoint then stores what changed and not the whole state.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # A restart needs the last batch; state of older ones is only disk.
    session.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def work_dir(spark, purpose):
    """A fresh folder for checkpoints and written intermediates.

    One rule for every master: the shared folder named by ``spark.checkpoint.dir``, else
    the session's warehouse folder, which all executors reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
