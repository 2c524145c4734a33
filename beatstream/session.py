"""Spark session settings and the shared folder for written tables.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with settings that suit the operators (UTC, AQE with skew
handling, no UI) and a helper that finds the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# Settings the operators rely on.  AQE re-plans joins at runtime (broadcast when a
# shuffled side turns out small, skew-join splitting for hot keys) and coalesces
# the many small shuffle partitions that a cluster-sized partition count leaves
# behind on small inputs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Catalyst broadcasts a join side only when its estimated size is below this
    # bound and falls back to a sort-merge join otherwise: the size check behind
    # every dimension lookup in ``operators.joins``.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (window counts, dedup keys, repeat-listen buffers) lives in
    # RocksDB off the JVM heap, so large state does not turn into GC pressure.
    STATE_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "beatstream",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with ``DEFAULT_CONF`` applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, in a session of any settings.

    ``transformWithState`` needs a store with several column families, which Spark's default
    (``HDFSBackedStateStoreProvider``) doesn't offer.  A session's own choice of another provider
    stays.  A stream takes the setting over when it starts, so the session has its own back
    afterwards; a restart goes by the checkpoint.
    """
    before = spark.conf.get(STATE_PROVIDER, None)
    if before and not before.endswith("HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_PROVIDER, DEFAULT_CONF[STATE_PROVIDER])
    try:
        yield
    finally:
        if before:
            spark.conf.set(STATE_PROVIDER, before)
        else:
            spark.conf.unset(STATE_PROVIDER)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is a distributed file system path that every executor can reach, and
    its absence is an error.  Only a local session (driver and executors in one process),
    as in tests, may go without: it gets a folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="beatstream-ck-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "beatstream", f"{name}-{uuid.uuid4().hex[:12]}")
