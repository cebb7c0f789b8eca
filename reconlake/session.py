"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every query needs for stable semantics. Applied to an existing
# session as runtime SQL confs (no restart needed).
SQL_CONF = {
    # event times are zone-less ISO strings meant as UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state (join buffers, dedup keys) in RocksDB on local disk, not
    # on the JVM heap; changelog checkpoints upload only the changed keys
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no lookup of the old value at each write, just to count the rows
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # a stream-stream join keeps its four tables in one store per partition, not in a store each
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # cap RocksDB memory per executor instead of per state store instance
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


# In one process, listing folders by tasks gains nothing: each folder would be a task.
LOCAL_CONF = {"spark.sql.sources.parallelPartitionDiscovery.threshold": "100000"}


def ensure_session(spark: SparkSession) -> SparkSession:
    for k, v in (SQL_CONF | (LOCAL_CONF if is_local(spark.sparkContext.master) else {})).items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "reconlake") -> SparkSession:
    """Local session for tests and the bench. On a cluster, build the session
    with the cluster's own settings and call ``ensure_session``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.ui.enabled", "false")
          .config("spark.driver.memory", os.environ.get("RECONLAKE_DRIVER_MEMORY", "8g"))
          .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)))
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def stream_state(spark: SparkSession, conf: dict[str, str] | None = None, per_core: int = 2) -> Iterator[None]:
    """Streams started inside keep their state in a few partitions for each core, or in the
    session's shuffle partitions if these are fewer: every micro-batch opens and commits the store
    of every partition, rows or not, and state lies on disk, so more partitions than cores can work
    on only add to its time. A stream that has a checkpoint keeps the number it began with.
    ``conf``: more settings of these streams."""
    few = min(int(spark.conf.get(PARTITIONS)), per_core * spark.sparkContext.defaultParallelism)
    new = {PARTITIONS: str(few), **(conf or {})}
    before = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def is_local(master: str) -> bool:
    """One process: ``local``, ``local[n]``; not ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and everything runs in one process (a
    ``local`` master, as in tests) do we create one, once per session, and
    register it so later calls and ``checkpoint()`` agree. On a cluster a folder
    of the driver's machine would be another folder on each executor: an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reconlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)      # so DataFrame.checkpoint() writes there too
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint root (never reused)."""
    return f"{_checkpoint_root(spark)}/reconlake/{name}-{uuid.uuid4().hex[:12]}"
