"""Session construction and the shared working folder.

Cluster rule: anything this library writes as an intermediate (versioned
snapshot tables, streaming checkpoints, lineage cuts) goes under the shared
folder named by ``spark.checkpoint.dir``.  We only invent a folder when the
session has none, which is the local test situation.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from .sizing import cluster_conf

# Session settings every job relies on.  Time zone UTC makes epoch
# conversions and the text form of timestamps engine-independent; AQE picks
# broadcast vs. sort-merge from runtime sizes and splits skewed join
# partitions, so no join below hard-codes a broadcast of a growing table.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed streaming state (latest row per key) grows with the key space:
    # RocksDB keeps it off-heap and checkpoints incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Upper bound of a side that adaptive execution may broadcast once it is measured.
MEASURED_BROADCAST_BYTES = 10 << 20


def build_session(master: str | None = None, app: str = "carelake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, volume: tuple[int, int, int] | None = None) -> SparkSession:
    """``volume`` = (input bytes, executors, cores each) derives split size,
    shuffle partitions, skew and broadcast bounds (``sizing.cluster_conf``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if volume:
        conf.update(cluster_conf(*volume))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    shared_root(spark)
    return spark


def is_local(master: str) -> bool:
    """One JVM on one machine (``local-cluster[...]`` starts executors of their own)."""
    return master == "local" or master.startswith("local[")


def joins_by_measure(spark: SparkSession) -> SparkSession:
    """Broadcast only what adaptive execution has measured.

    The static threshold trusts optimizer estimates, which ``explode`` and
    filters leave far off; the adaptive one sees shuffled bytes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(MEASURED_BROADCAST_BYTES))
    return spark


def joins_by_file_size(spark: SparkSession) -> SparkSession:
    """The cluster's own thresholds, for jobs whose small join sides are tables written just before."""
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        v = spark.sparkContext.getConf().get(k, None)
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for intermediates (``spark.checkpoint.dir``).

    Read from the session.  Only a local session (one machine) gets a folder
    of its own when it names none; on a cluster that is an error, as executors
    could not see a folder on the driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                             "that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="carelake-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(d, "rdd-checkpoints"))
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one job run."""
    return os.path.join(shared_root(spark), "carelake", f"{name}-{uuid.uuid4().hex[:12]}")
