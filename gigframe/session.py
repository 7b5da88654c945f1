"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours gets. Sizes target a cluster; tests override
# shuffle partitions to the local core count.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A side is broadcast only when its measured size (static estimate or the
    # runtime shuffle statistics under AQE) is below this many bytes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Bucketed tables of different sizes join on the smaller number of buckets.
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


# Cluster sizing: start every shuffle with many partitions and let AQE
# coalesce them to ~256 MB each; a 10 TB shuffle still gets ~256 MB tasks,
# a small one collapses to a few. Skewed partitions are split by AQE.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gigframe", extra: dict | None = None) -> SparkSession:
    """A session with our defaults; local masters get one partition per core."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # All our settings are runtime SQL settings. One that was given, by spark-submit or
    # in ``extra``, stays as it is.
    conf = dict(DEFAULT_CONF)
    if _is_local(spark):
        conf["spark.sql.shuffle.partitions"] = str(spark.sparkContext.defaultParallelism)
    else:
        conf.update(CLUSTER_CONF)
    given = spark.sparkContext.getConf()
    for k, v in conf.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        if not given.contains(_INITIAL):
            spark.conf.unset(_INITIAL)
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001  (Spark Connect)
        return False


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The setting is read from the session. Only a local-mode session without
    one (tests, the bench) gets a fresh folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so we refuse.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns the folder)
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="gigframe-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
