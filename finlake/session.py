"""Session settings and the shared work folder.

Every function in the package takes the session as an argument; this module
only offers a builder with the settings the package is tuned for, and the
lookup of the shared folder used for checkpoints and staged tables.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins (broadcast versus sort-merge
# from measured sizes), splits skewed join partitions and coalesces small
# shuffle partitions; the session time zone pins every date boundary to UTC.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "finlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    rocksdb_state: bool = True,
) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster, leave ``master`` unset and pass the cluster's own settings
    (``spark.checkpoint.dir`` among them) through ``extra`` or spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        # Streaming state on local disk in RocksDB instead of the JVM heap.
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset (local tests) is a folder of
    our own created and registered, so later calls agree on it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _classic_context(spark)
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")  # a session that does not tell may be on a cluster
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder there that the driver and all executors share"
            )
        path = tempfile.mkdtemp(prefix="finlake-ckpt-")  # one machine: tests
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def _classic_context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect raises on sparkContext
        return None


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder for one run of a job."""
    return f"{shared_dir(spark)}/finlake-runs/{label}-{uuid.uuid4().hex[:12]}"
