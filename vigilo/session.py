"""Session helpers: recommended configuration and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (a
# dimension is broadcast only when its measured size is below the threshold,
# otherwise sort-merge join with skewed partitions split), coalesces small
# shuffle partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when the join's partitioning is reused downstream
    # (join, then group by patient): costs a shuffle only when skew is found
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    # A fused stage whose generated method exceeds the JVM's 8000-byte JIT limit
    # would run interpreted; above this size Spark splits back to per-operator code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state (one row per patient) lives off-heap in RocksDB, not in the
    # executor heap, so it can reach millions of keys.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "vigilo",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the same keys through spark-submit."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if master.startswith("local"):
        # local mode runs every executor inside the driver JVM (default heap 1 GB)
        conf["spark.driver.memory"] = "12g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (and so share a disk)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared working folder.

    The configured ``spark.checkpoint.dir`` (stable across application restarts,
    so stream checkpoints below it survive a restart); else the context's
    checkpoint folder. Only in local mode (tests) is a private folder created
    and set when there is neither; on a cluster each executor would write to
    its own disk, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="vigilo-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


# Folders handed out by fresh_path and not yet removed, with their sessions.
_fresh: list[tuple[SparkSession, str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unique path below the shared folder (never reused between runs).

    Results read back from it stay readable while the application runs; what is
    left there is removed by ``remove_fresh`` or, at the latest, when the driver
    ends normally."""
    if not _fresh:
        atexit.register(_remove_at_exit)
    path = f"{shared_dir(spark)}/vigilo/{label}-{uuid.uuid4().hex[:12]}"
    _fresh.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remove_fresh(spark: SparkSession) -> None:
    """Delete every folder that ``fresh_path`` handed out and that is no longer needed."""
    while _fresh:
        remove(spark, _fresh.pop()[1])


def _remove_at_exit() -> None:
    for spark, path in _fresh:
        with contextlib.suppress(Exception):   # the session may be gone by now
            remove(spark, path)
