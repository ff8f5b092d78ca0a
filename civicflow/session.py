"""Session construction and shared scratch locations.

Intermediate tables are written below the folder the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant location).  A private
folder is set only when the session leaves it unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "civicflow") -> SparkSession:
    """Return the active session, or build one tuned for this workload.

    Settings that matter at scale: AQE (coalesce small shuffle partitions,
    split skewed join partitions), UTC session time zone (every timestamp in
    the data model is wall-clock ``timestamp_ntz``), and no UI server.
    """
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    apply_scale_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


# A plan whose generated code holds a larger method runs operator by operator, in methods that the JVM compiles.
JIT_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Defaults for large runs, applied only where the cluster configuration is
# silent (an explicit setting always wins).
SCALE_DEFAULTS = {
    # Bigger post-shuffle partitions: fewer tasks when AQE coalesces at TB scale.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # A partition is skewed at 5x the median and over 512 MB; AQE then splits it.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # A generated method above 8000 bytes is never compiled by the JVM, and so runs several times slower.
    **JIT_DEFAULTS,
    # Keep the optimiser's runtime filters (bloom / semi-join reduction) on.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def apply_scale_defaults(spark: SparkSession, defaults: dict[str, str] = SCALE_DEFAULTS) -> None:
    conf = spark.sparkContext.getConf()
    for key, value in defaults.items():
        if not conf.contains(key):
            try:
                spark.conf.set(key, value)
            except Exception:  # noqa: BLE001 - static or unknown key in this version
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="civicflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one intermediate table under the checkpoint dir."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), "civicflow", f"{name}-{uuid.uuid4().hex[:12]}")


def clean_scratch(spark: SparkSession, older_than_seconds: int = 86400) -> list[str]:
    """Delete this package's scratch folders under the checkpoint dir that are
    older than ``older_than_seconds`` (default one day, so scratch of jobs
    still running is left alone).  Returns the deleted folder names."""
    import time
    root = os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "civicflow")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    cutoff = (time.time() - older_than_seconds) * 1000
    deleted = []
    for st in fs.listStatus(path):
        if st.getModificationTime() <= cutoff:
            fs.delete(st.getPath(), True)
            deleted.append(st.getPath().getName())
    return sorted(deleted)
