"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package is planned against: UTC wall clock so
# date / time-of-day keys do not depend on the driver's zone, and AQE so that
# shuffle partition counts, skewed join partitions and small join sides are
# re-planned from runtime statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    # Checkpoint files go when their frame is no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Runtime SQL settings the plans rely on; applied to any session (also one
# handed in by a caller) where they are not set explicitly.
RUNTIME_CONF = {
    # A hot join key is split by AQE even when the join's partitioning also
    # served the aggregation above it; the extra shuffle (with partial
    # aggregation) is added only when runtime statistics show skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Pivots carry 96 slot columns next to their keys; let such operators
    # stay in whole-stage code generation (default cap: 100 fields).
    "spark.sql.codegen.maxFields": "400",
}


def get_session(app_name: str = "slotwise", master: str | None = None,
                hive: bool = False, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``hive=True`` mirrors the reference's
    Hive-enabled session; it needs the Hive classes and a metastore."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if hive:
        builder = builder.enableHiveSupport()
    return apply_runtime_conf(builder.getOrCreate())


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set :data:`RUNTIME_CONF` entries that the session does not set itself."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on shared storage for lineage cuts, stream checkpoints and
    round-trip outputs.

    Taken from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir). Only when it is unset *and* the session runs in local
    mode (tests, benches) is a private folder created and registered; on a
    cluster an unset value is an error, since a machine-local folder would
    not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)   # named in the conf; make checkpoint() use it
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="slotwise-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of :func:`shared_dir` (never reused)."""
    base = shared_dir(spark)
    return base.rstrip("/") + "/" + f"{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


__all__ = ["remove_path", "DEFAULT_CONF", "RUNTIME_CONF", "apply_runtime_conf", "get_session", "shared_dir", "scratch_path"]
