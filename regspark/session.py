"""Session settings the library relies on, and the shared scratch folder.

Only settings that change results are forced here (parser policy, zone).
Cluster sizing, broadcast thresholds and AQE stay with the caller.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results; forced on every session the library uses.
REQUIRED_CONF = {
    # Bad dates give NULL instead of throwing or guessing.
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.session.timeZone": "UTC",
}

# Defaults of sessions built here; an existing session keeps its own.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fall back from whole-stage codegen when a generated method would exceed
    # the JVM's JIT limit (8000 bytes of bytecode): wide registry layouts
    # (32 columns, a rule per cell) otherwise run as interpreted bytecode,
    # 2-3x slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    master: str | None = None,
    app_name: str = "regspark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SESSION_DEFAULTS, **REQUIRED_CONF}
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Force the result-changing settings on an existing session."""
    for key, value in REQUIRED_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) session has no context handle
        return None


def _is_local(sc) -> bool:
    """One machine: ``local`` or ``local[n]``, not ``local-cluster``."""
    return sc is not None and sc.master.partition("[")[0] == "local"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). When nothing is configured, a private folder is made on a
    local master only; on a cluster every executor would write to its own
    disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if not _is_local(sc):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="regspark-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
