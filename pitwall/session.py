"""Session helpers: build a session for tests/bench and locate the shared folder.

Shared intermediate data (streaming checkpoints, written tables that cut lineage)
goes under ``spark.checkpoint.dir`` as the cluster names it.  A folder is created
only when that setting is unset, which happens in local tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "pitwall") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (one JVM, as in tests) may leave it unset and then gets a folder of
    its own; on a cluster an unset folder is an error, because executors and driver share no
    local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext in a Spark Connect session
        context = None
    if not base and context is not None:
        base = context.getCheckpointDir()
    if not base:
        if context is None or not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pitwall-ckpt-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{checkpoint_root(spark)}/pitwall/{name}-{uuid.uuid4().hex[:12]}"
