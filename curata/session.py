"""Session factory (S8) and checkpoint-directory handling.

A cluster names its shared checkpoint folder in ``spark.checkpoint.dir``; we
only read it. Tests and local runs, where it is unset, get a fresh folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at any scale: UTC so that timestamp maths matches the
# oracle, AQE for runtime coalescing / skew splitting, no web UI.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    app_name: str = "curata",
    master: str | None = None,
    cluster: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one.

    ``cluster=False`` runs ``local[*]``; ``cluster=True`` takes the master from
    the builder's usual ``spark.master`` setting (spark-submit) unless one is
    passed. An already running session is reused as it is; one in another
    time zone than UTC is refused, because every date would differ.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        zone = active.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"the active session's time zone is {zone}; set spark.sql.session.timeZone to UTC")
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    elif not cluster:
        builder = builder.master("local[*]")
    for k, v in {**_BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; set a private one only if unset.

    The private folder is machine-local, so it is only made in local mode; a
    cluster must name a shared folder in ``spark.checkpoint.dir``.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(intermediate results are checkpointed there)")
        current = tempfile.mkdtemp(prefix="curata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
