"""SparkSession construction and shared-storage lookup.

Every job in this package assumes ``spark.sql.session.timeZone=UTC`` (FHIR
timestamps with offsets are reduced to UTC dates) and leaves ANSI mode on, so
string→date/timestamp conversions go through guarded ``try_cast``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The static planner broadcasts on estimates, so it does not choose; AQE
    # does, from the measured size of a finished shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Remove reliable-checkpoint files once their DataFrame is unreferenced,
    # so a long-lived session does not grow the shared checkpoint folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "gapwise",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the package relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never overridden;
    unset, it is an error there, as a temp folder is another disk on every
    executor. Only a local master (tests) gets a folder under the system temp dir.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    try:
        d = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key
        d = None
    if not d:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile
        d = os.path.join(tempfile.gettempdir(), "gapwise-checkpoints", uuid.uuid4().hex)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
