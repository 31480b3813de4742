"""Session settings the operators rely on, and the shared scratch location.

Days, partitions and file stamps are UTC, so the session time zone must be UTC.  ANSI mode
makes malformed casts fail instead of turning into nulls.  Adaptive execution is what splits
skewed joins and hot table partitions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every result depends on to an existing session."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in which days and hours would be those of another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"the session time zone is {zone}, not UTC: call wattlake.configure(spark)")


def build_session(
    app_name: str = "wattlake", master: str | None = None, **conf: str
) -> SparkSession:
    """A session for scripts and tests; on a cluster the deployment supplies the sizing.

    Shuffle partitions stay whatever the deployment sets: adaptive execution merges small
    shuffle partitions, so a cluster sets a high initial number.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattlake-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path in the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
